"""Dates that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_date(text: Column) -> Column:
    """``2026-01-05`` or ``2026-1-5`` as a date; impossible or other text is NULL."""
    shaped = text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$") & ~text.startswith("0000")
    return F.when(shaped, F.try_to_date(text, "yyyy-M-d"))
