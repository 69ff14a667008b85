"""The data contract checked before staged rows may reach the registry table.

The comparison yields differences as data, one per column and kind; the message is made of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

MISSING, EXTRA, RETYPED = "missing", "extra", "retyped"

# The wording callers look for.
REPORT = "Schema check failed: "
WORDING = {MISSING: "Missing: {{{}}}", EXTRA: "Extra: {{{}}}", RETYPED: "Type mismatch: [{}]"}


class Difference(NamedTuple):
    column: str
    kind: str
    expected: str | None
    found: str | None


def differences(staged: DataFrame | StructType, target: DataFrame | StructType) -> list[Difference]:
    """Every column on which the two schemas disagree, by name. Order and nullability do not count."""

    def compare() -> Iterator[Difference]:
        schemas = [side if isinstance(side, StructType) else side.schema for side in (target, staged)]
        for column in sorted({name for schema in schemas for name in schema.fieldNames()}):
            expected, found = (
                schema[column].dataType if column in schema.fieldNames() else None for schema in schemas)
            if expected != found:
                kind = MISSING if found is None else EXTRA if expected is None else RETYPED
                yield Difference(column, kind, *[t and t.simpleString() for t in (expected, found)])

    return list(compare())


def report(found: list[Difference]) -> str:
    """One line naming all columns, kind by kind."""
    by_kind = {kind: [repr(d.column) for d in found if d.kind == kind] for kind in WORDING}
    return REPORT + " | ".join(WORDING[kind].format(", ".join(names)) for kind, names in by_kind.items() if names)


def check_contract(staged: DataFrame | StructType, target: DataFrame | StructType,
                   strict: bool = True) -> bool:
    """True when the columns agree; otherwise a ValueError naming every difference.

    Missing and extra columns always fail, differing types only when ``strict``.
    """
    against = [d for d in differences(staged, target) if strict or d.kind != RETYPED]
    if against:
        raise ValueError(report(against))
    return True
