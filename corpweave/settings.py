"""Fixed values and the few knobs of the registry jobs."""

from __future__ import annotations

from dataclasses import dataclass

# Source tags, hashed into every record id.
TECH_SOURCE = "tech_companies"
REGISTRY_SOURCE = "company_registry"

# What stands in for an unmapped industry or country.
NOT_AVAILABLE = "N/A"

# Legal-form words that never identify a company.
LEGAL_FORMS = [
    "ltd", "limited", "inc", "incorporated", "llc", "corp", "corporation", "co", "company",
    "plc", "gmbh", "sarl", "sa", "nv", "bv", "pte", "pty", "ag", "kg", "kgaa",
    "holding", "holdings", "group",
]

# Registry industry -> industry wording of the tech source.
INDUSTRIES = {
    "information technology and services": "information technology services",
    "retail": "electronics & computer distribution",
    "computer software": "software—application",
    "telecommunications": "communication equipment",
    "internet": "software—infrastructure",
}

# Countries kept as they are.
COUNTRIES = [
    "united states", "taiwan", "south korea", "netherlands", "ireland", "germany", "japan",
    "canada", "india", "france", "australia", "china", "switzerland", "united kingdom",
]

# Market-cap suffix -> multiplier.
MONEY_SCALES = {"t": 1e12, "b": 1e9, "m": 1e6}

# Fixed value: revenue is estimated as this fraction of the market cap.
REVENUE_DIVISOR = 8

# Fixed value: length of the name prefix two records must share to be compared.
BLOCK_LENGTH = 3

# Fixed value: hash buckets of the registry table.
TABLE_BUCKETS = 32

# News rules.
NEWS_ITEMS_PER_REQUEST = 10


@dataclass(frozen=True)
class MatchRule:
    """When two normalised names count as the same company.

    ``confidence = 1 - distance / threshold`` and a pair is kept when the distance is at most
    ``threshold`` and the confidence at least ``min_confidence``. With ``id_order`` the left id
    must also sort below the right id. ``drop_empty`` leaves out records whose name normalises
    to the empty string; by default they all match one another.
    """

    threshold: int = 3
    min_confidence: float = 0.80
    id_order: bool = True
    drop_empty: bool = False

    def __post_init__(self):
        if self.threshold < 1:
            raise ValueError("threshold must be at least 1")

    def reach(self, min_confidence: float | None = None) -> int | None:
        """Largest distance that still passes both cuts; None when not even 0 does."""
        floor = self.min_confidence if min_confidence is None else min_confidence
        passing = [d for d in range(self.threshold + 1) if 1.0 - d / self.threshold >= floor]
        return max(passing, default=None)


@dataclass(frozen=True)
class AmbiguityBand:
    """Confidence range, low end included, whose pairs go to adjudication."""

    low: float = 0.60
    high: float = 0.80
