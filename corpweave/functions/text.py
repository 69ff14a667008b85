"""Spark SQL expressions on names, amounts and categories.

Every function takes SQL text of its inputs (usually a column name) and returns SQL text, to be
used with ``selectExpr`` or ``F.expr``. All of it runs inside the JVM; there is no Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from corpweave import settings


def quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(values: Iterable[str]) -> str:
    return ", ".join(quoted(value) for value in values)


def tidy(text: str) -> str:
    """Lower case, outer spaces removed (spaces only; tabs stay)."""
    return f"trim(lower({text}))"


def record_id(source: str, *parts: str) -> str:
    """SHA-256 over the source tag and the tidied parts; a NULL part keeps its separator."""
    cells = ", ".join(tidy(f"coalesce({part}, '')") for part in parts)
    return f"sha2(concat_ws('||', {quoted(source)}, {cells}), 256)"


def company_key(name: str, legal_forms: Iterable[str] = settings.LEGAL_FORMS) -> str:
    """The name as compared: lower-case words without punctuation and legal forms.

    Words are maximal runs of letters, digits and underscores in any script, so a legal form
    goes wherever it stands as a whole word. NULL and legal-form-only names become ''.
    """
    words = (
        rf"split(regexp_replace(lower(coalesce({name}, '')), r'[^\p{{L}}\p{{N}}_]+', ' '), ' ')"
    )
    return (
        f"array_join(filter({words}, word -> word NOT IN ({listed(['', *legal_forms])})), ' ')"
    )


def name_block(key: str, length: int = settings.BLOCK_LENGTH) -> str:
    """Leading characters two names must share to be compared at all."""
    return f"substring({key}, 1, {length})"


def amount_usd(text: str, strict: bool = False) -> str:
    """Amount text such as ``$1.31b`` as a double; expects lower case, unreadable text is NULL.

    Only digits and dots are read, so ``1.31e9`` counts as 1.319; ``strict`` turns such text
    into NULL instead.
    """
    scales = " ".join(
        f"WHEN endswith({text}, {quoted(suffix)}) THEN {factor!r}D"
        for suffix, factor in settings.MONEY_SCALES.items()
    )
    digits = f"try_cast(regexp_replace({text}, '[^0-9.]', '') AS DOUBLE)"
    amount = f"({digits} * CASE {scales} ELSE 1D END)"
    if strict:
        return f"CASE WHEN {text} RLIKE r'^\\$?[0-9,.]+\\s*[tbm]?$' THEN {amount} END"
    return amount


def translated(value: str, wording: Mapping[str, str] = settings.INDUSTRIES) -> str:
    """Exact lookup in a small fixed wording table, 'N/A' for anything else."""
    cases = " ".join(f"WHEN {quoted(old)} THEN {quoted(new)}" for old, new in wording.items())
    return f"CASE {value} {cases} ELSE {quoted(settings.NOT_AVAILABLE)} END"


def known_or_na(value: str, known: Iterable[str] = settings.COUNTRIES) -> str:
    """The value itself when listed, 'N/A' for anything else."""
    return f"CASE WHEN {value} IN ({listed(known)}) THEN {value} ELSE 'N/A' END"


def confidence(distance: str, threshold: int) -> str:
    return f"(1D - {distance} / {threshold})"
