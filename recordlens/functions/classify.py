"""Scoring predicates, bands and the establishment category."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V
from .text import _c


def is_scored(
    score: Column | str, kind: Column | str | None = None, scored_kind: str = V.SCORED_TYPE
) -> Column:
    """A real score: present, above zero, and of the scored kind where the kind is known."""
    ok = _c(score).isNotNull() & (_c(score) > 0)
    if kind is not None:
        ok = ok & (_c(kind).isNull() | (_c(kind) == scored_kind))
    return ok


def is_admin_flagged(name: Column | str, pattern: str = V.ADMIN_FLAG_PATTERN) -> Column:
    return F.rlike(_c(name), F.lit(pattern))


def band(
    value: Column | str,
    breaks: Sequence[float] = tuple(b[4] for b in V.BANDS[:-1]),
    labels: Sequence[str] = tuple(b[0] for b in V.BANDS),
) -> Column:
    """Right-closed bands: the first label covers everything up to the first break."""
    if len(labels) != len(breaks) + 1:
        raise ValueError("need exactly one label more than breaks")
    value = _c(value)
    out = None
    for limit, label in zip(breaks, labels):
        test, result = value <= limit, F.lit(label)
        out = F.when(test, result) if out is None else out.when(test, result)
    rest = F.lit(labels[-1])
    return F.when(value.isNotNull(), rest if out is None else out.otherwise(rest))


def closed_band(
    value: Column | str,
    bands: Sequence[tuple] = V.THREE_BANDS,
    part: int = 2,
    missing: str | None = None,
) -> Column:
    """Bands with both ends closed; a value in a gap between two bands is missing."""
    value = _c(value)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for entry in bands:
        low, high = entry[0], entry[1]
        inside = value <= high if low is None else value.between(low, high)
        out = out.when(inside, F.lit(entry[part]))
    return out.otherwise(F.lit(missing))


def rule_cascade(
    value: Column | str,
    rules: Sequence[tuple[str, Sequence[str]]],
    overrides: dict[str, str] | None = None,
    default: str | None = None,
) -> Column:
    """Exact overrides first, then the first rule with a pattern found in the lower-cased text."""
    value = _c(value)
    lowered = F.lower(value)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for exact, label in (overrides or {}).items():
        out = out.when(value == exact, F.lit(label))
    for label, patterns in rules:
        out = out.when(F.rlike(lowered, F.lit("|".join(patterns))), F.lit(label))
    return out.otherwise(F.lit(default))


def categorize(name: Column | str) -> Column:
    return rule_cascade(name, V.CATEGORY_RULES, V.NAME_OVERRIDES, V.RESTAURANT)


def dictionary_index(value: Column | str, levels: Sequence[str]) -> Column:
    """Zero-based position of ``value`` in a fixed list of levels, NULL when absent."""
    position = F.array_position(F.array(*[F.lit(x) for x in levels]), _c(value))
    return F.when(position > 0, (position - 1).cast("int"))
