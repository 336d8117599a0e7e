"""The geocode cache, brought up to date pass by pass."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.address import geocode_query, legacy_key, normalize_street
from ..operators import geocode as G
from ..operators.aggregate import coverage
from ..session import dealt

COLS = S.GEOCODE_CACHE.fieldNames()
FIRST, SECOND = "census", "arcgis"


@dataclass(frozen=True)
class Refreshed:
    cache: DataFrame    # one row per key
    unsolved: DataFrame  # keys that no pass could place


def distinct_addresses(ins: DataFrame) -> DataFrame:
    """The places of ``ins``, once each: keys and caches depend on nothing else, and their rules are long.

    Dealt anew, or the optimizer would leave the deduplication out where another one follows the rules.
    """
    return dealt(ins.select("street", "city", "zip5", "address").distinct())


def keyed_addresses(ins: DataFrame) -> DataFrame:
    """``ins`` with its normalised street, its cache key and the key of the first geocoding pass."""
    return ins.withColumns({
        "street_norm": normalize_street("street"),
        "query": geocode_query("street", "city", "zip5", "address"),
        "legacy": legacy_key("address", "zip5"),
    })


def refresh_cache(
    keyed: DataFrame, cache: DataFrame | None, legacy: DataFrame, first: DataFrame, second: DataFrame
) -> Refreshed:
    """Seed a cache that does not exist yet, take in the first provider's answers for keys that are not cached, and
    the second one's for keys that are still without coordinates.

    ``first`` and ``second`` hold a provider's answers (query, latitude, longitude; NULL where it found nothing).
    Answers to keys that were not asked for are ignored.
    """
    places = [c for c in COLS if c not in ("latitude", "longitude", "source")]
    wanted = G.targets(keyed, places)
    if cache is None:
        cache = G.seed_cache(keyed, legacy, "query", "legacy", COLS)
    cache = G.one_per_query(cache)
    asked = G.pending(wanted, cache)
    answers = G.one_per_query(first.withColumn("source", F.lit(FIRST))).drop("source")
    added = G.add_pass(cache, asked.join(answers, "query").select(*places, "latitude", "longitude"), FIRST)
    full = G.retry_pass(added, second, SECOND)
    known = G.resolved(full).select("query")
    return Refreshed(full, wanted.join(known, "query", "left_anti"))


def coverage_by_source(keyed: DataFrame, cache: DataFrame) -> DataFrame:
    """Distinct keys per pass that placed them (NULL: none did), with their share."""
    keys = G.targets(keyed, ["query"]).join(G.one_per_query(cache).select("query", "source"), "query", "left")
    counts = keys.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    total = keys.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("pct", F.bround(F.col("n") * 100 / total, 1))


def coverage_by_city(keyed: DataFrame, cache: DataFrame) -> DataFrame:
    return coverage(G.mark_cached(keyed, cache), "mapped", ["city"])
