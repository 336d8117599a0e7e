"""Published tables: map rows and rankings."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.address import display_street, geocode_query
from ..functions.classify import categorize, dictionary_index, is_admin_flagged, is_scored
from ..functions.dates import recency_cutoff
from ..functions.text import display_name, venue_of
from ..operators import geocode, ranking
from ..operators.select import first_by, latest_per_key
from ..operators.spread import encode_dictionary, spread_join
from ..session import materialise
from ..sources.published import Document, write_document
from ..sources.sinks import publish_metrics

KEY, DATE = "facility_id", "inspection_date"


def latest_scored(ins: DataFrame) -> DataFrame:
    """Newest scored inspection per facility; on one day the lowest score counts."""
    return latest_per_key(
        ins, [KEY], DATE, ["score", "inspection_id", "source", "purpose"],
        is_scored("score", "inspection_type"),
    )


def located_latest(ins: DataFrame, cache: DataFrame) -> DataFrame:
    """Latest scored rows with record counts and coordinates (NULL when not geocoded)."""
    counts = ins.filter("score IS NOT NULL").groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n_inspections"),
        F.count_if(is_scored("score", "inspection_type")).alias("n_scored"),
    )
    keyed = latest_scored(ins).join(counts, KEY, "left").withColumn(
        "query", geocode_query("street", "city", "zip5", "address")
    )
    return spread_join(keyed, geocode.resolved(cache), ["query"], "left")


def map_points(ins: DataFrame, cache: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """Latest rows inside the window that have a position, stacks pulled apart. ``latest`` is ``located_latest`` where several
    steps read it."""
    points = (located_latest(ins, cache) if latest is None else latest).filter(
        (F.col(DATE) >= recency_cutoff(ins, DATE))
        & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    )
    return geocode.unstack(points, "latitude", "longitude", [KEY])


def map_rows(ins: DataFrame, cache: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """One positional row per mapped facility, plus ``facility_id`` for audits."""
    coded = encode_dictionary(map_points(ins, cache, latest), "city", "c")
    return coded.select(
        KEY,
        F.col("restaurant_name").alias("n"),
        display_street("street").alias("a"),
        F.col("c").cast("int").alias("c"),
        F.col("zip5").alias("z"),
        F.col("lat_out").alias("y"),
        F.col("lon_out").alias("x"),
        F.col("score").cast("int").alias("s"),
        F.date_format(DATE, "yyyy-MM-dd").alias("d"),
        F.col("is_followup").cast("int").alias("f"),
        dictionary_index(categorize("restaurant_name"), V.CATEGORIES).alias("k"),
        F.col("n_inspections").alias("q"),
        (F.col("stack_n") - 1).cast("int").alias("u"),
    ).orderBy(F.desc("s"), KEY)


def map_header(ins: DataFrame, cache: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """One row: counts, the three dates, and what codes and bands of the rows stand for. Cities are as many as there are."""
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    latest = located_latest(ins, cache) if latest is None else latest
    metrics = publish_metrics(latest, ins, DATE, located)
    shown = latest.filter(located & (F.col(DATE) >= recency_cutoff(ins, DATE)))
    cities = F.array_sort(F.collect_set("city")).alias("cities")
    bands = [F.struct(F.lit(key).alias("key"), F.lit(label).alias("label"), F.lit(color).alias("color"),
                      F.lit(low).alias("lo"), F.lit(high).alias("hi")) for key, label, color, low, high in V.BANDS]
    return metrics.withColumn("cities", shown.agg(cities).scalar()).select(
        *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("generated", "data_through", "cutoff")],
        "recency_months", "n_ever", "n_total", "n_mapped", "cities",
        F.array(*[F.lit(c) for c in V.CATEGORIES]).alias("categories"), F.array(*bands).alias("buckets"))


def write_map(ins: DataFrame, cache: DataFrame, path: str) -> None:
    """The map document: high scores first, so that low ones are drawn last and lie on top."""
    latest = materialise(located_latest(ins, cache))
    rows = map_rows(ins, cache, latest).withColumns({"_first": -F.col("s"), "_then": F.col(KEY)}).drop(KEY)
    write_document(rows, map_header(ins, cache, latest), path, ["_first", "_then"])


def write_rankings(ranked: DataFrame, ins: DataFrame, path: str) -> None:
    """The ranking tables as a document, raw names and facility ids included, as the gate reads it."""
    header = ins.agg(F.date_format(recency_cutoff(ins, DATE), "yyyy-MM-dd").alias("cutoff"),
                     F.date_format(F.max(DATE), "yyyy-MM-dd").alias("data_through"))
    rows = ranked.withColumns({"_first": F.col("table"), "_then": F.col("rank")})
    write_document(rows, header, path, ["_first", "_then"])


def ranking_rows(document: Document) -> DataFrame:
    """The rows of a ranking document with their types."""
    kinds = {"rank": "int", "mean_score": "double", "n": "long", "min_score": "int", "max_score": "int", "latest_score": "int",
             "latest": "date"}
    return document.rows.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in RANKING_COLUMNS])


def ranking_profile(ins: DataFrame, legacy_followup_only: bool = False) -> DataFrame:
    """Facilities that may be ranked: enough routine scored records, the newest one recent.

    Compliance visits are not routine. ``legacy_followup_only`` drops follow-ups alone, for
    comparison with tables published under that rule.
    """
    wanted = F.col("purpose") == V.ROUTINE
    if legacy_followup_only:
        wanted = ~F.col("is_followup")
    routine = ins.filter(
        is_scored("score", "inspection_type") & ~is_admin_flagged("restaurant_name") & wanted
    )
    scores = ranking.score_profile(routine, KEY, "score", DATE)
    names = first_by(routine, [KEY], ["restaurant_name", "street", "city"],
                     [DATE, "score", "restaurant_name", "street", "city"])
    recent = ranking.eligible(scores, ins, DATE, V.MIN_RECORDS_BOTTOM)
    return recent.join(names, KEY).withColumns({
        "name": F.col("restaurant_name"),
        "street": display_street("street"),
        "category": categorize("restaurant_name"),
        "venue": venue_of("restaurant_name"),
    }).drop("restaurant_name")


RANKING_COLUMNS = ["table", "rank", KEY, "name", "category", "street", "city", "mean_score", "n",
                   "min_score", "max_score", "latest_score", "latest"]


def rankings(ins: DataFrame, k: int = V.RANKING_ROWS, legacy_followup_only: bool = False) -> DataFrame:
    """All four tables, raw names, with the facility id on every row."""
    profile = ranking_profile(ins, legacy_followup_only)
    tables = ranking.rank_tables(profile, KEY, "category", V.RESTAURANT, ["venue"], k=k)
    return tables.select(*RANKING_COLUMNS)


def for_readers(ranked: DataFrame) -> DataFrame:
    """The jurisdiction code goes off the name as the last step before publishing."""
    return ranked.withColumn("name", display_name("name"))
