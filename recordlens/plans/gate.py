"""The publication gate: every published claim re-derived or checked."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.address import display_street, geocode_query, normalize_street
from ..functions.classify import categorize, is_admin_flagged, is_scored
from ..functions.dates import data_through, recency_cutoff
from ..functions.text import display_name, house_num, squish, venue_of
from ..operators import quality as Q
from ..operators.merge import lost_keys, reparent
from ..sources.published import Document
from .publish import DATE, KEY, latest_scored


def inspection_checks(ins: DataFrame) -> list:
    latest = latest_scored(ins)
    restaurant = categorize("restaurant_name") == V.RESTAURANT
    market = F.rlike("restaurant_name", F.lit(r"(?i)\bmarket"))
    mandola = F.rlike("restaurant_name", F.lit("(?i)mandola"))
    typed_zero = (F.col("score") == 0) & (F.col("inspection_type") == V.SCORED_TYPE)
    # An entity whose newest record is a zero must still be listed if it ever had a real score.
    scored_once = ins.groupBy(KEY).agg(
        F.count_if(is_scored("score", "inspection_type")).alias("n")
    ).filter("n > 0")
    return [
        Q.not_empty("inspection table is not empty", ins),
        Q.RowChecks(ins, {
            "no row lacks a facility id": F.col(KEY).isNotNull(),
            "no row lacks a name": F.col("restaurant_name").isNotNull(),
            "no zero is typed as a scored inspection": ~F.coalesce(typed_zero, F.lit(False)),
        }, key=(KEY, DATE, "score")),
        Q.no_duplicates("no observation stands twice", ins, [KEY, DATE, "score"]),
        Q.RowChecks(latest, {
            "no zero survives latest-per-facility": F.col("score") > 0,
            "no market is ranked as a restaurant": ~(restaurant & market) | mandola,
        }, key=(KEY,)),
        Q.EmptyCheck("a zero never hides an earlier real score",
                     lost_keys(scored_once, latest, [KEY])),
        Q.ValueCheck("cutoff is anchored to the data",
                     ins.agg(F.max(DATE).alias("newest"))
                     .withColumn("cutoff", recency_cutoff(ins, DATE)),
                     F.col("cutoff") == F.add_months("newest", -V.RECENCY_MONTHS)),
    ]


def no_loss_checks(export: DataFrame, merges: DataFrame, ins: DataFrame) -> list:
    live = reparent(export, KEY, merges, "old_facility_id", "new_facility_id")
    known = live.filter("score IS NOT NULL")
    return [Q.EmptyCheck("no export observation is lost", lost_keys(known, ins, [KEY, DATE, "score"]))]


def document_checks(document: Document) -> list:
    """The published map as it was written: every claim is taken from its own header and rows."""
    header = document.header
    rows = document.rows.withColumn("s", F.col("s").cast("int"))
    colours = ",".join(str(b.get("color")) for b in header["buckets"])
    return [
        Q.RowChecks(rows, {
            "no zero on the map": F.col("s") > 0,
            "every map row is inside the stated window": F.col("d") >= header["cutoff"],
            "no map row is later than the stated data": F.col("d") <= header["data_through"],
        }, key=("n", "a")),
        Q.ValueCheck("map rows equal the stated count", rows.agg(F.count(F.lit(1)).alias("n")),
                     F.col("n") == header["n_mapped"]),
        Q.ValueCheck("band colours are the published ones", rows.sparkSession.range(1).select(F.lit(colours).alias("colours")),
                     F.col("colours") == ",".join(b[2] for b in V.BANDS)),
        Q.RowChecks(rows, {"map carries no inspector comments": ~F.contains(
            F.concat_ws(" ", *header["fields"]), F.lit(V.COMMENT_MARKER))}, key=("n", "a")),
    ]


def map_checks(rows: DataFrame, metrics: DataFrame, ins: DataFrame) -> list:
    cutoff = F.date_format(recency_cutoff(ins, DATE), "yyyy-MM-dd")
    through = F.date_format(data_through(ins, DATE), "yyyy-MM-dd")
    return [
        Q.RowChecks(rows, {
            "no zero on the map": F.col("s") > 0,
            "every map row is inside the window": F.col("d") >= cutoff,
            "no map row is later than the data": F.col("d") <= through,
        }),
        Q.ValueCheck("map rows equal the stated count",
                     rows.agg(F.count(F.lit(1)).alias("n"))
                     .withColumn("stated", metrics.select("n_mapped").scalar()),
                     F.col("n") == F.col("stated")),
        Q.free_of("map carries no inspector comments", rows, V.COMMENT_MARKER),
    ]


def name_and_key_checks(ins: DataFrame) -> list:
    names = ins.select("restaurant_name").distinct()
    shown = display_name("restaurant_name")
    coded = F.rlike("restaurant_name", F.lit(rf"^({'|'.join(V.DISPLAY_CITY_CODES)})\s*-\s*"))
    places = ins.select(KEY, "street", "city", "zip5", "address").distinct()
    plain = squish(F.concat(normalize_street("street"), F.lit(", "), "city",
                            F.lit(f", {V.STATE}, "), "zip5"))
    return [
        Q.display_name_rules(names, "restaurant_name", shown, display_name(shown),
                             categorize("restaurant_name"), categorize(shown), coded),
        Q.geocode_key_rules(places, F.col("zip5"),
                            geocode_query("street", "city", "zip5", "address"), plain),
    ]


REDERIVED = """
WITH pool AS (
  SELECT * FROM {ins}
  WHERE score > 0 AND (inspection_type IS NULL OR inspection_type = :scored) AND purpose = :routine
    AND NOT restaurant_name RLIKE :admin),
oldest AS (
  SELECT *, row_number() OVER (PARTITION BY facility_id
    ORDER BY inspection_date NULLS LAST, score, restaurant_name NULLS LAST, street NULLS LAST, city NULLS LAST) AS place
  FROM pool),
newest AS (SELECT *, row_number() OVER (PARTITION BY facility_id ORDER BY inspection_date DESC, score) AS place FROM pool),
totals AS (
  SELECT facility_id, bround(sum(score) / count(score), 2) AS mean_score, count(*) AS n, min(score) AS min_score,
         max(score) AS max_score, max(inspection_date) AS latest
  FROM pool GROUP BY facility_id),
entries AS (
  SELECT t.*, w.score AS latest_score, o.restaurant_name, o.street, o.city
  FROM totals t JOIN oldest o ON o.facility_id = t.facility_id AND o.place = 1
       JOIN newest w ON w.facility_id = t.facility_id AND w.place = 1
  WHERE t.latest >= add_months((SELECT max(inspection_date) FROM {ins}), -:months))
SELECT * FROM entries"""


def rederived_rankings(ins: DataFrame, k: int = V.RANKING_ROWS) -> DataFrame:
    """The ranking tables by another plan: joined windows and sums in SQL, one table after the other."""
    entries = ins.sparkSession.sql(
        REDERIVED, args={"scored": V.SCORED_TYPE, "routine": V.ROUTINE, "admin": V.ADMIN_FLAG_PATTERN,
                         "months": V.RECENCY_MONTHS}, ins=ins,
    ).withColumns({"category": categorize("restaurant_name"), "venue": venue_of("restaurant_name"),
                   "street": display_street("street")}).withColumnRenamed("restaurant_name", "name")
    tables = None
    for scope in ("all", "chosen"):
        for side, least in (("top", V.MIN_RECORDS_TOP), ("bottom", V.MIN_RECORDS_BOTTOM)):
            rows = entries.filter(F.col("n") >= least)
            if scope == "chosen":
                rows = rows.filter(F.col("category") == V.RESTAURANT)
            order = [F.desc("mean_score") if side == "top" else F.asc("mean_score"), F.desc("n"), F.desc("latest"), KEY]
            slot = F.row_number().over(Window.partitionBy("venue").orderBy(*order))
            best = rows.withColumn("_slot", slot).filter("_slot = 1").orderBy(*order).limit(k)
            ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(*order))).withColumn(
                "table", F.lit(f"{scope}_{side}"))
            tables = ranked if tables is None else tables.unionByName(ranked)
    return tables


def ranking_checks(published: DataFrame, ins: DataFrame) -> list:
    """``published`` is the ranking table as written and read back, with raw names."""
    low, high = recency_cutoff(ins, DATE), data_through(ins, DATE)
    least = F.when(F.col("table").endswith("top"), V.MIN_RECORDS_TOP).otherwise(V.MIN_RECORDS_BOTTOM)
    of_readers = F.col("table").startswith("chosen")
    return [
        Q.same_ranking("rankings reproduce in order", published, rederived_rankings(ins)),
        Q.RowChecks(published, {
            "every ranked entity has enough routine records": F.col("n") >= least,
            "restaurant tables hold restaurants only":
                ~of_readers | (categorize("name") == V.RESTAURANT),
            "no administrative name is ranked": ~is_admin_flagged("name"),
            "no ranked entity is outside the window": F.col("latest").between(low, high),
        }, key=("table", "rank")),
        Q.no_duplicates("one slot per operator",
                        published.withColumn("venue", venue_of("name")), ["table", "venue"]),
        Q.no_duplicates("no two ranked rows read alike",
                        published.withColumn("shown", display_name("name")),
                        ["table", "shown", "street"]),
        Q.free_of("rankings carry no inspector comments", published, V.COMMENT_MARKER),
    ]


def crosswalk_checks(crosswalk: DataFrame) -> list:
    matched = crosswalk.filter((F.col("status") == "matched") & F.col("i_addr_raw").isNotNull())
    ours, theirs = house_num("p_addr_raw"), house_num("i_addr_raw")
    return [
        Q.no_duplicates("one crosswalk row per permit", crosswalk, ["permitID"]),
        Q.RowChecks(matched, {
            "no permit is matched to another street number":
                ours.isNull() | theirs.isNull() | (ours == theirs),
        }, key=("permitID",)),
    ]
