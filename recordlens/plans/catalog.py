"""Registered queries over the shared test tables, each with its SQL where SQL can say it."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import fixed_values as V
from ..functions import address as AD
from ..functions import classify as C
from ..functions import dates as D
from ..functions import text as T
from ..functions.geo import GOLDEN_ANGLE
from ..operators import aggregate as AG
from ..operators import facets as FA
from ..operators import fetch as FE
from ..operators import geocode as G
from ..operators import merge as M
from ..operators import quality as Q
from ..operators import ranking as RK
from ..operators import reconcile as RC
from ..operators import resolve as R
from ..operators import select as S
from ..operators import spread as SP
from ..session import materialise
from ..sources import pages as PG
from ..sources import sinks as SK
from . import worlds as W

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def with_records(body: str) -> str:
    return f"WITH {W.RECORDS_SQL}{body}"


def scored() -> Column:
    return C.is_scored("score", "kind", "SCORED")


SCORED_SQL = "score IS NOT NULL AND score > 0 AND (kind IS NULL OR kind = 'SCORED')"
BAND_SQL = ("CASE WHEN {0} <= 69 THEN 'red' WHEN {0} <= 79 THEN 'orange' "
            "WHEN {0} <= 89 THEN 'yellow' WHEN {0} IS NOT NULL THEN 'green' END")
CUTOFF_SQL = "CAST((SELECT max(d) FROM records) - INTERVAL 18 MONTH AS DATE)"
LATEST_SQL = f"""
latest AS (
  SELECT * FROM records WHERE {SCORED_SQL}
  QUALIFY row_number() OVER (PARTITION BY entity ORDER BY d DESC, score, rid) = 1
)"""


# --- selection ---------------------------------------------------------------------

def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.latest_per_key(W.records(spark, sf_dir), ["entity"], "d", ["score", "rid"], scored())


@query("latest_per_key", with_records(f""", {LATEST_SQL}
SELECT entity, d, score, purpose, kind, rid FROM latest"""))
def latest_per_key(spark, sf_dir):
    return _latest(spark, sf_dir).select("entity", "d", "score", "purpose", "kind", "rid")


@query("latest_any_record", with_records("""
SELECT entity, d, rid, score FROM records
QUALIFY row_number() OVER (PARTITION BY entity ORDER BY d DESC, rid DESC) = 1"""))
def latest_any_record(spark, sf_dir):
    rows = W.records(spark, sf_dir)
    return S.latest_per_key(rows, ["entity"], "d", [S.desc("rid")]).select("entity", "d", "rid", "score")


@query("entity_profile", with_records("""
SELECT r.entity, f.score AS first_score, f.purpose AS first_purpose, f.kind AS first_kind,
       min(r.d) AS first_date, max(r.d) AS last_date, count(*) AS n_rows
FROM records r JOIN (
  SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY entity ORDER BY d, rid) = 1
) f USING (entity) GROUP BY ALL"""))
def entity_profile(spark, sf_dir):
    return S.entity_profile(
        W.records(spark, sf_dir), "entity",
        {"first_score": "score", "first_purpose": "purpose", "first_kind": "kind"}, "d", ["d", "rid"],
    )


@query("same_date_conflicts", """
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS d, CAST(floor(value) AS BIGINT) AS v FROM events),
m AS (SELECT * FROM e QUALIFY d = max(d) OVER (PARTITION BY user_id)),
c AS (SELECT user_id, d, v, count(*) AS n FROM m GROUP BY ALL)
SELECT user_id, d, CAST(sum(n) AS BIGINT) AS n_rows, string_agg(v || CASE WHEN n > 1 THEN ' x' || n ELSE '' END, ' / ' ORDER BY v)
         AS values_text, count(*) > 1 AS disagree
FROM c GROUP BY user_id, d HAVING sum(n) > 1""")
def same_date_conflicts(spark, sf_dir):
    e = W.table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").cast("date").alias("d"), F.floor("value").alias("v"))
    return S.same_date_conflicts(e, ["user_id"], "d", "v").drop("values")


@query("same_date_conflicts_large", """
WITH c AS (SELECT event_type, CAST(floor(value / 10) AS BIGINT) AS v, count(*) AS n FROM events GROUP BY ALL)
SELECT event_type, CAST(sum(n) AS BIGINT) AS n_rows, string_agg(v || CASE WHEN n > 1 THEN ' x' || n ELSE '' END, ' / ' ORDER BY v)
         AS values_text, count(*) > 1 AS disagree
FROM c GROUP BY event_type HAVING sum(n) > 1""")
def same_date_conflicts_large(spark, sf_dir):
    e = W.table(spark, sf_dir, "events").select(
        "event_type", F.lit("2024-01-01").cast("date").alias("d"), F.floor(F.col("value") / 10).alias("v"))
    return S.same_date_conflicts(e, ["event_type"], "d", "v").drop("values", "d")


@query("newest_version", """
SELECT conv_id, turn AS last_turn, role, md5(text) AS text_md5 FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role, text) = 1""")
def newest_version(spark, sf_dir):
    c = W.table(spark, sf_dir, "conversations")
    return S.newest_version(c, ["conv_id"], "turn", ["role", "text"]).select(
        "conv_id", F.col("turn").alias("last_turn"), "role", F.md5("text").alias("text_md5"))


# --- counts, bands, extents --------------------------------------------------------

@query("band_counts", with_records(f""", {LATEST_SQL},
counts AS (SELECT {BAND_SQL.format('score')} AS band, count(*) AS n FROM latest
           WHERE d >= {CUTOFF_SQL} GROUP BY 1)
SELECT position, b.band, coalesce(n, 0) AS n
FROM (VALUES (0, 'red'), (1, 'orange'), (2, 'yellow'), (3, 'green')) b(position, band)
LEFT JOIN counts USING (band)"""))
def band_counts(spark, sf_dir):
    rows = W.records(spark, sf_dir)
    recent = _latest(spark, sf_dir).filter(F.col("d") >= D.recency_cutoff(rows, "d"))
    return AG.band_counts(recent, "score")


@query("recent_latest", with_records(f""", {LATEST_SQL}
SELECT entity, d, score, {BAND_SQL.format('score')} AS band, {CUTOFF_SQL} AS cutoff
FROM latest WHERE d >= {CUTOFF_SQL}"""))
def recent_latest(spark, sf_dir):
    cutoff = D.recency_cutoff(W.records(spark, sf_dir), "d")
    return _latest(spark, sf_dir).filter(F.col("d") >= cutoff).select(
        "entity", "d", "score", C.band("score").alias("band"), cutoff.alias("cutoff"))


@query("three_bands", with_records("""
SELECT CASE WHEN score <= 69 THEN 'Red: 69 and below' WHEN score BETWEEN 70 AND 85 THEN 'Yellow: 70 to 85'
            WHEN score BETWEEN 86 AND 100 THEN 'Green: 86 to 100' ELSE 'Missing score' END AS score_group,
       count(*) AS n
FROM records GROUP BY 1"""))
def three_bands(spark, sf_dir):
    label = C.closed_band("score", part=3, missing=V.THREE_BANDS_MISSING[1])
    return AG.three_band_counts(W.records(spark, sf_dir), label)


@query("extent", with_records("""
SELECT min(d) AS first_date, max(d) AS last_date, count(*) AS n_rows, count(DISTINCT entity) AS n_keys
FROM records"""))
def extent(spark, sf_dir):
    return AG.extent(W.records(spark, sf_dir), "d", "entity")


@query("frequency", with_records("SELECT st, purpose, kind, count(*) AS n FROM records GROUP BY ALL"))
def frequency(spark, sf_dir):
    return AG.frequency(W.records(spark, sf_dir), ["st", "purpose", "kind"])


@query("duplicates", with_records("""
SELECT entity, d, count(*) AS n FROM records GROUP BY entity, d HAVING count(*) > 1"""))
def duplicates(spark, sf_dir):
    return AG.duplicates(W.records(spark, sf_dir), ["entity", "d"])


@query("null_counts", with_records("""
SELECT 'entity' AS "column", count(*) FILTER (WHERE entity IS NULL) AS n_null FROM records
UNION ALL SELECT 'score', count(*) FILTER (WHERE score IS NULL) FROM records
UNION ALL SELECT 'kind', count(*) FILTER (WHERE kind IS NULL) FROM records"""))
def null_counts(spark, sf_dir):
    return AG.null_counts(W.records(spark, sf_dir), ["entity", "score", "kind"])


@query("zero_audit", with_records("""
SELECT st, coalesce(kind, '(unknown)') AS kind, count(*) AS n FROM records WHERE score = 0 GROUP BY ALL"""))
def zero_audit(spark, sf_dir):
    zeros = W.records(spark, sf_dir).filter("score = 0")
    return AG.frequency(zeros.withColumn("kind", F.coalesce("kind", F.lit("(unknown)"))), ["st", "kind"])


@query("conditional_stats", with_records("""
SELECT entity, count(*) FILTER (WHERE NOT is_followup) AS n_plain,
       round_even(avg(score) FILTER (WHERE NOT is_followup), 2) AS mean_plain, max(d) AS latest
FROM records WHERE score > 0 GROUP BY entity"""))
def conditional_stats(spark, sf_dir):
    rows = W.records(spark, sf_dir).filter("score > 0")
    return AG.conditional_stats(rows, ["entity"], "score", "is_followup", "d")


# --- ranking -----------------------------------------------------------------------

PROFILE_SQL = with_records(f""",
pool AS (SELECT * FROM records WHERE {SCORED_SQL} AND purpose = 'Routine'),
scores AS (
  SELECT entity, count(*) AS n, round_even(avg(score), 2) AS mean_score, min(score) AS min_score,
         max(score) AS max_score, max(d) AS latest
  FROM pool GROUP BY entity),
newest AS (SELECT entity, score AS latest_score FROM pool
           QUALIFY row_number() OVER (PARTITION BY entity ORDER BY d DESC, score, rid) = 1),
profile AS (
  SELECT s.*, latest_score, c_nationkey AS venue, c_mktsegment AS category
  FROM scores s JOIN newest USING (entity) JOIN customer ON c_custkey = entity),
eligible AS (SELECT * FROM profile WHERE n >= 3 AND latest >= {CUTOFF_SQL})""")
RANK_COLS = ["entity", "mean_score", "n", "min_score", "max_score", "latest_score", "latest", "venue", "rank"]
RANK_SQL = """
SELECT entity, mean_score, n, min_score, max_score, latest_score, latest, venue,
       row_number() OVER (ORDER BY mean_score {d}, n DESC, latest DESC, entity) AS rank
FROM (SELECT * FROM eligible WHERE n >= {m}
      QUALIFY row_number() OVER (PARTITION BY venue ORDER BY mean_score {d}, n DESC, latest DESC, entity) = 1)
ORDER BY rank LIMIT {k}"""


def _eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = W.records(spark, sf_dir)
    pool = rows.filter(scored() & (F.col("purpose") == V.ROUTINE))
    profile = RK.eligible(RK.score_profile(pool, "entity", "score", "d"), rows, "d", 3)
    venues = W.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity"), F.col("c_nationkey").alias("venue"),
        F.col("c_mktsegment").alias("category"))
    return profile.join(venues, "entity")


@query("score_profile", PROFILE_SQL + """
SELECT entity, n, mean_score, min_score, max_score, latest, latest_score FROM scores JOIN newest USING (entity)""")
def score_profile(spark, sf_dir):
    pool = W.records(spark, sf_dir).filter(scored() & (F.col("purpose") == V.ROUTINE))
    return RK.score_profile(pool, "entity", "score", "d")


@query("top_ranked", PROFILE_SQL + RANK_SQL.format(d="DESC", m=5, k=10))
def top_ranked(spark, sf_dir):
    return RK.rank_table(_eligible(spark, sf_dir), "top", "entity", 5, ["venue"]).select(*RANK_COLS)


@query("bottom_ranked", PROFILE_SQL + RANK_SQL.format(d="ASC", m=3, k=10))
def bottom_ranked(spark, sf_dir):
    return RK.rank_table(_eligible(spark, sf_dir), "bottom", "entity", 3, ["venue"]).select(*RANK_COLS)


@query("audit_list", PROFILE_SQL + RANK_SQL.format(d="DESC", m=5, k=20))
def audit_list(spark, sf_dir):
    return RK.rank_table(
        _eligible(spark, sf_dir), "top", "entity", 5, ["venue"], V.AUDIT_ROWS).select(*RANK_COLS)


def _four_tables_sql() -> str:
    parts = []
    for scope, source in (("all", "eligible"), ("chosen", "(SELECT * FROM eligible WHERE category = 'BUILDING')")):
        for name, d, m in (("top", "DESC", 5), ("bottom", "ASC", 3)):
            body = RANK_SQL.format(d=d, m=m, k=10).replace("FROM eligible", f"FROM {source}")
            parts.append(f"(SELECT '{scope}_{name}' AS \"table\", * FROM ({body}))")
    return PROFILE_SQL + " UNION ALL ".join(parts)


@query("rank_tables", _four_tables_sql())
def rank_tables(spark, sf_dir):
    tables = RK.rank_tables(_eligible(spark, sf_dir), "entity", "category", "BUILDING", ["venue"])
    return tables.select("table", *RANK_COLS)


# --- merging -----------------------------------------------------------------------

def _two_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = W.records(spark, sf_dir).select("rid", "entity", "d", "score", "purpose", "kind", "st")
    return rows.filter(F.col("st").isin("O", "P")), rows.filter(F.col("st").isin("F", "O")).drop("kind")


MERGED_SQL = """,
merged AS (
  SELECT entity, d, score, rid, purpose, kind, source FROM (
    SELECT *, 'portal' AS source, 0 AS p FROM records WHERE st IN ('O', 'P')
    UNION ALL
    SELECT * REPLACE (NULL AS kind), 'batch', 1 FROM records WHERE st IN ('F', 'O'))
  QUALIFY row_number() OVER (PARTITION BY entity, d, score ORDER BY p, rid) = 1
)"""


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    portal, batch = _two_sources(spark, sf_dir)
    return M.union_dedupe([("portal", portal), ("batch", batch)], ["entity", "d", "score"], ["rid"])


@query("union_dedupe", with_records(MERGED_SQL + " SELECT * FROM merged"))
def union_dedupe(spark, sf_dir):
    return _merged(spark, sf_dir).select("entity", "d", "score", "rid", "purpose", "kind", "source")


@query("merge_loses_nothing", with_records(MERGED_SQL + """
SELECT entity, d, score FROM records WHERE st IN ('F', 'O') EXCEPT SELECT entity, d, score FROM merged"""))
def merge_loses_nothing(spark, sf_dir):
    return M.lost_keys(_two_sources(spark, sf_dir)[1], _merged(spark, sf_dir), ["entity", "d", "score"])


@query("lost_per_day_rule", with_records("""
SELECT entity, d, score FROM records WHERE st IN ('F', 'O')
EXCEPT SELECT entity, d, score FROM records WHERE st IN ('O', 'P')"""))
def lost_per_day_rule(spark, sf_dir):
    portal, batch = _two_sources(spark, sf_dir)
    return M.lost_keys(batch, portal, ["entity", "d", "score"])


@query("merge_report", with_records(MERGED_SQL + """,
before AS (SELECT * FROM records WHERE st IN ('F', 'O'))
SELECT count(*) AS n_rows, count(DISTINCT entity) AS n_keys, min(d) AS first_date, max(d) AS last_date,
       count(*) - (SELECT count(*) FROM before) AS rows_gained,
       CAST(max(d) - (SELECT max(d) FROM before) AS INTEGER) AS days_recovered,
       count(DISTINCT entity) FILTER (WHERE entity NOT IN (SELECT entity FROM before)) AS keys_gained
FROM merged"""))
def merge_report(spark, sf_dir):
    return M.merge_report(_two_sources(spark, sf_dir)[1], _merged(spark, sf_dir), "entity", "d")


@query("coalesce_attrs", """
WITH p AS (SELECT c_custkey AS id, CASE WHEN c_nationkey < 12 THEN c_name END AS name,
                  c_mktsegment AS segment FROM customer WHERE c_acctbal > 2000),
s AS (SELECT c_custkey AS id, upper(c_name) AS name, lower(c_mktsegment) AS segment
      FROM customer WHERE c_acctbal < 7000)
SELECT id, coalesce(p.name, s.name) AS name, coalesce(p.segment, s.segment) AS segment
FROM p FULL JOIN s USING (id)""")
def coalesce_attrs(spark, sf_dir):
    c = W.table(spark, sf_dir, "customer")
    primary = c.filter("c_acctbal > 2000").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_nationkey") < 12, F.col("c_name")).alias("name"),
        F.col("c_mktsegment").alias("segment"))
    secondary = c.filter("c_acctbal < 7000").select(
        F.col("c_custkey").alias("id"), F.upper("c_name").alias("name"),
        F.lower("c_mktsegment").alias("segment"))
    return M.coalesce_attrs(primary, secondary, "id", ["name", "segment"])


@query("annotate_missing", with_records("""
, lookup AS (SELECT l_orderkey AS rid, l_returnflag AS flag FROM lineitem
             QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                                        l_returnflag, l_shipdate) = 1)
SELECT rid, entity, coalesce(kind, flag) AS kind FROM records LEFT JOIN lookup USING (rid)"""))
def annotate_missing(spark, sf_dir):
    lines = W.table(spark, sf_dir, "lineitem").withColumn("rid", F.col("l_orderkey"))
    return M.annotate_missing(
        W.records(spark, sf_dir).select("rid", "entity", "kind"), lines, ["rid"],
        {"kind": "l_returnflag"},
        ["l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"])


REPARENT_SQL = """
, twins AS (SELECT c_nationkey, c_mktsegment, min(c_custkey) AS live FROM customer
            WHERE c_acctbal < 500 GROUP BY ALL),
mapping AS (SELECT c_custkey AS old_id, live AS new_id FROM customer JOIN twins USING (c_nationkey, c_mktsegment)
            WHERE c_acctbal < 500 AND c_custkey <> live)"""


def _mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = W.table(spark, sf_dir, "customer").filter("c_acctbal < 500")
    pair = ["c_nationkey", "c_mktsegment"]
    live = c.groupBy(*pair).agg(F.min("c_custkey").alias("new_id"))
    return c.join(live, pair).filter("c_custkey <> new_id").select(
        F.col("c_custkey").alias("old_id"), "new_id")


@query("reparent", with_records(REPARENT_SQL + """
SELECT rid, coalesce(new_id, entity) AS entity, d, score
FROM records LEFT JOIN mapping ON old_id = entity"""))
def reparent(spark, sf_dir):
    rows = W.records(spark, sf_dir).select("rid", "entity", "d", "score")
    return M.reparent(rows, "entity", _mapping(spark, sf_dir), "old_id", "new_id")


@query("chained_ids", """
SELECT o_orderkey AS old_id, o_custkey AS new_id FROM orders
WHERE o_custkey IN (SELECT o_orderkey FROM orders)""")
def chained_ids(spark, sf_dir):
    pairs = W.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("old_id"), F.col("o_custkey").alias("new_id"))
    return M.chained_ids(pairs, "old_id", "new_id")


# --- names, addresses, categories, dates -------------------------------------------

def _nested(expr: str, steps: list[tuple[str, str, str]]) -> str:
    for pattern, replacement, flags in steps:
        pattern, replacement = pattern.replace("'", "''"), replacement.replace("'", "''")
        expr = f"regexp_replace({expr}, '{pattern}', '{replacement}'{', ' + repr(flags) if flags else ''})"
    return expr


def _squish_sql(expr: str) -> str:
    return W.SQUISH_SQL.format(expr)


DISPLAY_SQL = _squish_sql("regexp_replace({0}, '^(PF|LW|BC|MN|WL|SV|RW)\\s*-\\s*', '')")
VENUE_SQL = _nested(
    _squish_sql("regexp_replace({0}, '/.*$', '')"),
    [(r"(?i)\s+(#|No\.?|Unit|Stand|Store)\s*[0-9]+\s*$", "", ""), (r"\s+[0-9]+\s*$", "", "")])


@query("name_keys", f"""
WITH {W.PLACES_SQL}
SELECT id, raw_name, {_squish_sql('raw_name')} AS squished,
       {DISPLAY_SQL.replace('{0}', 'raw_name')} AS shown, {VENUE_SQL.replace('{0}', 'raw_name')} AS venue,
       {W.NORM_NAME_SQL.format('raw_name')} AS k_name, {W.LOOSE_NAME_SQL.format('raw_name')} AS k_loose,
       regexp_replace(lower(raw_name), '[^a-z0-9]+', '', 'g') AS k_plain,
       {W.NORM_STREET_SQL.format('address')} AS k_street, {W.HOUSE_NUM_SQL.format('address')} AS k_num,
       nullif(regexp_extract(zip_code, '^([0-9]{{5}})', 1), '') AS zip5,
       CASE WHEN length(raw_name) > 20 THEN raw_name[1:17] || '...' ELSE raw_name END AS short_name,
       regexp_matches(raw_name, '(?i)^OOB\\b|INELIGIBLE') AS admin_flag
FROM places""")
def name_keys(spark, sf_dir):
    return W.places(spark, sf_dir).select(
        "id", "raw_name", T.squish("raw_name").alias("squished"), T.display_name("raw_name").alias("shown"),
        T.venue_of("raw_name").alias("venue"), T.norm_name("raw_name").alias("k_name"),
        T.loose_name("raw_name").alias("k_loose"), T.alnum_key("raw_name").alias("k_plain"),
        T.norm_street("address").alias("k_street"), T.house_num("address").alias("k_num"),
        T.zip5("zip_code").alias("zip5"), T.truncate("raw_name", 20).alias("short_name"),
        C.is_admin_flagged("raw_name").alias("admin_flag"))


CITY_SQL = "(" + "|".join(V.CITIES) + ")"


def _title_sql(expr: str) -> str:
    word = T.WORD.replace("'", "''")
    return (f"array_to_string(list_transform(regexp_extract_all({expr}, '({word}|[^\\p{{L}}\\p{{N}}_]+)', 1), "
            "lambda t: CASE WHEN t[1] = 'ß' THEN 'SS' ELSE upper(t[1]) END || lower(t[2:])), '')")


SHOUT_SQL = (
    "array_to_string(list_transform(regexp_extract_all({0}, '([A-Z]{{2,}}|[A-Z]|[^A-Z]+)', 1), "
    "lambda t: CASE WHEN regexp_matches(t, '^[A-Z]{{2,}}$') AND t NOT IN ("
    + ", ".join(f"'{w}'" for w in V.KEEP_UPPER)
    + ") THEN upper(t[1]) || lower(t[2:]) ELSE t END), '')"
)
STREET_SQL = _squish_sql(_nested(_squish_sql("address"), [
    (r"(?i),\s*[A-Za-z .]+,\s*TX,?\s*[0-9]{5}(-[0-9]{4})?(\s+[A-Za-z .]+)?$", "", ""),
    (rf"(?i)[,\s]+{CITY_SQL}$", "", "")]))
DISPLAY_STREET_1 = _nested(_squish_sql("street"), [
    (r"(?i)#?\s*\bBunit\b", " Unit", "g"), (r"(?i)\bUnit\s*#\s*", "Unit ", "g"),
    (r"(?i)\s*#?\s*\bUnit\s*$", "", ""), (r"#\s*#", "#", "g"), (r"\s*#\s*$", "", "")])
DISPLAY_STREET_2 = _squish_sql(_nested(
    SHOUT_SQL.format("ds1"),
    [(r"(?i)\bSvrd\b", "Service Rd", "g")]
    + [(rf"(?i)\b{w}(\s*[0-9])", rf"{w}\1", "g") for w in V.ROAD_DESIGNATORS]
    + [(rf"(?i)\b{w}\b", w, "g") for w in V.BOUND_SUFFIXES]
    + [(rf"\b{c}\b", c.upper(), "g") for c in "nsew"]))
NORMAL_STREET_SQL = _squish_sql(_nested(
    f"CASE WHEN NOT regexp_matches({_squish_sql('street')}, '[a-z]') "
    f"THEN {_title_sql(_squish_sql('street'))} ELSE {_squish_sql('street')} END",
    [(r"(?i)\s+B?unit\b.*$", "", ""),
     (r"(?i)\s+(Ste|Suite|Unit|Bldg|Building|Apt|Rm|Room|Fl|Floor|Lot|Space|Spc)\.?\s*[A-Za-z0-9&/-]*\.?$", "", ""),
     (r"\s+#\s*[A-Za-z0-9&/-]+$", "", ""), (r"(?i)\bSVRD\b", "Service Rd", "g"),
     (r"(?i)\s+\b(NB|SB|EB|WB)\b", "", "g"), (r"(?i)\bIH\s*-?\s*([0-9]+)", r"I-\1", "g"),
     (r"(?i)\bHwy\b", "Highway", "g"), (r"(?i)\bFM\s*-?\s*([0-9]+)", r"FM \1", "g")]))
TAIL_CITY_SQL = f"nullif(regexp_extract({_squish_sql('address')}, '(?i){CITY_SQL}$', 1), '')"
PREFIX_CITY_SQL = "CASE nullif(regexp_extract(raw_name, '^([A-Z]{2,4}) - ', 1), '') " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in V.NAME_PREFIX_CITY.items()) + " END"

ADDRESS_CTES = f"""
WITH {W.PLACES_SQL},
s1 AS (SELECT *, {STREET_SQL} AS street, {_title_sql(TAIL_CITY_SQL)} AS tail_city,
              nullif(regexp_extract(zip_code, '^([0-9]{{5}})', 1), '') AS zip5 FROM places),
s2 AS (SELECT *, coalesce(CASE WHEN tail_city = 'Bee Caves' THEN 'Bee Cave' ELSE tail_city END,
                          {PREFIX_CITY_SQL}, 'Austin') AS city,
              {DISPLAY_STREET_1} AS ds1, {NORMAL_STREET_SQL} AS street_norm,
              CASE WHEN zip5 IS NULL
                   THEN nullif(regexp_extract(coalesce(address, street), '\\b(7[0-9]{{4}})\\b', 1), '') END AS found
       FROM s1),
s3 AS (SELECT *, {DISPLAY_STREET_2} AS shown_street,
              CASE WHEN found IS NOT NULL
                   THEN {_squish_sql("regexp_replace(street_norm, ',?\\s*\\b' || found || '\\b\\s*$', '')")}
                   ELSE street_norm END AS key_street,
              coalesce(zip5, found) AS key_zip FROM s2),
s4 AS (SELECT *, {_squish_sql("key_street || ', ' || city || ', TX' || coalesce(', ' || key_zip, '')")} AS query,
              {_squish_sql("address || ', Austin, TX, ' || zip5")} AS legacy FROM s3)
"""


def _addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.places(spark, sf_dir).withColumns({
        "street": AD.street_only("address"), "city": AD.derive_city("address", "raw_name"),
        "zip5": T.zip5("zip_code"),
    }).withColumns({
        "street_norm": AD.normalize_street("street"),
        "query": AD.geocode_query("street", "city", "zip5", "address"),
        "legacy": AD.legacy_key("address", "zip5"),
    })


@query("address_rules", ADDRESS_CTES + """
SELECT id, address, city, street, shown_street, street_norm, zip5, query, legacy FROM s4""")
def address_rules(spark, sf_dir):
    return _addresses(spark, sf_dir).select(
        "id", "address", "city", "street", AD.display_street("street").alias("shown_street"),
        "street_norm", "zip5", "query", "legacy")


@query("title_case", f"""
SELECT doc_id, md5({_title_sql('text')}) AS titled FROM documents""")
def title_case(spark, sf_dir):
    return W.table(spark, sf_dir, "documents").select("doc_id", F.md5(T.title_case("text")).alias("titled"))


@query("squish_text", f"""
SELECT doc_id, md5({_squish_sql('text')}) AS squished, length({_squish_sql('text')}) AS n_chars_left,
       regexp_replace(lower(text), '[^a-z0-9]+', '', 'g') = '' AS no_letters FROM documents""")
def squish_text(spark, sf_dir):
    return W.table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(T.squish("text")).alias("squished"),
        F.length(T.squish("text")).cast("long").alias("n_chars_left"),
        (T.alnum_key("text") == "").alias("no_letters"))


def _category_sql(name: str) -> str:
    cases = "".join(f"WHEN {name} = '{k}' THEN '{v}' " for k, v in V.NAME_OVERRIDES.items())
    for label, patterns in V.CATEGORY_RULES:
        joined = "|".join(patterns).replace("'", "''")
        cases += f"WHEN regexp_matches(lower({name}), '{joined}') THEN '{label}' "
    return f"CASE {cases}ELSE '{V.RESTAURANT}' END"


@query("categorize", f"""
WITH {W.PLACES_SQL}, named AS (
  SELECT id, raw_name AS name FROM places
  UNION ALL SELECT p_partkey, p_name || ' ' || lower(p_type) FROM part
  UNION ALL SELECT page_id, url FROM pages
), c AS (SELECT *, {_category_sql('name')} AS category FROM named)
SELECT id, name, category, CAST(list_position([{', '.join(f"'{c}'" for c in V.CATEGORIES)}], category) - 1 AS INTEGER) AS code
FROM c""")
def categorize(spark, sf_dir):
    parts = W.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("name"))
    pages = W.table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("name"))
    named = W.places(spark, sf_dir).select("id", F.col("raw_name").alias("name")).unionByName(parts).unionByName(pages)
    coded = named.withColumn("category", C.categorize("name"))
    return coded.withColumn("code", C.dictionary_index("category", V.CATEGORIES))


@query("document_categories", f"""
SELECT {_category_sql('text')} AS category, count(*) AS n FROM documents GROUP BY 1""")
def document_categories(spark, sf_dir):
    docs = W.table(spark, sf_dir, "documents").withColumn("category", C.categorize("text"))
    return AG.frequency(docs, ["category"])


@query("date_rules", with_records("""
, days AS (SELECT DISTINCT d FROM records)
SELECT d, CAST(date_trunc('week', d + 1) AS DATE) - 1 AS week,
       ['Jan.','Feb.','March','April','May','June','July','Aug.','Sept.','Oct.','Nov.','Dec.'][month(d)]
         || ' ' || CAST(day(d) AS VARCHAR) || ', ' || CAST(year(d) AS VARCHAR) AS ap,
       monthname(d) || ' ' || CAST(day(d) AS VARCHAR) || ', ' || CAST(year(d) AS VARCHAR) AS long_form,
       CAST(d - INTERVAL 18 MONTH AS DATE) AS cutoff, d + 1 AS next_day
FROM days"""))
def date_rules(spark, sf_dir):
    days = W.records(spark, sf_dir).select("d").distinct()
    return days.select(
        "d", D.week_start("d").alias("week"), D.ap_date("d").alias("ap"), D.long_date("d").alias("long_form"),
        F.add_months("d", -V.RECENCY_MONTHS).alias("cutoff"), F.date_add("d", 1).alias("next_day"))


@query("number_rules", """
SELECT o_orderkey AS id, CAST(trunc(TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE)) AS INTEGER) AS whole,
       TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number,
       format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS grouped
FROM orders""")
def number_rules(spark, sf_dir):
    return W.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), T.to_int(F.col("o_totalprice").cast("string")).alias("whole"),
        T.to_int("o_orderpriority").alias("not_a_number"), T.thousands(F.floor("o_totalprice")).alias("grouped"))


# --- entity resolution -------------------------------------------------------------

def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, R.Events]:
    a, b = W.permit_side(spark, sf_dir), W.facility_side(spark, sf_dir)
    keyed = lambda df, n, s: df.withColumns({
        "k_name": T.norm_name(n), "k_street": T.norm_street(s), "k_num": T.house_num(s),
        "k_loose": T.loose_name(n)})
    events = R.Events(*W.side_events(spark, sf_dir), ("d", "score"))
    return keyed(a, "p_name", "p_addr"), keyed(b, "i_name", "i_addr"), events


def _tiered(spark: SparkSession, sf_dir: str) -> R.TierMatches:
    a, b, events = _sides(spark, sf_dir)
    return R.tier_match(a, b, "permit_id", "facility_id", V.MATCH_TIERS, events)


def _corroborated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What corroboration finds for the permits that no tier matched. Both read the sides as written once."""
    a, b, events = _sides(spark, sf_dir)
    a, b, events = materialise(a), materialise(b), R.Events(materialise(events.a), materialise(events.b), events.on)
    matched = R.tier_match(a, b, "permit_id", "facility_id", V.MATCH_TIERS, events).matched
    left = a.join(matched.select("permit_id"), "permit_id", "left_anti")
    return R.corroborated_match(
        left.withColumnRenamed("k_loose", "a_loose"), b.withColumnRenamed("k_loose", "b_loose"),
        "permit_id", "facility_id", ("k_street", "zip"), "a_loose", "b_loose", events)


SIDES = f"WITH {W.SIDES_SQL}"
MATCH_COLS = ["permit_id", "facility_id", "match_method", "confidence", "n_shared_events"]


@query("tier_match", SIDES + " SELECT * FROM tiered")
def tier_match(spark, sf_dir):
    return _tiered(spark, sf_dir).matched.select(*MATCH_COLS)


@query("tier_unresolved", SIDES + " SELECT permit_id, tier, block, n_candidates FROM unresolved")
def tier_unresolved(spark, sf_dir):
    return _tiered(spark, sf_dir).unresolved.select("permit_id", "tier", "block", "n_candidates")


@query("tier_members", SIDES + " SELECT DISTINCT tier, block, facility_id FROM counted WHERE n > 1")
def tier_members(spark, sf_dir):
    return _tiered(spark, sf_dir).members.select("tier", "block", "facility_id")


@query("corroborated_match", SIDES + " SELECT * FROM corroborated")
def corroborated_match(spark, sf_dir):
    return _corroborated(spark, sf_dir).select(*MATCH_COLS)


@query("corroborated_match_big_blocks", SIDES + " SELECT * FROM corroborated")
def corroborated_match_big_blocks(spark, sf_dir):
    """Blocks of every size take the one path of parts looked up by equality."""
    return _corroborated(spark, sf_dir).select(*MATCH_COLS)


@query("shared_counts", SIDES + """
SELECT permit_id, facility_id, CAST(coalesce(s, 0) AS INTEGER) AS n_shared_events
FROM (SELECT 'P' || CAST(c_custkey AS VARCHAR) AS permit_id, 'F' || CAST(c_custkey AS VARCHAR) AS facility_id
      FROM customer) LEFT JOIN shared USING (permit_id, facility_id)""")
def shared_counts(spark, sf_dir):
    _, _, events = _sides(spark, sf_dir)
    key = F.col("c_custkey").cast("string")
    pairs = W.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("P"), key).alias("permit_id"), F.concat(F.lit("F"), key).alias("facility_id"))
    return R.shared_counts(pairs, "permit_id", "facility_id", events)


HANDOFF_SQL = with_records(""",
fac AS (SELECT entity || ':' || CAST((year(d) - 1995) // 3 AS VARCHAR) AS facility_id, entity AS block,
               min(d) AS f_first, max(d) AS f_last FROM records GROUP BY ALL),
gaps AS (SELECT *, CAST(f_first - lag(f_last) OVER (PARTITION BY block ORDER BY f_first, facility_id) AS INTEGER) AS gap FROM fac),
chains AS (SELECT block, min(gap) AS gap_days, arg_max(facility_id, f_last) AS live FROM gaps
           GROUP BY block HAVING count(*) >= 2 AND min(gap) >= 150)""")


def _handoffs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = W.records(spark, sf_dir)
    era = F.floor((F.year("d") - 1995) / 3).cast("string")
    spans = rows.groupBy(
        F.concat(F.col("entity").cast("string"), F.lit(":"), era).alias("facility_id"), "entity"
    ).agg(F.min("d").alias("f_first"), F.max("d").alias("f_last")).withColumn("guard", F.lit("same"))
    permits = W.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("permit_id"),
        F.col("c_custkey").cast("string").alias("block"), F.col("c_name").alias("name"),
        F.lit("same").alias("guard"))
    members = spans.select(F.col("entity").cast("string").alias("block"), "facility_id")
    return R.handoff_merge(permits.select("permit_id", "block"), members, permits.drop("block"), spans,
                           "permit_id", "facility_id", "guard", "name", "f_first", "f_last")


@query("handoff_matches", HANDOFF_SQL + """
SELECT 'P' || CAST(block AS VARCHAR) AS permit_id, live AS facility_id, 'handoff' AS match_method
FROM chains JOIN customer ON c_custkey = block""")
def handoff_matches(spark, sf_dir):
    return _handoffs(spark, sf_dir)[0].select("permit_id", "facility_id", "match_method")


@query("handoff_merges", HANDOFF_SQL + """
SELECT facility_id AS old_id, live AS new_id, c_name AS business, gap_days
FROM chains JOIN fac USING (block) JOIN customer ON c_custkey = block WHERE facility_id <> live""")
def handoff_merges(spark, sf_dir):
    return _handoffs(spark, sf_dir)[1].select("old_id", "new_id", "business", "gap_days")


GUARD_SQL = """
WITH m AS (SELECT s_suppkey AS a_id, c_custkey AS b_id,
                  nullif(s_nationkey, 3) AS ga, nullif(c_nationkey, 4) AS gb
           FROM supplier JOIN customer ON s_suppkey = c_custkey),
checked AS (SELECT a_id, b_id, coalesce(ga <> gb, false) AS crosses FROM m)"""


def _guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = W.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("a_id"), F.nullif("s_nationkey", F.lit(3)).alias("guard"))
    b = W.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("b_id"), F.nullif("c_nationkey", F.lit(4)).alias("guard"))
    matched = a.select("a_id").join(b.select("b_id"), F.col("a_id") == F.col("b_id"))
    return R.guard_check(matched, a, b, "a_id", "b_id", "guard")


@query("guard_check", GUARD_SQL + " SELECT a_id, b_id, crosses FROM checked")
def guard_check(spark, sf_dir):
    return _guarded(spark, sf_dir)


@query("guard_demote", GUARD_SQL + """
SELECT 'demoted' AS outcome, a_id, b_id FROM checked WHERE crosses
UNION ALL SELECT 'kept', a_id, b_id FROM checked WHERE NOT crosses
UNION ALL SELECT 'merge', s_suppkey, b_id FROM supplier JOIN checked ON b_id = s_nationkey WHERE NOT crosses""")
def guard_demote(spark, sf_dir):
    merges = W.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("old_id"), F.col("s_nationkey").cast("long").alias("new_id"))
    kept, demoted, live = R.guard_demote(_guarded(spark, sf_dir), merges, "a_id", "b_id")
    tag = lambda df, label: df.withColumn("outcome", F.lit(label))
    return tag(demoted, "demoted").unionByName(tag(kept, "kept")).unionByName(
        tag(live.select(F.col("old_id").alias("a_id"), F.col("new_id").alias("b_id")), "merge")
    ).select("outcome", "a_id", "b_id")


UNMATCHED_SQL = SIDES + """,
first_seen AS (SELECT 'P' || CAST(entity AS VARCHAR) AS permit_id, min(d) AS first_seen FROM records GROUP BY 1),
rest AS (
  SELECT permit_id, 'P:' || permit_id AS facility_id, first_seen,
         CASE WHEN first_seen > (SELECT max(d) FROM records WHERE d < DATE '1996-01-01')
              THEN 'new_after_freeze' ELSE 'unmatched' END AS status
  FROM a JOIN first_seen USING (permit_id)
  WHERE permit_id NOT IN (SELECT permit_id FROM tiered))"""


def _unmatched(spark: SparkSession, sf_dir: str, matched: DataFrame) -> DataFrame:
    rows = W.records(spark, sf_dir)
    first = rows.groupBy(F.concat(F.lit("P"), F.col("entity").cast("string")).alias("permit_id")).agg(
        F.min("d").alias("first_seen"))
    permits = _sides(spark, sf_dir)[0].join(first, "permit_id")
    freeze = D.data_through(rows.filter(F.col("d") < "1996-01-01"), "d")
    return R.unmatched_status(permits, matched, "permit_id", "facility_id", "first_seen", freeze)


@query("unmatched_status", UNMATCHED_SQL + " SELECT permit_id, facility_id, first_seen, status FROM rest")
def unmatched_status(spark, sf_dir):
    return _unmatched(spark, sf_dir, _tiered(spark, sf_dir).matched).select(
        "permit_id", "facility_id", "first_seen", "status")


@query("review_queue", UNMATCHED_SQL + """,
stats AS (SELECT 'P' || CAST(entity AS VARCHAR) AS permit_id, count(*) AS n_routine,
                 round_even(avg(score), 1) AS mean_score
          FROM records WHERE purpose = 'Routine' GROUP BY 1),
q AS (SELECT DISTINCT permit_id, block, n_candidates, 'ambiguous_time_overlap' AS reason FROM unresolved
      UNION ALL SELECT permit_id, NULL, 0, 'no_key_match' FROM rest WHERE status = 'unmatched')
SELECT permit_id, block, n_candidates, reason, n_routine, mean_score,
       coalesce(n_routine >= 3 AND mean_score < 45, false) AS could_affect_rankings
FROM q LEFT JOIN stats USING (permit_id)""")
def review_queue(spark, sf_dir):
    tiers = _tiered(spark, sf_dir)
    stats = W.records(spark, sf_dir).filter(F.col("purpose") == V.ROUTINE).groupBy(
        F.concat(F.lit("P"), F.col("entity").cast("string")).alias("permit_id")
    ).agg(F.count(F.lit(1)).alias("n_routine"), F.bround(F.avg("score"), 1).alias("mean_score"))
    demoted = tiers.matched.select("permit_id", "facility_id").filter(F.lit(False))
    queue = R.review_queue(
        tiers.unresolved, demoted, _unmatched(spark, sf_dir, tiers.matched), stats, "permit_id", "facility_id",
        (F.col("n_routine") >= 3) & (F.col("mean_score") < 45))
    return queue.select("permit_id", "block", "n_candidates", "reason", "n_routine", "mean_score",
                        "could_affect_rankings")


@query("match_report", UNMATCHED_SQL + """,
xw AS (SELECT 'matched' AS status, match_method, confidence FROM tiered
       UNION ALL SELECT status, NULL, NULL FROM rest)
SELECT status, match_method, confidence, count(*) AS n,
       round_even(count(*) * 100 / (SELECT count(*) FROM xw), 1) AS pct FROM xw GROUP BY ALL""")
def match_report(spark, sf_dir):
    tiers = _tiered(spark, sf_dir)
    null = F.lit(None).cast("string")
    xw = tiers.matched.select(F.lit("matched").alias("status"), "match_method", "confidence").unionByName(
        _unmatched(spark, sf_dir, tiers.matched).select(
            "status", null.alias("match_method"), null.alias("confidence")))
    return R.match_report(xw)


# --- geocode cache and map ---------------------------------------------------------

CACHE_SQL = ADDRESS_CTES + """,
pos AS (SELECT s4.*, 30 + c_nationkey * 0.01::DOUBLE AS lat, -97 - c_nationkey * 0.02::DOUBLE AS lon, c_acctbal
        FROM s4 JOIN customer ON c_custkey = id),
cache AS (
  SELECT query, street_norm, city, zip5, latitude, longitude,
         CASE WHEN latitude IS NOT NULL THEN 'census' END AS source
  FROM (SELECT query, street_norm, city, zip5, CASE WHEN c_acctbal > 3000 THEN lat END AS latitude,
               CASE WHEN c_acctbal > 3000 THEN lon END AS longitude, id FROM pos WHERE c_acctbal > 1000)
  QUALIFY row_number() OVER (PARTITION BY query ORDER BY latitude IS NULL, latitude, longitude, id) = 1),
answers AS (
  SELECT query, CASE WHEN c_acctbal > 500 THEN lat + 1 END AS lat2, CASE WHEN c_acctbal > 500 THEN lon + 1 END AS lon2
  FROM pos WHERE c_acctbal < 2500
  QUALIFY row_number() OVER (PARTITION BY query ORDER BY lat2 IS NULL, lat2, lon2) = 1)
"""


def _positions(spark: SparkSession, sf_dir: str, places: DataFrame | None = None) -> DataFrame:
    c = W.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), "c_acctbal",
        (F.lit(30) + F.col("c_nationkey") * 0.01).alias("lat"),
        (F.lit(-97) - F.col("c_nationkey") * 0.02).alias("lon"))
    return (_addresses(spark, sf_dir) if places is None else places).join(c, "id")


def _cache(spark: SparkSession, sf_dir: str, places: DataFrame | None = None) -> DataFrame:
    known = F.col("c_acctbal") > 3000
    rows = _positions(spark, sf_dir, places).filter("c_acctbal > 1000").select(
        "query", "street_norm", "city", "zip5", F.when(known, F.col("lat")).alias("latitude"),
        F.when(known, F.col("lon")).alias("longitude"), "id")
    first = S.dedupe_prefer(rows, ["query"], [F.col("latitude").isNull(), "latitude", "longitude", "id"])
    return first.withColumn("source", F.when(F.col("latitude").isNotNull(), "census")).drop("id")


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("c_acctbal") > 500
    return _positions(spark, sf_dir).filter("c_acctbal < 2500").select(
        "query", F.when(found, F.col("lat") + 1).alias("latitude"),
        F.when(found, F.col("lon") + 1).alias("longitude"))


@query("geocode_pending", CACHE_SQL + """
SELECT DISTINCT query, street_norm, city, zip5 FROM s4
WHERE street_norm IS NOT NULL AND street_norm <> '' AND query NOT IN (SELECT query FROM cache)""")
def geocode_pending(spark, sf_dir):
    wanted = G.targets(_addresses(spark, sf_dir), ["query", "street_norm", "city", "zip5"])
    return G.pending(wanted, _cache(spark, sf_dir))


@query("geocode_seed", CACHE_SQL + """,
old AS (SELECT legacy AS full_address, lat, lon FROM pos WHERE legacy IS NOT NULL AND c_acctbal > 4000
        QUALIFY row_number() OVER (PARTITION BY legacy ORDER BY lat, lon) = 1)
SELECT query, street_norm, city, zip5, lat AS latitude, lon AS longitude, 'prior' AS source
FROM s4 JOIN old ON legacy = full_address
QUALIFY row_number() OVER (PARTITION BY query ORDER BY legacy, street_norm, city, zip5, lat, lon) = 1""")
def geocode_seed(spark, sf_dir):
    old = _positions(spark, sf_dir).filter("legacy IS NOT NULL AND c_acctbal > 4000").select(
        F.col("legacy").alias("full_address"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))
    cols = ["query", "street_norm", "city", "zip5", "latitude", "longitude", "source"]
    return G.seed_cache(_addresses(spark, sf_dir), old, "query", "legacy", cols)


@query("geocode_add_pass", CACHE_SQL + """
SELECT query, street_norm, city, zip5, latitude, longitude, source FROM (
  SELECT *, 0 AS p FROM cache
  UNION ALL
  SELECT query, street_norm, city, zip5, lat2, lon2, CASE WHEN lat2 IS NOT NULL THEN 'arcgis' END, 1
  FROM (SELECT DISTINCT query, street_norm, city, zip5 FROM pos) JOIN answers USING (query))
QUALIFY row_number() OVER (PARTITION BY query ORDER BY p, latitude IS NULL, latitude, longitude) = 1""")
def geocode_add_pass(spark, sf_dir):
    answers = G.one_per_query(_answers(spark, sf_dir).withColumn("source", F.lit("x"))).drop("source")
    keys = _addresses(spark, sf_dir).select("query", "street_norm", "city", "zip5").distinct()
    return G.add_pass(_cache(spark, sf_dir), keys.join(answers, "query"), "arcgis")


@query("geocode_retry_pass", CACHE_SQL + """
SELECT c.query, street_norm, city, zip5,
       CASE WHEN latitude IS NULL AND a.query IS NOT NULL THEN lat2 ELSE latitude END AS latitude,
       CASE WHEN latitude IS NULL AND a.query IS NOT NULL THEN lon2 ELSE longitude END AS longitude,
       CASE WHEN latitude IS NULL AND a.query IS NOT NULL
            THEN CASE WHEN lat2 IS NOT NULL THEN 'arcgis' END ELSE source END AS source
FROM cache c LEFT JOIN answers a ON a.query = c.query""")
def geocode_retry_pass(spark, sf_dir):
    return G.retry_pass(_cache(spark, sf_dir), _answers(spark, sf_dir), "arcgis")


@query("geocode_coverage", CACHE_SQL + """
SELECT city, count(*) AS n, count(*) FILTER (WHERE hit) AS n_hit,
       round_even(avg(CASE WHEN hit THEN 1 ELSE 0 END) * 100, 1) AS pct
FROM (SELECT city, query IN (SELECT query FROM cache WHERE latitude IS NOT NULL) AS hit FROM s4) GROUP BY city""")
def geocode_coverage(spark, sf_dir):
    places = materialise(_addresses(spark, sf_dir))
    marked = G.mark_cached(places, _cache(spark, sf_dir, places))
    return AG.coverage(marked, "mapped", ["city"])


@query("geocode_gaps", CACHE_SQL + """
SELECT city, count(*) AS n FROM s4
WHERE query NOT IN (SELECT query FROM cache WHERE latitude IS NOT NULL) GROUP BY city ORDER BY n DESC, city LIMIT 10""")
def geocode_gaps(spark, sf_dir):
    places = materialise(_addresses(spark, sf_dir))
    marked = G.mark_cached(places, _cache(spark, sf_dir, places))
    return AG.frequency(marked.filter("NOT mapped"), ["city"]).limit(10)


UNSTACK_SQL = f"""
WITH p AS (SELECT c_custkey AS id, 30 + c_nationkey * 0.01::DOUBLE AS lat, -97 - c_nationkey * 0.02::DOUBLE AS lon FROM customer),
i AS (SELECT *, row_number() OVER (PARTITION BY lat, lon ORDER BY id) - 1 AS i,
             count(*) OVER (PARTITION BY lat, lon) AS stack_n FROM p),
u AS (SELECT id, i, stack_n, lat, lon,
             round(lat + 7 * sqrt(i) * cos(i * {GOLDEN_ANGLE!r}) / 111320, 5) AS lat_out,
             round(lon + 7 * sqrt(i) * sin(i * {GOLDEN_ANGLE!r}) / (111320 * cos(radians(lat))), 5) AS lon_out FROM i)"""


def _unstacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = W.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), (F.lit(30) + F.col("c_nationkey") * 0.01).alias("lat"),
        (F.lit(-97) - F.col("c_nationkey") * 0.02).alias("lon"))
    return G.unstack(points, "lat", "lon", ["id"])


@query("spiral_offsets", UNSTACK_SQL + " SELECT id, i, stack_n, lat_out, lon_out FROM u")
def spiral_offsets(spark, sf_dir):
    return _unstacked(spark, sf_dir).select("id", "i", "stack_n", "lat_out", "lon_out")


@query("stack_stats", UNSTACK_SQL + """
SELECT count(*) FILTER (WHERE stack_n > 1) AS n_stacked, max(stack_n) AS largest_stack FROM u""")
def stack_stats(spark, sf_dir):
    return AG.stack_stats(_unstacked(spark, sf_dir))


@query("publish_metrics", with_records(f""", {LATEST_SQL},
f AS (SELECT d >= {CUTOFF_SQL} AS w, c_acctbal > 1000 AS located FROM latest JOIN customer ON c_custkey = entity)
SELECT count(*) AS n_ever, count(*) FILTER (WHERE w) AS n_total, count(*) FILTER (WHERE w AND located) AS n_mapped,
       count(*) FILTER (WHERE NOT w) AS n_excluded, count(*) FILTER (WHERE w AND NOT located) AS n_unmapped,
       (SELECT max(d) FROM records) AS data_through, {CUTOFF_SQL} AS cutoff FROM f"""))
def publish_metrics(spark, sf_dir):
    rows = W.records(spark, sf_dir)
    balances = W.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"), "c_acctbal")
    latest = _latest(spark, sf_dir).join(balances, "entity")
    return SK.publish_metrics(latest, rows, "d", F.col("c_acctbal") > 1000).drop("generated", "recency_months")


@query("payload_rows", f"""
WITH {W.PLACES_SQL}
SELECT id, '[' || to_json(raw_name) || ',' || CAST(id AS VARCHAR) || ',' || coalesce(to_json(zip_code), 'null') || ']' AS row
FROM places""")
def payload_rows(spark, sf_dir):
    return W.places(spark, sf_dir).select(
        "id", SK.json_array_row(["raw_name", "id", "zip_code"]).alias("row"))


@query("payload_read_back", f"""
WITH {W.PLACES_SQL} SELECT raw_name AS n, CAST(id AS VARCHAR) AS f, zip_code AS z FROM places""")
def payload_read_back(spark, sf_dir):
    rows = W.places(spark, sf_dir).select(SK.json_array_row(["raw_name", "id", "zip_code"]).alias("row"))
    return SK.read_json_rows(rows, "row", ["n", "f", "z"])


@query("ranking_records", PROFILE_SQL + f""",
r AS ({RANK_SQL.format(d="DESC", m=5, k=10)})
SELECT '{{"rank":' || rank || ',"entity":' || entity || ',"n":' || n || ',"latest":"' || strftime(latest, '%Y-%m-%d') || '"}}' AS record
FROM r""")
def ranking_records(spark, sf_dir):
    return SK.json_records(top_ranked(spark, sf_dir), ["rank", "entity", "n", "latest"])


@query("dictionary_codes", """
SELECT p_partkey, p_name, dense_rank() OVER (ORDER BY p_name) - 1 AS code FROM part""")
def dictionary_codes(spark, sf_dir):
    parts = W.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return SP.encode_dictionary(parts, "p_name", "code")


@query("facet_counts", with_records(f""", {LATEST_SQL},
k AS (SELECT {BAND_SQL.format('score')} AS band FROM latest JOIN customer ON c_custkey = entity
      WHERE c_mktsegment = 'BUILDING')
SELECT position, b.band, (SELECT count(*) FROM k WHERE k.band = b.band) AS n
FROM (VALUES (0, 'red'), (1, 'orange'), (2, 'yellow'), (3, 'green')) b(position, band)"""))
def facet_counts(spark, sf_dir):
    return AG.facet_counts(_banded(spark, sf_dir), "band", [b[0] for b in V.BANDS],
                           FA.facet_filter("c_mktsegment", "BUILDING"))


def _banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = W.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"), "c_mktsegment")
    return _latest(spark, sf_dir).join(segments, "entity").withColumn("band", C.band("score"))


@query("facet_visible", with_records(f""", {LATEST_SQL}
SELECT count(*) AS visible FROM latest JOIN customer ON c_custkey = entity
WHERE {BAND_SQL.format('score')} IN ('red', 'green')"""))
def facet_visible(spark, sf_dir):
    counts = AG.facet_counts(_banded(spark, sf_dir), "band", [b[0] for b in V.BANDS], FA.facet_filter("x", None))
    return FA.visible_total(counts, ["red", "green"])


@query("substring_search", """
SELECT p_partkey, p_name, p_brand FROM part
WHERE contains(lower(concat_ws(' ', p_name, p_brand, p_type)), 'ring brand#1') ORDER BY p_name, p_partkey LIMIT 8""")
def substring_search(spark, sf_dir):
    found = FA.search(W.table(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type"], " Ring Brand#1",
                      ["p_name", "p_partkey"])
    return found.select("p_partkey", "p_name", "p_brand")


@query("document_search", """
SELECT doc_id, source FROM documents WHERE contains(lower(concat_ws(' ', source, text)), 'the')
ORDER BY source, doc_id LIMIT 8""")
def document_search(spark, sf_dir):
    docs = W.table(spark, sf_dir, "documents")
    return FA.search(docs, ["source", "text"], "the", ["source", "doc_id"]).select("doc_id", "source")


# --- reconciliation ----------------------------------------------------------------

WEEKS_SQL = with_records(""",
w AS (SELECT CAST(date_trunc('week', d + 1) AS DATE) - 1 AS week, count(*) FILTER (WHERE st IN ('F', 'O')) AS left_n,
             count(*) FILTER (WHERE st IN ('O', 'P')) AS right_n FROM records GROUP BY 1),
weeks AS (SELECT *, right_n - left_n AS diff,
                 CASE WHEN left_n > 0 THEN round_even(right_n * 100 / left_n, 1) END AS pct FROM w)""")


def _weeks(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    portal, batch = _two_sources(spark, sf_dir)
    return RC.weekly_counts(batch, portal, "d", how=how)


@query("weekly_counts", WEEKS_SQL + " SELECT * FROM weeks WHERE left_n > 0 AND right_n > 0")
def weekly_counts(spark, sf_dir):
    return _weeks(spark, sf_dir)


@query("weekly_counts_full", WEEKS_SQL + " SELECT * FROM weeks WHERE left_n + right_n > 0")
def weekly_counts_full(spark, sf_dir):
    return _weeks(spark, sf_dir, "full")


@query("weekly_summary", WEEKS_SQL + """,
i AS (SELECT * FROM weeks WHERE left_n > 0 AND right_n > 0)
SELECT count(*) AS n_weeks, CAST(sum(left_n) AS BIGINT) AS left_total, CAST(sum(right_n) AS BIGINT) AS right_total,
       round_even(sum(right_n) * 100 / sum(left_n), 1) AS total_pct, count(*) FILTER (WHERE pct < 90) AS weeks_low,
       count(*) FILTER (WHERE pct > 110) AS weeks_high, median(pct) AS median_pct,
       count(*) > 10 AND median(pct) < 95 AS systematic FROM i""")
def weekly_summary(spark, sf_dir):
    return RC.weekly_summary(_weeks(spark, sf_dir))


@query("worst_weeks", WEEKS_SQL + """
SELECT * FROM weeks WHERE left_n > 0 AND right_n > 0 ORDER BY pct, week LIMIT 8""")
def worst_weeks(spark, sf_dir):
    return RC.worst_weeks(_weeks(spark, sf_dir))


@query("self_validation_guard", with_records(MERGED_SQL + """
SELECT count(*) FILTER (WHERE source = 'portal') AS n_audited,
       count(*) FILTER (WHERE source = 'portal') = 0 AS ok FROM merged"""))
def self_validation_guard(spark, sf_dir):
    return RC.self_validating_rows(_merged(spark, sf_dir), "source", "portal")


@query("compare_named", with_records(""",
named AS (SELECT r.*, c_name AS name FROM records r JOIN customer ON c_custkey = entity),
listed AS (SELECT DISTINCT c_name AS name FROM customer WHERE c_acctbal < 0),
ours AS (SELECT name, count(*) FILTER (WHERE NOT is_followup) AS our_n,
                round_even(avg(score) FILTER (WHERE NOT is_followup), 2) AS our_mean, max(d) AS our_latest
         FROM named WHERE st IN ('F', 'O') AND score > 0 AND name IN (SELECT name FROM listed) GROUP BY name),
theirs AS (SELECT name, count(*) AS their_n, round_even(avg(score), 2) AS their_mean, max(d) AS their_latest
           FROM named WHERE st IN ('O', 'P') AND NOT is_followup AND name IN (SELECT name FROM listed) GROUP BY name)
SELECT name, our_n, our_mean, our_latest, their_n, their_mean, their_latest,
       coalesce(their_latest > our_latest, false) AS newer
FROM ours LEFT JOIN theirs USING (name)"""))
def compare_named(spark, sf_dir):
    c = W.table(spark, sf_dir, "customer")
    names = c.select(F.col("c_custkey").alias("entity"), F.col("c_name").alias("name"))
    named = W.records(spark, sf_dir).join(names, "entity")
    listed = c.filter("c_acctbal < 0").select(F.col("c_name").alias("name"))
    return RC.compare_named(
        named.filter(F.col("st").isin("F", "O") & (F.col("score") > 0)), named.filter(F.col("st").isin("O", "P")),
        "name", listed, "score", "is_followup", "d")


@query("positive_control", """
SELECT 'ring' AS control, count(*) FILTER (WHERE regexp_matches(p_name, 'ring')) AS n,
       count(*) FILTER (WHERE regexp_matches(p_name, 'ring')) > 0 AS ok FROM part
UNION ALL SELECT 'absent name', count(*) FILTER (WHERE regexp_matches(p_name, 'absent name')),
       count(*) FILTER (WHERE regexp_matches(p_name, 'absent name')) > 0 FROM part""")
def positive_control(spark, sf_dir):
    return RC.positive_control(W.table(spark, sf_dir, "part"), "p_name", ["ring", "absent name"])


# --- fetch windows and landed pages ------------------------------------------------

LOG_SQL = """
WITH log AS (
  SELECT ts, CAST(user_id AS VARCHAR) AS "window",
         25 * (CAST(json_extract_string(props, '$.k') AS INTEGER) // 10) AS start,
         CASE event_type WHEN 'error' THEN 'fault' WHEN 'signup' THEN 'end' ELSE 'ok' END AS outcome,
         CASE event_type WHEN 'error' THEN 0 WHEN 'signup' THEN 0 WHEN 'click' THEN 10 ELSE 25 END AS n FROM events),
page AS (SELECT "window", start, max_by(n, (ts, n)) FILTER (WHERE outcome = 'ok') AS n,
                count(*) FILTER (WHERE outcome = 'fault') AS f FROM log GROUP BY ALL),
last AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY "window" ORDER BY ts DESC, start DESC, outcome DESC, n DESC) = 1),
audit AS (
  SELECT l."window", CASE WHEN l.outcome = 'end' OR (l.outcome = 'ok' AND l.n < 25) THEN 'done'
                        WHEN l.outcome = 'ok' AND l.start + 25 >= 225 THEN 'capped'
                        WHEN l.outcome = 'ok' THEN 'interrupted' ELSE 'failed' END AS state,
         CAST((SELECT coalesce(sum(n), 0) FROM page p WHERE p."window" = l."window") AS BIGINT) AS n,
         CAST((SELECT sum(f) FROM page p WHERE p."window" = l."window") AS BIGINT) AS n_faults
  FROM last l)"""


def _fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    return W.table(spark, sf_dir, "events").select(
        "ts", F.col("user_id").cast("string").alias("window"), (F.floor(k / 10) * 25).cast("int").alias("start"),
        F.when(kind == "error", "fault").when(kind == "signup", "end").otherwise("ok").alias("outcome"),
        F.when(kind.isin("error", "signup"), 0).when(kind == "click", 10).otherwise(25).alias("n"))


@query("window_audit", LOG_SQL + " SELECT * FROM audit")
def window_audit(spark, sf_dir):
    return FE.window_audit(_fetch_log(spark, sf_dir))


PLAN_SQL = """, bounds AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events),
plan AS (SELECT CAST(x AS DATE) AS from_day, least(CAST(x AS DATE) + 1, b) AS to_day
         FROM bounds, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 2 DAY)) u(x))"""


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("ts").cast("date")
    bounds = W.table(spark, sf_dir, "events").agg(F.min(day).alias("a"), F.max(day).alias("b"))
    return FE.window_plan(bounds, "a", "b")


@query("window_plan", LOG_SQL + PLAN_SQL + " SELECT * FROM plan")
def window_plan(spark, sf_dir):
    return _plan(spark, sf_dir)


@query("pending_windows", LOG_SQL + PLAN_SQL + """,
by_day AS (SELECT CAST(day(from_day) AS VARCHAR) AS key, from_day, to_day FROM plan)
SELECT key, from_day, to_day FROM by_day WHERE key NOT IN (SELECT "window" FROM audit WHERE state = 'done')""")
def pending_windows(spark, sf_dir):
    plan = _plan(spark, sf_dir).withColumn("key", F.day("from_day").cast("string"))
    return FE.pending_windows(plan, FE.window_audit(_fetch_log(spark, sf_dir)), "key", "window").select(
        "key", "from_day", "to_day")


@query("window_status", LOG_SQL + PLAN_SQL + """,
by_day AS (SELECT CAST(day(from_day) AS VARCHAR) AS key, from_day, to_day FROM plan),
surplus AS (SELECT CAST(user_id AS VARCHAR) AS key, count(*) - count(DISTINCT event_type) AS dup FROM events GROUP BY 1)
SELECT key, from_day, to_day, coalesce(state, 'planned') AS state, coalesce(n, 0) AS n, coalesce(dup, 0) AS dup,
       coalesce(n_faults, 0) AS n_faults
FROM by_day LEFT JOIN audit ON "window" = key LEFT JOIN surplus USING (key)""")
def window_status(spark, sf_dir):
    plan = _plan(spark, sf_dir).withColumn("key", F.day("from_day").cast("string"))
    ids = W.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("window"), "event_type")
    return FE.window_status(plan, FE.window_audit(_fetch_log(spark, sf_dir)), FE.duplicate_ids(ids, "window", "event_type"),
                            "key", "window")


def _fixed_names(part: str, names) -> str:
    values = ", ".join("('{}', {}, '{}')".format(part, i, n.replace("'", "''")) for i, n in enumerate(names))
    return f" UNION ALL SELECT * FROM (VALUES {values})"


@query("payload_header", "SELECT 'city' AS part, row_number() OVER (ORDER BY c) - 1 AS code, c AS name FROM "
       "(SELECT DISTINCT c_mktsegment AS c FROM customer WHERE c_mktsegment IS NOT NULL)"
       + _fixed_names("category", V.CATEGORIES) + _fixed_names("band", [b[0] for b in V.BANDS])
       + _fixed_names("field", V.MAP_FIELDS))
def payload_header(spark, sf_dir):
    return SK.payload_header(W.table(spark, sf_dir, "customer").select("c_mktsegment"), "c_mktsegment")


@query("incremental_start", with_records(" SELECT max(d) + 1 AS from_day FROM records"))
def incremental_start(spark, sf_dir):
    return FE.incremental_start(W.records(spark, sf_dir), "d")


@query("duplicate_ids", """
SELECT CAST(l_shipdate AS DATE) AS ship_day, CAST(count(*) - count(DISTINCT l_orderkey) AS BIGINT) AS dup
FROM lineitem GROUP BY 1""")
def duplicate_ids(spark, sf_dir):
    lines = W.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("ship_day"), "l_orderkey")
    return FE.duplicate_ids(lines, "ship_day", "l_orderkey")


PAGES_SQL = """
WITH raw AS (
  SELECT event_id, CASE WHEN value > 20 THEN 25 ELSE 0 END AS start,
         CASE event_type WHEN 'error' THEN '{"err":true,"msg":"bad request"}'
                         WHEN 'signup' THEN '<html>' || props
                         WHEN 'view' THEN CASE WHEN event_id % 5 = 0 THEN '[{"k":"a"}] junk' ELSE '[]' END ELSE '[' || props || ', {"other": 1}]' END AS body, props, event_type
  FROM events)"""


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, props = F.col("event_type"), F.col("props")
    body = (
        F.when(kind == "error", '{"err":true,"msg":"bad request"}')
        .when(kind == "signup", F.concat(F.lit("<html>"), props))
        .when(kind == "view", F.when(F.col("event_id") % 5 == 0, '[{"k":"a"}] junk').otherwise("[]"))
        .otherwise(F.concat(F.lit("["), props, F.lit(', {"other": 1}]')))
    )
    raw = W.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("value") > 20, 25).otherwise(0).alias("start"), body.alias("body"))
    record = StructType([StructField("k", StringType()), StructField("comments", StringType())])
    return PG.classify_pages(raw, record)


@query("landed_pages", PAGES_SQL + """
SELECT event_id, CASE WHEN event_type = 'signup' OR body LIKE '%junk' THEN 'fault'
                      WHEN event_type = 'error' THEN CASE WHEN start > 0 THEN 'end' ELSE 'fault' END
                      ELSE 'ok' END AS outcome,
       CASE WHEN event_type IN ('click', 'purchase') THEN 2 ELSE 0 END AS n,
       CASE WHEN event_type = 'signup' OR body LIKE '%junk' THEN 'nonjson:' || trim(body)
            WHEN event_type = 'error' AND start = 0 THEN 'object:err,msg' ELSE '' END AS note FROM raw""")
def landed_pages(spark, sf_dir):
    return _pages(spark, sf_dir).select("event_id", "outcome", "n", "note")


@query("page_records", PAGES_SQL + """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS comments FROM raw
WHERE event_type IN ('click', 'purchase')
UNION ALL SELECT event_id, NULL, NULL FROM raw WHERE event_type IN ('click', 'purchase')""")
def page_records(spark, sf_dir):
    return PG.page_records(_pages(spark, sf_dir), "event_id")


@query("quarantined_pages", PAGES_SQL + """
SELECT event_id, start, body, CASE WHEN event_type = 'error' THEN 'object:err,msg' ELSE 'nonjson:' || trim(body) END AS note
FROM raw WHERE event_type = 'signup' OR body LIKE '%junk' OR (event_type = 'error' AND start = 0)""")
def quarantined_pages(spark, sf_dir):
    return PG.quarantined(_pages(spark, sf_dir), "event_id", "start")


# --- quality gate ------------------------------------------------------------------

CHECKS_SQL = with_records(MERGED_SQL + f""",
checks AS (
  SELECT 'rows present' AS label, CASE WHEN (SELECT count(*) FROM merged) > 0 THEN 0 ELSE 1 END AS n_bad
  UNION ALL SELECT 'entity present', count(*) FILTER (WHERE entity IS NULL) FROM merged
  UNION ALL SELECT 'score in range', count(*) FILTER (WHERE NOT coalesce(score BETWEEN 1 AND 100, false)) FROM merged
  UNION ALL SELECT 'kind known', count(*) FILTER (WHERE NOT coalesce(kind = 'SCORED', false)) FROM merged
  UNION ALL SELECT 'unique observations', count(*) FROM (SELECT 1 FROM merged GROUP BY entity, d, score HAVING count(*) > 1)
  UNION ALL SELECT 'one record per day', count(*) FROM (SELECT 1 FROM merged GROUP BY entity, d HAVING count(*) > 1)
  UNION ALL SELECT 'nothing lost', count(*) FROM (
    SELECT entity, d, score FROM records WHERE st IN ('F', 'O') EXCEPT SELECT entity, d, score FROM merged))""")


def _checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged, batch = _merged(spark, sf_dir), _two_sources(spark, sf_dir)[1]
    return Q.run_checks([
        Q.not_empty("rows present", merged),
        Q.RowChecks(merged, {"entity present": F.col("entity").isNotNull(),
                             "score in range": F.col("score").between(1, 100),
                             "kind known": F.col("kind") == "SCORED"}),
        Q.no_duplicates("unique observations", merged, ["entity", "d", "score"]),
        Q.no_duplicates("one record per day", merged, ["entity", "d"]),
        Q.EmptyCheck("nothing lost", M.lost_keys(batch, merged, ["entity", "d", "score"])),
    ])


@query("checks", CHECKS_SQL + " SELECT label, n_bad = 0 AS ok, CAST(n_bad AS BIGINT) AS n_bad FROM checks")
def checks(spark, sf_dir):
    return _checks(spark, sf_dir)


@query("verdict", CHECKS_SQL + """
SELECT count(*) AS n_run, count(*) FILTER (WHERE n_bad = 0) AS n_passed, count(*) FILTER (WHERE n_bad > 0) AS n_failed,
       count(*) FILTER (WHERE n_bad > 0) = 0 AS ok FROM checks""")
def verdict(spark, sf_dir):
    return Q.verdict(_checks(spark, sf_dir))


@query("display_name_checks", f"""
WITH {W.PLACES_SQL}, named AS (SELECT DISTINCT raw_name FROM places),
s AS (SELECT raw_name, {DISPLAY_SQL.replace('{0}', 'raw_name')} AS shown FROM named),
t AS (SELECT *, {DISPLAY_SQL.replace('{0}', 'shown')} AS twice FROM s),
k AS (SELECT *, {_category_sql('raw_name')} AS c1, {_category_sql('shown')} AS c2 FROM t),
r AS (SELECT 'display name keeps the category' AS label, count(*) FILTER (WHERE c1 <> c2) AS n_bad FROM k
      UNION ALL SELECT 'only a leading code is stripped', count(*) FILTER (WHERE NOT regexp_matches(raw_name,
        '^(PF|LW|BC|MN|WL|SV|RW)\\s*-\\s*') AND shown <> {_squish_sql('raw_name')}) FROM k
      UNION ALL SELECT 'display name is idempotent', count(*) FILTER (WHERE twice <> shown) FROM k
      UNION ALL SELECT 'display name is never empty', count(*) FILTER (WHERE length(shown) = 0) FROM k)
SELECT label, n_bad = 0 AS ok, n_bad FROM r""")
def display_name_checks(spark, sf_dir):
    names = W.places(spark, sf_dir).select("raw_name").distinct()
    shown = T.display_name("raw_name")
    coded = F.rlike("raw_name", F.lit(rf"^({'|'.join(V.DISPLAY_CITY_CODES)})\s*-\s*"))
    return Q.run_checks([Q.display_name_rules(
        names, "raw_name", shown, T.display_name(shown), C.categorize("raw_name"), C.categorize(shown), coded)])


@query("geocode_key_checks", ADDRESS_CTES + f""",
p AS (SELECT *, {_squish_sql("street_norm || ', ' || city || ', TX, ' || zip5")} AS plain,
             regexp_extract_all(query, '\\b(7[0-9]{{4}})\\b', 1) AS zips FROM s4),
r AS (SELECT 'keys with a ZIP are unchanged' AS label, count(*) FILTER (WHERE zip5 IS NOT NULL AND query <> plain) AS n_bad FROM p
      UNION ALL SELECT 'no key is NULL', count(*) FILTER (WHERE query IS NULL) FROM p
      UNION ALL SELECT 'no ZIP stands twice in a key', count(*) FILTER (WHERE len(zips) > len(list_distinct(zips))) FROM p)
SELECT label, n_bad = 0 AS ok, n_bad FROM r""")
def geocode_key_checks(spark, sf_dir):
    places = _addresses(spark, sf_dir)
    plain = T.squish(F.concat("street_norm", F.lit(", "), "city", F.lit(", TX, "), "zip5"))
    return Q.run_checks([Q.geocode_key_rules(places, F.col("zip5"), F.col("query"), plain)])


@query("text_marker_check", """
WITH r AS (SELECT count(*) FILTER (WHERE contains(text || ' ' || lang || ' ' || source, 'license')) AS n_bad FROM documents)
SELECT 'no text holds the marker' AS label, n_bad = 0 AS ok, n_bad FROM r""")
def text_marker_check(spark, sf_dir):
    docs = W.table(spark, sf_dir, "documents")
    return Q.run_checks([Q.free_of("no text holds the marker", docs, "license")])


@query("ranking_rederived", PROFILE_SQL + f""",
r AS ({RANK_SQL.format(d="DESC", m=5, k=10)}),
t AS (SELECT entity, round_even(sum(score) / count(*), 2) AS mean_score, count(*) AS n, min(score) AS min_score,
             max(score) AS max_score, max_by(score, (d, -score)) AS latest_score, max(d) AS latest
      FROM records WHERE {SCORED_SQL} AND purpose = 'Routine' GROUP BY entity),
x AS (SELECT entity, mean_score, n, min_score, max_score, latest_score, latest, c_nationkey AS venue
      FROM t JOIN customer ON c_custkey = entity WHERE n >= 5 AND latest >= {CUTOFF_SQL}),
v AS (SELECT x.* FROM x WHERE NOT EXISTS (
        SELECT 1 FROM x y WHERE y.venue = x.venue AND (y.mean_score, y.n, y.latest, -y.entity)
                                                    > (x.mean_score, x.n, x.latest, -x.entity))),
k AS (SELECT *, row_number() OVER (ORDER BY mean_score DESC, n DESC, latest DESC, entity) AS rank FROM v
      ORDER BY rank LIMIT 10),
bad AS (SELECT * FROM ((SELECT * FROM r EXCEPT SELECT * FROM k) UNION ALL (SELECT * FROM k EXCEPT SELECT * FROM r)))
SELECT 'ranking reproduces in order' AS label, count(*) = 0 AS ok, count(*) AS n_bad FROM bad""")
def ranking_rederived(spark, sf_dir):
    """The published ranking against an independent plan: windows over joined rows."""
    published = top_ranked(spark, sf_dir)
    rows = W.records(spark, sf_dir)
    derived = spark.sql("""
      WITH pool AS (SELECT * FROM {records} WHERE score > 0 AND (kind IS NULL OR kind = 'SCORED')
                    AND purpose = 'Routine'),
      t AS (SELECT p.entity, bround(avg(score), 2) AS mean_score, count(*) AS n, min(score) AS min_score,
                   max(score) AS max_score, max_by(score, struct(d, -score)) AS latest_score, max(d) AS latest,
                   first(c_nationkey) AS venue
            FROM pool p JOIN {customer} ON c_custkey = p.entity GROUP BY p.entity),
      e AS (SELECT * FROM t WHERE n >= 5 AND latest >= add_months((SELECT max(d) FROM {records}), -18)),
      s AS (SELECT *, row_number() OVER (PARTITION BY venue ORDER BY mean_score DESC, n DESC, latest DESC, entity) AS slot FROM e),
      k AS (SELECT * FROM s WHERE slot = 1 ORDER BY mean_score DESC, n DESC, latest DESC, entity LIMIT 10)
      SELECT entity, mean_score, n, min_score, max_score, latest_score, latest, venue,
             row_number() OVER (ORDER BY mean_score DESC, n DESC, latest DESC, entity) AS rank FROM k""", records=rows, customer=W.table(spark, sf_dir, "customer"))
    return Q.run_checks([Q.same_ranking("ranking reproduces in order", published, derived)])


@query("verification_sheet", PROFILE_SQL + f""",
r AS ({RANK_SQL.format(d="DESC", m=5, k=10)}),
h AS (SELECT x.*, r.rank, r.mean_score AS published_mean, r.n AS published_n,
             coalesce({SCORED_SQL} AND purpose = 'Routine', false) AS counted
      FROM records x JOIN r USING (entity)),
m AS (SELECT entity, count(*) FILTER (WHERE counted) AS k, avg(score) FILTER (WHERE counted) AS a FROM h GROUP BY entity)
SELECT rank, entity, rid, d, score, counted, published_mean,
       round_even(a, 2) = published_mean AND k = published_n AS matches
FROM h JOIN m USING (entity)""")
def verification_sheet(spark, sf_dir):
    published = top_ranked(spark, sf_dir)
    counts = scored() & (F.col("purpose") == V.ROUTINE)
    return Q.verification_sheet(published, W.records(spark, sf_dir), "entity", "score", counts).select(
        "rank", "entity", "rid", "d", "score", "counted", "published_mean", "matches")
