"""Stores and published documents as registered queries: written by one step, read back by the next, some of them damaged.

Importing this module adds the queries to the catalog.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as V
from ..operators import fetch as FE
from ..functions.classify import categorize
from ..operators import geocode as GE
from ..operators import quality as Q
from ..operators.compare import differences
from ..operators.search_index import SearchIndex
from ..operators.spread import by_distinct
from ..session import materialise
from ..sources.published import read_document
from ..sources.sinks import append_stamped
from ..sources.snapshots import Snapshots
from ..sources.state_log import StateLog
from ..sources.tables import read_geocode_cache
from . import gate, publish, resolved  # noqa: F401
from . import worlds as W
from .catalog import ADDRESS_CTES, LOG_SQL, PLAN_SQL, _addresses, _category_sql, _fetch_log, _plan, with_records
from .whole import MAP_SQL, ORACLE, QUERIES, RANKED_SQL, _cache, _merged, _new_path, query

# --- newest versions in buckets -----------------------------------------------------

VISIT = T.StructType([T.StructField("visitor", T.StringType()), T.StructField("seen", T.StringType()),
                      T.StructField("kind", T.StringType()), T.StructField("event", T.LongType())])

UPSERT_SQL = """
WITH visits AS (SELECT CAST(user_id AS VARCHAR) AS visitor, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen, event_type AS kind,
                       event_id AS event FROM events),
early AS (SELECT * FROM visits WHERE event % 2 = 0
          QUALIFY row_number() OVER (PARTITION BY visitor ORDER BY seen DESC, kind, event) = 1),
newest AS (SELECT * FROM visits QUALIFY row_number() OVER (PARTITION BY visitor ORDER BY seen DESC, kind, event) = 1)
"""


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("visitor"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen"),
        F.col("event_type").alias("kind"), F.col("event_id").alias("event"))


def _upserted(spark: SparkSession, sf_dir: str) -> tuple[Snapshots, DataFrame]:
    """Even events, then odd ones, then the odd ones again."""
    store = Snapshots(_new_path(spark, "visits"), VISIT, "visitor", "seen", ["kind", "event"])
    visits = _visits(spark, sf_dir)
    reports = None
    for step, rest in enumerate((0, 1, 1), 1):
        report = store.upsert(visits.filter(F.col("event") % 2 == rest)).withColumn("step", F.lit(step))
        reports = report if reports is None else reports.unionByName(report)
    return store, reports


@query("upserted_snapshot", UPSERT_SQL + " SELECT * FROM newest")
def upserted_snapshot(spark, sf_dir):
    return _upserted(spark, sf_dir)[0].read(spark)


@query("upsert_report", UPSERT_SQL + """,
n AS (SELECT (SELECT count(*) FROM early) AS a, (SELECT count(*) FROM newest) AS b,
             (SELECT count(*) FROM early JOIN newest USING (visitor) WHERE early.event <> newest.event) AS changed,
             (SELECT count(*) FROM visits WHERE event % 2 = 0) AS even, (SELECT count(*) FROM visits WHERE event % 2 = 1) AS odd)
SELECT 1 AS step, 1 AS version, 0 AS n_before, even AS n_incoming, a AS n_new, 0 AS n_updated, 0 AS n_unchanged, a AS n_after,
       true AS rewrites FROM n
UNION ALL SELECT 2, 2, a, odd, b - a, changed, a - changed, b, true FROM n
UNION ALL SELECT 3, 2, b, odd, 0, 0, b, b, false FROM n""")
def upsert_report(spark, sf_dir):
    """Counts before and after; the replay rewrites no bucket and makes no version."""
    return _upserted(spark, sf_dir)[1].withColumn("rewrites", F.col("buckets_rewritten") > 0).drop("buckets_rewritten")


# --- the state of fetch windows -----------------------------------------------------

WINDOW = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("from_day", T.DateType()), T.StructField("to_day", T.DateType()),
    T.StructField("state", T.StringType()), T.StructField("n", T.LongType()), T.StructField("dup", T.LongType()),
    T.StructField("n_faults", T.LongType())])

STORED_SQL = LOG_SQL + PLAN_SQL + """,
by_day AS (SELECT CAST(day(from_day) AS VARCHAR) AS key, from_day, to_day FROM plan),
surplus AS (SELECT CAST(user_id AS VARCHAR) AS key, count(*) - count(DISTINCT event_type) AS dup FROM events GROUP BY 1),
stored AS (SELECT key, from_day, to_day, coalesce(state, 'planned') AS state, coalesce(n, 0) AS n, coalesce(dup, 0) AS dup,
                  coalesce(n_faults, 0) AS n_faults FROM by_day LEFT JOIN audit ON "window" = key LEFT JOIN surplus USING (key))
"""


def _window_log(spark: SparkSession, sf_dir: str) -> StateLog:
    """The planner's windows are committed, then what the audit of the request log says of them."""
    log = StateLog(_new_path(spark, "windows"), WINDOW, "key")
    plan = materialise(_plan(spark, sf_dir).withColumn("key", F.day("from_day").cast("string")))
    none = F.lit(0).cast("long")
    version = log.commit(plan.select("key", "from_day", "to_day", F.lit("planned").alias("state"), none.alias("n"),
                                     none.alias("dup"), none.alias("n_faults")), log.version(spark))
    stored = log.states(spark).select("key", "from_day", "to_day")
    ids = W.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("window"), "event_type")
    log.commit(FE.window_status(stored, FE.window_audit(_fetch_log(spark, sf_dir)),
                                FE.duplicate_ids(ids, "window", "event_type"), "key", "window"), version)
    return log


@query("stored_windows", STORED_SQL + """
SELECT *, CASE WHEN state = 'planned' AND n = 0 AND dup = 0 AND n_faults = 0 THEN 1 ELSE 2 END AS version FROM stored""")
def stored_windows(spark, sf_dir):
    """The state of every window and the commit that brought it."""
    return _window_log(spark, sf_dir).states(spark)


@query("stored_windows_pending", STORED_SQL + " SELECT key, from_day, to_day FROM stored WHERE state <> 'done'")
def stored_windows_pending(spark, sf_dir):
    """What the next run has to fetch, from the store alone."""
    return _window_log(spark, sf_dir).states(spark).filter("state <> 'done'").select("key", "from_day", "to_day")


# --- the published map --------------------------------------------------------------

NAMED_SQL = MAP_SQL + """,
named AS (SELECT row_number() OVER (ORDER BY s DESC, facility_id) - 1 AS place, n, a, z, y, x, s, d, f, q, u,
                 levels[c + 1] AS city, kinds[k + 1] AS category
          FROM map_rows, (SELECT list(DISTINCT city ORDER BY city) AS levels FROM pts), (SELECT {} AS kinds))
""".format(W._sql_list(V.CATEGORIES))


def _document(spark: SparkSession, sf_dir: str):
    ins = _merged(spark, sf_dir)
    path = _new_path(spark, "map")
    publish.write_map(ins, materialise(_cache(ins)), path)
    return read_document(spark, path)


@query("map_document", NAMED_SQL + " SELECT * FROM named")
def map_document(spark, sf_dir):
    """The map as it was published: order, positions of fields and codes are taken from the document."""
    document = _document(spark, sf_dir)
    kinds = {"y": "double", "x": "double", "s": "int", "f": "int", "q": "long", "u": "int"}
    decode = lambda names, code: F.element_at(F.array(*[F.lit(x) for x in names]), F.col(code).cast("int") + 1)
    return document.rows.select(
        "place", *[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in ("n", "a", "z", "y", "x", "s", "d", "f", "q", "u")],
        decode(document.header["cities"], "c").alias("city"), decode(document.header["categories"], "k").alias("category"))


@query("map_document_header", MAP_SQL + """
SELECT strftime(m, '%Y-%m-%d') AS data_through, strftime(CAST(m - INTERVAL 18 MONTH AS DATE), '%Y-%m-%d') AS cutoff,
       18 AS recency_months, (SELECT count(*) FROM last) AS n_ever,
       (SELECT count(*) FROM last WHERE inspection_date >= CAST(m - INTERVAL 18 MONTH AS DATE)) AS n_total,
       (SELECT count(*) FROM pts) AS n_mapped, (SELECT string_agg(DISTINCT city, '|' ORDER BY city) FROM pts) AS cities,
       '""" + "|".join(f"{b[0]} {b[2]} {b[3]} {b[4]}" for b in V.BANDS) + "' AS bands, '" + "|".join(V.MAP_FIELDS) + """' AS fields
FROM newest""")
def map_document_header(spark, sf_dir):
    header = _document(spark, sf_dir).header
    row = [header[c] for c in ("data_through", "cutoff", "recency_months", "n_ever", "n_total", "n_mapped")]
    row += ["|".join(header["cities"]), "|".join(f"{b['key']} {b['color']} {b['lo']} {b['hi']}" for b in header["buckets"]),
            "|".join(header["fields"])]
    return spark.createDataFrame([tuple(row)], "data_through string, cutoff string, recency_months int, n_ever long, "
                                 "n_total long, n_mapped long, cities string, bands string, fields string")


def _audit_sql(rows: str, stated: str, colours_ok: str) -> str:
    """The six claims with the number of rows against each, and the three smallest names of such rows."""
    claims = (("no zero on the map", "s <= 0"), ("every map row is inside the stated window", "d < low"),
              ("no map row is later than the stated data", "d > high"),
              ("map carries no inspector comments", "contains(concat_ws(' ', n, a, z, d), 'CFM')"))
    rows_sql = " UNION ALL ".join(
        f"""SELECT '{label}' AS label, count(*) FILTER ({bad}) AS n_bad, (SELECT string_agg(w, '; ' ORDER BY w) FROM (
              SELECT DISTINCT n || '|' || coalesce(a, 'NULL') AS w FROM {rows}, limits WHERE {bad} ORDER BY w LIMIT 3)) AS detail
            FROM {rows}, limits""" for label, bad in claims)
    return f""",
limits AS (SELECT strftime(CAST(m - INTERVAL 18 MONTH AS DATE), '%Y-%m-%d') AS low, strftime(m, '%Y-%m-%d') AS high FROM newest),
audit AS ({rows_sql}
  UNION ALL SELECT 'map rows equal the stated count', CASE WHEN count(*) = {stated} THEN 0 ELSE 1 END,
    CASE WHEN count(*) <> {stated} THEN 'n=' || count(*) END FROM {rows}
  UNION ALL SELECT 'band colours are the published ones', CASE WHEN {colours_ok} THEN 0 ELSE 1 END,
    CASE WHEN NOT {colours_ok} THEN 'colours={",".join(b[2] for b in reversed(V.BANDS))}' END)
SELECT label, n_bad = 0 AS ok, n_bad, detail FROM audit"""


@query("gate_document", MAP_SQL + _audit_sql("map_rows", "(SELECT count(*) FROM pts)", "true"))
def gate_document(spark, sf_dir):
    return Q.run_detailed(gate.document_checks(_document(spark, sf_dir)))


DAMAGED_SQL = MAP_SQL + """,
damaged AS (SELECT * REPLACE (CASE WHEN length(n) % 5 = 0 THEN 0 ELSE s END AS s,
                              CASE length(n) % 7 WHEN 0 THEN '1990-01-01' WHEN 1 THEN '2990-01-01' ELSE d END AS d,
                              CASE WHEN length(n) % 11 = 0 THEN a || ' CFM' ELSE a END AS a) FROM map_rows)"""


@query("gate_document_damaged", DAMAGED_SQL + _audit_sql("damaged", "(SELECT count(*) + 1 FROM pts)", "false"))
def gate_document_damaged(spark, sf_dir):
    """A document with damaged rows, another count, other colours and its fields in another order, written and audited."""
    ins = _merged(spark, sf_dir)
    cache = materialise(_cache(ins))
    latest = materialise(publish.located_latest(ins, cache))
    size = F.length("n")
    rows = publish.map_rows(ins, cache, latest).drop(publish.KEY).withColumns({
        "s": F.when(size % 5 == 0, 0).otherwise(F.col("s")),
        "d": F.when(size % 7 == 0, "1990-01-01").when(size % 7 == 1, "2990-01-01").otherwise(F.col("d")),
        "a": F.when(size % 11 == 0, F.concat("a", F.lit(" CFM"))).otherwise(F.col("a"))})
    header = publish.map_header(ins, cache, latest).withColumns({
        "n_mapped": F.col("n_mapped") + 1, "buckets": F.reverse("buckets")})
    path = _new_path(spark, "map")
    mixed = rows.select(*reversed(rows.columns))
    publish.write_document(mixed.withColumn("_then", F.xxhash64(*mixed.columns)), header, path, ["_then"])
    return Q.run_detailed(gate.document_checks(read_document(spark, path)))


# --- the published rankings ---------------------------------------------------------

@query("ranking_document", RANKED_SQL + " SELECT * EXCLUDE (venue) FROM ranked")
def ranking_document(spark, sf_dir):
    ins = _merged(spark, sf_dir)
    path = _new_path(spark, "rankings")
    publish.write_rankings(materialise(publish.rankings(ins)), ins, path)
    return publish.ranking_rows(read_document(spark, path))


RANK_DAMAGE_SQL = RANKED_SQL + """,
bad AS (SELECT "table", rank, CASE WHEN rank = 2 THEN 'X' ELSE facility_id END AS facility_id,
               CASE WHEN rank = 3 THEN mean_score + 1 ELSE mean_score END AS mean_score,
               CASE WHEN rank = 3 THEN NULL ELSE name END AS name FROM ranked WHERE rank <> 1
        UNION ALL SELECT "table", 11, facility_id, mean_score, name FROM ranked WHERE rank = 1),
report AS (
  SELECT "table", rank, 'missing' AS status, NULL AS columns FROM ranked WHERE rank = 1
  UNION ALL SELECT "table", rank, 'extra', NULL FROM bad WHERE rank = 11
  UNION ALL SELECT "table", rank, 'changed', CASE rank WHEN 2 THEN 'facility_id' ELSE 'name,mean_score' END FROM bad
  WHERE rank IN (2, 3))"""


def _damaged_rankings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A published ranking with damage, and the inspections it should come from."""
    ins = _merged(spark, sf_dir)
    rank = F.col("rank")
    bad = publish.rankings(ins).withColumns({
        "facility_id": F.when(rank == 2, "X").otherwise(F.col("facility_id")),
        "mean_score": F.when(rank == 3, F.col("mean_score") + 1).otherwise(F.col("mean_score")),
        "name": F.when(rank != 3, F.col("name")), "rank": F.when(rank == 1, 11).otherwise(rank)})
    path = _new_path(spark, "rankings")
    publish.write_rankings(materialise(bad), ins, path)
    return publish.ranking_rows(read_document(spark, path)), ins


@query("ranking_differences", RANK_DAMAGE_SQL + " SELECT * FROM report")
def ranking_differences(spark, sf_dir):
    """Table, rank and columns in which a damaged ranking differs from one worked out anew."""
    published, ins = _damaged_rankings(spark, sf_dir)
    return differences(published, gate.rederived_rankings(ins).select(*published.columns), ["table", "rank"])


@query("gate_rankings_damaged", RANK_DAMAGE_SQL + """,
told AS (SELECT "table" || '|' || rank || '|' || status || '|' || coalesce(columns, 'NULL') AS w FROM report)
SELECT 'rankings reproduce in order' AS label, count(*) = 0 AS ok, count(*) AS n_bad,
       CASE WHEN count(*) > 0 THEN array_to_string(list(w ORDER BY w)[1:3], '; ') END AS detail FROM told""")
def gate_rankings_damaged(spark, sf_dir):
    published, ins = _damaged_rankings(spark, sf_dir)
    return Q.run_detailed(gate.ranking_checks(published, ins)[:1])


# --- a gate that finds something ----------------------------------------------------

@query("checks_detailed", with_records("""
, r AS (
  SELECT 'a score is at least 5' AS label, CAST(entity AS VARCHAR) || '|' || d AS w FROM records WHERE score < 5
  UNION ALL SELECT 'the kind is known', CAST(entity AS VARCHAR) || '|' || d FROM records WHERE kind IS NULL
  UNION ALL SELECT 'no entity has two records of one score', entity || '|' || score || '|' || count(*) FROM records
    GROUP BY entity, score HAVING count(*) > 1
  UNION ALL SELECT 'there are few records', 'n=' || count(*) FROM records HAVING count(*) >= 10),
n AS (SELECT label, count(*) AS n_bad, array_to_string(list(DISTINCT w ORDER BY w)[1:3], '; ') AS detail FROM r GROUP BY label)
SELECT label, n_bad IS NULL AS ok, coalesce(n_bad, 0) AS n_bad, detail FROM (
  SELECT unnest(['a score is at least 5', 'the kind is known', 'no entity has two records of one score', 'there are few records',
                 'every record has an id']) AS label) LEFT JOIN n USING (label)"""))
def checks_detailed(spark, sf_dir):
    records = W.records(spark, sf_dir)
    return Q.run_detailed([
        Q.RowChecks(records, {"a score is at least 5": F.col("score") >= 5, "the kind is known": F.col("kind").isNotNull(),
                              "every record has an id": F.col("rid").isNotNull()}, key=("entity", "d")),
        Q.no_duplicates("no entity has two records of one score", records, ["entity", "score"]),
        Q.ValueCheck("there are few records", records.agg(F.count(F.lit(1)).alias("n")), F.col("n") < 10)])


# --- search, categories, readers ----------------------------------------------------

SEARCHED = ("the", "ung", "éa", "qzx", "de la", "t", " DER ")

SEARCH_SQL = " UNION ALL ".join(
    f"""SELECT '{text}' AS text, doc_id, source FROM documents
        WHERE contains(lower(concat_ws(' ', source, text)), '{text.strip().lower()}') AND {len(text.strip())} >= 2"""
    for text in SEARCHED)


@query("indexed_search", SEARCH_SQL)
def indexed_search(spark, sf_dir):
    """All documents that hold each of some texts, found through one index."""
    index = SearchIndex(_new_path(spark, "search"), "doc_id")
    index.build(W.table(spark, sf_dir, "documents").select("doc_id", "source", "text"), ["source", "text"])
    found = None
    for text in SEARCHED:
        part = index.find(spark, text).select(F.lit(text).alias("text"), "doc_id", "source")
        found = part if found is None else found.unionByName(part)
    return found


@query("categories_by_name", f"""
WITH {W.RECORDS_SQL}, {W.PLACES_SQL},
seen AS (SELECT rid, CASE WHEN rid % 50 <> 0 THEN raw_name END AS name FROM records JOIN places ON id = entity)
SELECT rid, name, {_category_sql('name')} AS category FROM seen""")
def categories_by_name(spark, sf_dir):
    """The category of every record, its rules applied once per name."""
    rows = W.records(spark, sf_dir).join(W.places(spark, sf_dir), F.col("entity") == F.col("id"))
    named = rows.select("rid", F.when(F.col("rid") % 50 != 0, F.col("raw_name")).alias("name"))
    return by_distinct(named, "name", "category", categorize)


@query("pending_without_cache", ADDRESS_CTES.strip() + """
SELECT DISTINCT query, street_norm, city, zip5 FROM s4 WHERE street_norm IS NOT NULL AND street_norm <> ''""")
def pending_without_cache(spark, sf_dir):
    """Every key is pending where no cache has been written yet."""
    cache = read_geocode_cache(spark, _new_path(spark, "no-cache"))
    keys = _addresses(spark, sf_dir).select("query", "street_norm", "city", "zip5")
    return GE.pending(GE.targets(keys, ["query", "street_norm", "city", "zip5"]), cache)


@query("appended_twice", """
SELECT n_nationkey, n_name, 2 AS copies, 2 AS stamped FROM nation""")
def appended_twice(spark, sf_dir):
    """A table appended two times: every record twice, each with a time of ingest."""
    path = _new_path(spark, "appended")
    for _ in range(2):
        append_stamped(W.table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), path)
    stamp = F.rlike("scraped_at", F.lit(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:]{8}Z$"))
    return spark.read.parquet(path).groupBy("n_nationkey", "n_name").agg(
        F.count(F.lit(1)).alias("copies"), F.count_if(stamp).alias("stamped"))


__all__ = ["QUERIES", "ORACLE"]
