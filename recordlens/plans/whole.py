"""Whole pipelines as registered queries: feeds are written, read back, merged, placed and checked.

Orders and customers stand in for both feeds, as in ``worlds``. Importing this module adds the queries to the catalog.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from .. import schemas as S
from ..functions.address import geocode_query
from ..functions.geo import GOLDEN_ANGLE
from ..operators import quality as Q
from ..operators import reconcile as RC
from ..session import materialise, staging_folder
from ..sources import tables as TB
from ..sources.sinks import publish_metrics, write_table
from ..streaming.ingest import FAULTS, current_records, ingest_pages, read_bronze
from . import crosswalk as CW
from . import gate, geocode, merged, publish, reconcile
from . import worlds as W
from .catalog import (ADDRESS_CTES, DISPLAY_SQL, DISPLAY_STREET_1, DISPLAY_STREET_2, NORMAL_STREET_SQL, ORACLE, QUERIES,
                      VENUE_SQL, _category_sql, _squish_sql, query)

NOT_BEFORE = "1997-02-01"  # the shared tables are older than the published overlap


def _new_path(spark: SparkSession, name: str) -> str:
    return f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _rows(spark: SparkSession, sf_dir: str, states: tuple[str, ...]) -> DataFrame:
    records = W.records(spark, sf_dir).filter(F.col("st").isin(*states))
    return records.join(W.places(spark, sf_dir), F.col("entity") == F.col("id"))


def _id(letter: str, column: str):
    return F.concat(F.lit(letter), F.col(column).cast("string"))


# --- the two feeds ----------------------------------------------------------------

def raw_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch export as it comes: other columns, another order, quotes and line breaks in free text."""
    return _rows(spark, sf_dir, ("F", "O")).select(
        "score", F.concat(F.lit('a "quoted", long\nnote on '), F.col("rid").cast("string")).alias("notes"),
        _id("F", "entity").alias("facility_id"), F.col("raw_name").alias("restaurant_name"), "zip_code", "address",
        F.when(F.col("rid") % 4 == 0, V.FOLLOW_UP_PROCESS).otherwise("Routine Inspection").alias("process_description"),
        F.concat(F.col("d").cast("string"), F.lit("T00:00:00.000")).alias("inspection_date"),
        F.lit("2020-01-01").alias("created_at"), F.lit("2020-01-02").alias("updated_at"))


def raw_portal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Portal records, all text. Every third one was fetched twice, with another score at first."""
    rid = F.col("rid")
    null = F.lit(None).cast("string")
    score = F.when(rid % 11 == 0, "N/A").otherwise(F.col("score").cast("string"))
    # A record that was fetched twice has two versions; one pass over the rows makes both.
    fetched = [F.struct(score.alias("score"), F.lit("2024-02-01T00:00:00Z").alias("scraped_at")),
               F.struct(F.lit("1").alias("score"), F.lit("2024-01-01T00:00:00Z").alias("scraped_at"))]
    versions = F.when(rid % 3 == 0, F.array(*fetched)).otherwise(F.array(fetched[0]))
    rows = _rows(spark, sf_dir, ("O", "P")).withColumn("_version", F.explode(versions))
    return rows.select(
        _id("I", "rid").alias("inspectionID"), _id("P", "entity").alias("permitID"),
        F.concat(F.col("d").cast("string"), F.lit(" 00:00:00")).alias("inspectionDate"), F.col("_version.score"),
        F.when(F.col("kind") == "SCORED", V.SCORED_TYPE).otherwise(F.col("kind")).alias("inspectionType"),
        F.when(rid % 7 == 0, "Pools").otherwise(V.FOOD_PROGRAM).alias("programName"),
        F.when(rid % 5 == 0, "Compliance").when(rid % 4 == 0, V.FOLLOW_UP).otherwise(V.ROUTINE).alias("purpose"),
        F.lit("CFM present\nall well").alias("comments"), F.lit("10:00").alias("TimeIn"),
        F.col("raw_name").alias("establishmentName"), F.col("address").alias("addressLine1"),
        null.alias("addressLine2"), F.lit("AUSTIN").alias("city"), F.lit("TX").alias("state"),
        F.col("zip_code").alias("zip"), null.alias("permitType"), F.col("_version.scraped_at"))


FEEDS_SQL = ADDRESS_CTES + "," + W.RECORDS_SQL + f""",
export AS (
  SELECT 'F' || entity AS facility_id, {_squish_sql('raw_name')} AS restaurant_name, {_squish_sql('address')} AS address,
         street, city, zip5, d AS inspection_date, score,
         CASE WHEN rid % 4 = 0 THEN 'Follow-Up' ELSE 'Routine' END AS purpose, rid % 4 = 0 AS is_followup,
         CAST(NULL AS VARCHAR) AS inspection_type, CAST(NULL AS VARCHAR) AS program_name,
         CAST(NULL AS VARCHAR) AS permit_id, CAST(NULL AS VARCHAR) AS inspection_id, 'socrata' AS source
  FROM records JOIN s4 ON id = entity WHERE st IN ('F', 'O')),
portal AS (
  SELECT 'I' || rid AS inspectionID, 'P' || entity AS permitID,
         CASE WHEN kind = 'SCORED' THEN '{V.SCORED_TYPE}' ELSE kind END AS inspectionType,
         CASE WHEN rid % 7 = 0 THEN 'Pools' ELSE 'Food' END AS programName,
         CASE WHEN rid % 5 = 0 THEN 'Compliance' WHEN rid % 4 = 0 THEN 'Follow-Up' ELSE 'Routine' END AS purpose,
         {_squish_sql('raw_name')} AS establishmentName, {_squish_sql('address')} AS addressLine1, 'AUSTIN' AS city,
         zip_code AS zip, CAST(NULL AS VARCHAR) AS permitType, d AS date,
         CASE WHEN rid % 11 <> 0 THEN score END AS score
  FROM records JOIN places ON id = entity WHERE st IN ('O', 'P'))
"""


def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.type_export(raw_export(spark, sf_dir))


def _portal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.type_portal(raw_portal(spark, sf_dir))


@query("export_read_back", FEEDS_SQL + " SELECT * FROM export")
def export_read_back(spark, sf_dir):
    path = _new_path(spark, "export")
    write_table(raw_export(spark, sf_dir), path, "csv")
    return TB.load_inspections(spark, path, "export", "csv")


@query("portal_read_back", FEEDS_SQL + " SELECT * FROM portal")
def portal_read_back(spark, sf_dir):
    path = _new_path(spark, "portal")
    write_table(raw_portal(spark, sf_dir), path, "json")
    return TB.read_portal(spark, path, "json")


@query("permit_profiles", FEEDS_SQL + f""",
p AS (SELECT *, row_number() OVER (PARTITION BY permitID ORDER BY date, inspectionID) AS i,
             min(date) OVER w AS p_first, max(date) OVER w AS p_last, count(*) OVER w AS p_n
      FROM portal WHERE inspectionType = '{V.SCORED_TYPE}' WINDOW w AS (PARTITION BY permitID))
SELECT permitID, establishmentName AS p_name_raw, addressLine1 AS p_addr_raw, city AS p_city, zip[1:5] AS p_zip,
       zip[1:5] AS zip, p_first, p_last, p_n, {W._keyed('establishmentName', 'addressLine1')} FROM p WHERE i = 1""")
def permit_profiles(spark, sf_dir):
    return CW.permit_profile(_portal(spark, sf_dir))


@query("facility_profiles", FEEDS_SQL + f""",
p AS (SELECT *, row_number() OVER (PARTITION BY facility_id
               ORDER BY inspection_date, score, restaurant_name, street, zip5) AS i,
             min(inspection_date) OVER w AS i_first, max(inspection_date) OVER w AS i_last, count(*) OVER w AS i_n
      FROM export WINDOW w AS (PARTITION BY facility_id))
SELECT facility_id, restaurant_name AS i_name_raw, street AS i_addr_raw, city AS i_city, zip5 AS zip, i_first, i_last,
       i_n, {W._keyed('restaurant_name', 'street')} FROM p
WHERE i = 1 AND i_last >= (SELECT min(date) FROM portal WHERE inspectionType = '{V.SCORED_TYPE}')""")
def facility_profiles(spark, sf_dir):
    """Facilities that were active since the portal's first scored record."""
    opened = CW.scored_portal(_portal(spark, sf_dir)).agg(F.min("date")).scalar()
    return CW.facility_profile(_export(spark, sf_dir)).filter(F.col("i_last") >= opened)


# --- merge --------------------------------------------------------------------------

#: From ``old`` (the export under its live ids), ``feed`` (the portal) and ``links`` to the merged table ``ins``.
MERGE_SQL = f"""
linked AS (SELECT * FROM feed JOIN links USING (permitID) WHERE inspectionType = '{V.SCORED_TYPE}'),
stacked AS (
  SELECT 0 AS p, facility_id, date AS inspection_date, score, purpose, inspectionType AS inspection_type,
         programName AS program_name, permitID AS permit_id, inspectionID AS inspection_id, 'portal' AS source FROM linked
  UNION ALL SELECT 1, facility_id, inspection_date, score, purpose, NULL, NULL, NULL, NULL, 'socrata' FROM old),
kept AS (SELECT * FROM stacked QUALIFY row_number() OVER (
  PARTITION BY facility_id, inspection_date, score ORDER BY p, inspection_id, purpose) = 1),
known AS (SELECT * FROM old QUALIFY row_number() OVER (PARTITION BY facility_id
  ORDER BY inspection_date, score, restaurant_name, address, street, city, zip5) = 1),
seen AS (SELECT facility_id, establishmentName AS restaurant_name, addressLine1 AS address, 'Austin' AS city, zip[1:5] AS zip5
         FROM linked QUALIFY row_number() OVER (PARTITION BY facility_id ORDER BY date, inspectionID) = 1),
wide AS (
  SELECT k.*, coalesce(a.restaurant_name, b.restaurant_name) AS restaurant_name, coalesce(a.address, b.address) AS address,
         coalesce(a.street, b.address) AS street, coalesce(a.city, b.city) AS city, coalesce(a.zip5, b.zip5) AS zip5,
         regexp_replace(lower(coalesce(a.restaurant_name, b.restaurant_name)), '[^a-z0-9]+', '', 'g') AS name_key
  FROM kept k LEFT JOIN known a USING (facility_id) LEFT JOIN seen b USING (facility_id)),
types AS (SELECT regexp_replace(lower(establishmentName), '[^a-z0-9]+', '', 'g') AS name_key, date AS inspection_date, score,
                 inspectionType AS t, programName AS g FROM feed WHERE score IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY name_key, date, score ORDER BY inspectionID) = 1),
ins AS (SELECT facility_id, restaurant_name, address, street, city, zip5, inspection_date, score, purpose,
               purpose = 'Follow-Up' AS is_followup, coalesce(inspection_type, t) AS inspection_type,
               coalesce(program_name, g) AS program_name, permit_id, inspection_id, source
        FROM wide LEFT JOIN types USING (name_key, inspection_date, score))
"""

MERGED_SQL = FEEDS_SQL + f""",
links AS (SELECT 'P' || c_custkey AS permitID, CASE WHEN c_custkey % 5 = 0 THEN 'portal-P' ELSE 'F' END || c_custkey AS facility_id
          FROM customer),
old AS (SELECT * REPLACE (CASE WHEN CAST(facility_id[2:] AS BIGINT) % 10 = 3
                               THEN 'F' || (CAST(facility_id[2:] AS BIGINT) + 1) ELSE facility_id END AS facility_id)
        FROM export),
feed AS (SELECT * FROM portal),""" + MERGE_SQL


def _links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = W.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    links = c.select(_id("P", "k").alias("permitID"), F.concat(
        F.when(F.col("k") % 5 == 0, "portal-P").otherwise("F"), F.col("k").cast("string")).alias("facility_id"))
    merges = c.filter(F.col("k") % 10 == 3).select(
        _id("F", "k").alias("old_facility_id"),
        F.concat(F.lit("F"), (F.col("k") + 1).cast("string")).alias("new_facility_id"))
    return links, merges


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged table, written and read back as its readers do."""
    path = _new_path(spark, "inspections")
    rows = merged.merge_inspections(materialise(_export(spark, sf_dir)), materialise(_portal(spark, sf_dir)),
                                    *_links(spark, sf_dir))
    write_table(rows, path)
    return TB.load_inspections(spark, path, "merged")


@query("merged_inspections", MERGED_SQL + " SELECT * FROM ins")
def merged_inspections(spark, sf_dir):
    return _merged(spark, sf_dir)


@query("merged_counts", MERGED_SQL + " SELECT source, purpose, count(*) AS n FROM ins GROUP BY ALL")
def merged_counts(spark, sf_dir):
    return merged.merged_counts(_merged(spark, sf_dir))


# --- places and map -----------------------------------------------------------------

PLACED_SQL = MERGED_SQL + f""",
m1 AS (SELECT *, {NORMAL_STREET_SQL} AS street_norm, {DISPLAY_STREET_1} AS ds1,
              CASE WHEN zip5 IS NULL
                   THEN nullif(regexp_extract(coalesce(address, street), '\\b(7[0-9]{{4}})\\b', 1), '') END AS found FROM ins),
m2 AS (SELECT *, {DISPLAY_STREET_2} AS shown_street, CASE WHEN found IS NOT NULL
              THEN {_squish_sql("regexp_replace(street_norm, ',?\\s*\\b' || found || '\\b\\s*$', '')")}
              ELSE street_norm END AS key_street, coalesce(zip5, found) AS key_zip FROM m1),
placed AS (SELECT *, {_squish_sql("key_street || ', ' || city || ', TX' || coalesce(', ' || key_zip, '')")} AS query,
                  {_squish_sql("address || ', Austin, TX, ' || zip5")} AS legacy FROM m2),
keys AS (SELECT DISTINCT query, street_norm, city, zip5 FROM placed WHERE street_norm <> ''),
given AS (SELECT DISTINCT query, length(query) % 7 AS r, 30 + (length(query) % 10) * 0.01::DOUBLE AS lat,
                 -97 - (length(query) % 10) * 0.02::DOUBLE AS lon FROM placed)
"""


def _given(keyed: DataFrame) -> DataFrame:
    """A position per key, from the length of the key: many places share one."""
    size = F.length("query")
    return keyed.select("query").distinct().select(
        "query", (size % 7).alias("r"), (F.lit(30) + (size % 10) * 0.01).alias("latitude"),
        (F.lit(-97) - (size % 10) * 0.02).alias("longitude"))


def _cache(ins: DataFrame) -> DataFrame:
    """Positions of the keys, for a seventh of them none."""
    return _given(geocode.distinct_addresses(ins).withColumn("query", geocode_query("street", "city", "zip5", "address"))).select(
        "query", F.when(F.col("r") > 0, F.col("latitude")).alias("latitude"),
        F.when(F.col("r") > 0, F.col("longitude")).alias("longitude"), F.lit("census").alias("source"))


MAP_SQL = PLACED_SQL + f""",
newest AS (SELECT max(inspection_date) AS m FROM ins),
last AS (SELECT * FROM placed
         WHERE score > 0 AND (inspection_type IS NULL OR inspection_type = '{V.SCORED_TYPE}')
         QUALIFY row_number() OVER (PARTITION BY facility_id
           ORDER BY inspection_date DESC, score, inspection_id, source, purpose) = 1),
num AS (SELECT facility_id, count(*) AS q FROM ins WHERE score IS NOT NULL GROUP BY facility_id),
pts AS (SELECT last.*, lat, lon, q, row_number() OVER (PARTITION BY lat, lon ORDER BY facility_id) - 1 AS i,
               count(*) OVER (PARTITION BY lat, lon) AS size
        FROM last JOIN given USING (query) JOIN num USING (facility_id), newest
        WHERE r > 0 AND inspection_date >= CAST(m - INTERVAL 18 MONTH AS DATE)),
map_rows AS (SELECT facility_id, restaurant_name AS n, shown_street AS a, CAST(dense_rank() OVER (ORDER BY city) - 1 AS INTEGER) AS c,
       zip5 AS z, round(lat + 7 * sqrt(i) * cos(i * {GOLDEN_ANGLE!r}) / 111320, 5) AS y,
       round(lon + 7 * sqrt(i) * sin(i * {GOLDEN_ANGLE!r}) / (111320 * cos(radians(lat))), 5) AS x, score AS s,
       strftime(inspection_date, '%Y-%m-%d') AS d, CAST(is_followup AS INTEGER) AS f,
       CAST(list_position({W._sql_list(V.CATEGORIES)}, {_category_sql('restaurant_name')}) - 1 AS INTEGER) AS k,
       q, CAST(size - 1 AS INTEGER) AS u FROM pts)
"""


@query("map_table", MAP_SQL + " SELECT * FROM map_rows")
def map_table(spark, sf_dir):
    ins = _merged(spark, sf_dir)
    return publish.map_rows(ins, materialise(_cache(ins)))


@query("cached_share", PLACED_SQL + """,
sites AS (SELECT DISTINCT facility_id, street, city, zip5, address, query,
                 facility_id IN (SELECT facility_id FROM export) AS known FROM placed),
t AS (SELECT count(*) FILTER (WHERE known) AS n_established, count(*) FILTER (WHERE known AND r > 0) AS n_cached,
             count(DISTINCT CASE WHEN NOT known THEN facility_id END) AS n_new_facilities
      FROM sites JOIN given USING (query))
SELECT *, round_even(n_cached * 100 / n_established, 1) AS pct FROM t""")
def cached_share(spark, sf_dir):
    ins = _merged(spark, sf_dir)
    return merged.cached_share(ins, _export(spark, sf_dir), _cache(ins))


REFRESHED_SQL = PLACED_SQL + """,
prior AS (SELECT legacy, min(length(legacy) % 5) AS r5 FROM placed WHERE legacy IS NOT NULL GROUP BY legacy),
seed AS (SELECT query, street_norm, city, zip5, 31::DOUBLE AS latitude, -98::DOUBLE AS longitude, 'prior' AS source
         FROM placed JOIN prior USING (legacy) WHERE r5 = 0
         QUALIFY row_number() OVER (PARTITION BY query ORDER BY legacy, street_norm, city, zip5) = 1),
pass1 AS (SELECT * FROM seed UNION ALL
          SELECT query, street_norm, city, zip5, CASE WHEN r > 2 THEN lat END, CASE WHEN r > 2 THEN lon END,
                 CASE WHEN r > 2 THEN 'census' END FROM keys JOIN given USING (query)
          WHERE r > 0 AND query NOT IN (SELECT query FROM seed)
          QUALIFY row_number() OVER (PARTITION BY query ORDER BY street_norm, city, zip5) = 1),
pass2 AS (SELECT p.* REPLACE (CASE WHEN latitude IS NULL AND r = 2 THEN lat + 1 ELSE latitude END AS latitude,
                              CASE WHEN longitude IS NULL AND r = 2 THEN lon + 1 ELSE longitude END AS longitude,
                              CASE WHEN latitude IS NULL AND r = 2 THEN 'arcgis' ELSE source END AS source)
          FROM pass1 p JOIN given USING (query))
"""


def _refreshed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, geocode.Refreshed]:
    """No cache yet: a seed from the first keys, then the answers of two providers."""
    keyed = materialise(geocode.keyed_addresses(geocode.distinct_addresses(_merged(spark, sf_dir))))
    legacy = keyed.filter(F.length("legacy") % 5 == 0).select(
        F.col("legacy").alias("full_address"), F.lit(31.0).alias("latitude"), F.lit(-98.0).alias("longitude")).distinct()
    given = _given(keyed)
    first = given.filter("r > 0").select("query", *[
        F.when(F.col("r") > 2, F.col(c)).alias(c) for c in ("latitude", "longitude")])
    second = given.filter("r = 2").select("query", *[(F.col(c) + 1).alias(c) for c in ("latitude", "longitude")])
    return keyed, geocode.refresh_cache(keyed, None, legacy, first, second)


@query("geocode_refreshed", REFRESHED_SQL + " SELECT query, latitude, longitude, source FROM pass2")
def geocode_refreshed(spark, sf_dir):
    return _refreshed(spark, sf_dir)[1].cache.select("query", "latitude", "longitude", "source")


@query("geocode_by_source", REFRESHED_SQL + """,
n AS (SELECT source, count(*) AS n FROM (SELECT DISTINCT query FROM keys) LEFT JOIN pass2 USING (query) GROUP BY source)
SELECT source, n, round_even(n * 100 / (SELECT count(DISTINCT query) FROM keys), 1) AS pct FROM n""")
def geocode_by_source(spark, sf_dir):
    keyed, refreshed = _refreshed(spark, sf_dir)
    return geocode.coverage_by_source(keyed, materialise(refreshed.cache))


# --- reconciliation -----------------------------------------------------------------

RECONCILED_SQL = FEEDS_SQL + f""",
food AS (SELECT * FROM portal WHERE programName = 'Food'),
span AS (SELECT greatest((SELECT min(date) FROM food), DATE '{NOT_BEFORE}') AS a, (SELECT max(inspection_date) FROM export) AS b),
both_sides AS (
  SELECT 0 AS side, inspection_date AS day FROM export, span WHERE inspection_date BETWEEN a AND b
  UNION ALL SELECT 1, date FROM food, span WHERE purpose IN ('Routine', 'Follow-Up') AND date BETWEEN a AND b),
weeks AS (SELECT CAST(day - CAST(dayofweek(day) AS INTEGER) AS DATE) AS week, count(*) FILTER (WHERE side = 0) AS export_n,
                 count(*) FILTER (WHERE side = 1) AS portal_n FROM both_sides GROUP BY 1)
SELECT *, portal_n - export_n AS diff, round_even(portal_n * 100 / export_n, 1) AS pct FROM weeks
WHERE export_n > 0 AND portal_n > 0"""


@query("reconciled_weeks", RECONCILED_SQL)
def reconciled_weeks(spark, sf_dir):
    return reconcile.weekly_reconciliation(_export(spark, sf_dir), _portal(spark, sf_dir), NOT_BEFORE)


@query("reconciled_summary", f"""
WITH r AS ({RECONCILED_SQL})
SELECT count(*) AS n_weeks, sum(export_n) AS left_total, sum(portal_n) AS right_total,
       round_even(sum(portal_n) * 100 / sum(export_n), 1) AS total_pct, count(*) FILTER (WHERE pct < 90) AS weeks_low,
       count(*) FILTER (WHERE pct > 110) AS weeks_high, median(pct) AS median_pct,
       count(*) > 10 AND median(pct) < 95 AS systematic FROM r""")
def reconciled_summary(spark, sf_dir):
    return RC.weekly_summary(reconciled_weeks(spark, sf_dir), reconcile.SIDES)


# --- gate ---------------------------------------------------------------------------

@query("gate_inspections", MERGED_SQL + f""",
s AS (SELECT *, score > 0 AND (inspection_type IS NULL OR inspection_type = '{V.SCORED_TYPE}') AS ok FROM ins),
l AS (SELECT * FROM s WHERE ok QUALIFY row_number() OVER (PARTITION BY facility_id
        ORDER BY inspection_date DESC, score, inspection_id, source, purpose) = 1),
r AS (
  SELECT 'inspection table is not empty' AS label, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS n_bad FROM ins
  UNION ALL SELECT 'no row lacks a facility id', count(*) FILTER (WHERE facility_id IS NULL) FROM ins
  UNION ALL SELECT 'no row lacks a name', count(*) FILTER (WHERE restaurant_name IS NULL) FROM ins
  UNION ALL SELECT 'no zero is typed as a scored inspection',
    count(*) FILTER (WHERE score = 0 AND inspection_type = '{V.SCORED_TYPE}') FROM ins
  UNION ALL SELECT 'no observation stands twice', count(*) FROM (
    SELECT 1 FROM ins GROUP BY facility_id, inspection_date, score HAVING count(*) > 1)
  UNION ALL SELECT 'no zero survives latest-per-facility', count(*) FILTER (WHERE score <= 0) FROM l
  UNION ALL SELECT 'no market is ranked as a restaurant', count(*) FILTER (WHERE {_category_sql('restaurant_name')} = '{V.RESTAURANT}'
    AND regexp_matches(restaurant_name, '(?i)\\bmarket') AND NOT regexp_matches(restaurant_name, '(?i)mandola')) FROM l
  UNION ALL SELECT 'a zero never hides an earlier real score', count(*) FROM (
    SELECT facility_id FROM s WHERE ok EXCEPT SELECT facility_id FROM l)
  UNION ALL SELECT 'cutoff is anchored to the data', CASE WHEN max(inspection_date) IS NULL THEN 1 ELSE 0 END FROM ins
  UNION ALL SELECT 'no export observation is lost', count(*) FROM (
    SELECT facility_id, inspection_date, score FROM old WHERE score IS NOT NULL
    EXCEPT SELECT facility_id, inspection_date, score FROM ins))
SELECT label, n_bad = 0 AS ok, n_bad FROM r""")
def gate_inspections(spark, sf_dir):
    ins = _merged(spark, sf_dir)
    return Q.run_checks([*gate.inspection_checks(ins),
                         *gate.no_loss_checks(_export(spark, sf_dir), _links(spark, sf_dir)[1], ins)])


@query("gate_map", MAP_SQL + """,
t AS (SELECT strftime(CAST(m - INTERVAL 18 MONTH AS DATE), '%Y-%m-%d') AS low, strftime(m, '%Y-%m-%d') AS high FROM newest),
stated AS (SELECT count(*) AS n FROM last JOIN given USING (query), newest
           WHERE r > 0 AND inspection_date >= CAST(m - INTERVAL 18 MONTH AS DATE)),
r AS (
  SELECT 'no zero on the map' AS label, count(*) FILTER (WHERE s <= 0) AS n_bad FROM map_rows
  UNION ALL SELECT 'every map row is inside the window', count(*) FILTER (WHERE d < low) FROM map_rows, t
  UNION ALL SELECT 'no map row is later than the data', count(*) FILTER (WHERE d > high) FROM map_rows, t
  UNION ALL SELECT 'map rows equal the stated count', abs(sign(count(*) - (SELECT n FROM stated))) FROM map_rows
  UNION ALL SELECT 'map carries no inspector comments',
    count(*) FILTER (WHERE contains(concat_ws(' ', facility_id, n, a, z, d), 'CFM')) FROM map_rows)
SELECT label, n_bad = 0 AS ok, CAST(n_bad AS BIGINT) AS n_bad FROM r""")
def gate_map(spark, sf_dir):
    ins = _merged(spark, sf_dir)
    cache = materialise(_cache(ins))
    latest = materialise(publish.located_latest(ins, cache))
    rows = materialise(publish.map_rows(ins, cache, latest))
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return Q.run_checks(gate.map_checks(rows, publish_metrics(latest, ins, publish.DATE, located), ins))


RANKED_SQL = MERGED_SQL + f""",
pool AS (SELECT *, {DISPLAY_STREET_1} AS ds1 FROM ins
         WHERE score > 0 AND (inspection_type IS NULL OR inspection_type = '{V.SCORED_TYPE}') AND purpose = 'Routine'
           AND NOT regexp_matches(restaurant_name, '(?i)^OOB\\b|INELIGIBLE')),
who AS (SELECT facility_id, restaurant_name AS name, {DISPLAY_STREET_2} AS street, city,
               {VENUE_SQL.replace('{0}', 'restaurant_name')} AS venue, {_category_sql('restaurant_name')} AS category
        FROM pool QUALIFY row_number() OVER (PARTITION BY facility_id
          ORDER BY inspection_date, score, restaurant_name, street, city) = 1),
sums AS (SELECT facility_id, round_even(avg(score), 2) AS mean_score, count(*) AS n, min(score) AS min_score,
                max(score) AS max_score, arg_max(score, (inspection_date, -score)) AS latest_score,
                max(inspection_date) AS latest FROM pool GROUP BY facility_id),
pick AS (SELECT * FROM sums JOIN who USING (facility_id)
         WHERE n >= 3 AND latest >= CAST((SELECT max(inspection_date) FROM ins) - INTERVAL 18 MONTH AS DATE)),
listed AS (
  SELECT "table", CASE WHEN side = 'top' THEN -mean_score ELSE mean_score END AS o, p.*
  FROM pick p, (VALUES ('all_top', 'top', 5), ('all_bottom', 'bottom', 3), ('chosen_top', 'top', 5),
                       ('chosen_bottom', 'bottom', 3)) AS v("table", side, least)
  WHERE n >= least AND ("table" LIKE 'all%' OR category = '{V.RESTAURANT}')
  QUALIFY row_number() OVER (PARTITION BY "table", venue ORDER BY o, n DESC, latest DESC, facility_id) = 1),
ranked AS (SELECT "table", row_number() OVER (PARTITION BY "table" ORDER BY o, n DESC, latest DESC, facility_id) AS rank,
                  facility_id, name, category, street, city, mean_score, n, min_score, max_score, latest_score, latest, venue
           FROM listed QUALIFY rank <= 10)
"""


@query("published_rankings", RANKED_SQL + " SELECT * EXCLUDE (venue) FROM ranked")
def published_rankings(spark, sf_dir):
    return publish.rankings(_merged(spark, sf_dir))


@query("gate_rankings", RANKED_SQL + f""",
shown AS (SELECT *, {DISPLAY_SQL.replace('{0}', 'name')} AS shown FROM ranked),
r AS (
  SELECT 'rankings reproduce in order' AS label, count(*) FILTER (WHERE rank IS NULL) AS n_bad FROM ranked
  UNION ALL SELECT 'every ranked entity has enough routine records',
    count(*) FILTER (WHERE n < CASE WHEN "table" LIKE '%top' THEN 5 ELSE 3 END) FROM ranked
  UNION ALL SELECT 'restaurant tables hold restaurants only',
    count(*) FILTER (WHERE "table" LIKE 'chosen%' AND category <> '{V.RESTAURANT}') FROM ranked
  UNION ALL SELECT 'no administrative name is ranked', count(*) FILTER (WHERE regexp_matches(name, '(?i)^OOB\\b|INELIGIBLE')) FROM ranked
  UNION ALL SELECT 'no ranked entity is outside the window', count(*) FILTER (WHERE latest NOT BETWEEN
    CAST((SELECT max(inspection_date) FROM ins) - INTERVAL 18 MONTH AS DATE) AND (SELECT max(inspection_date) FROM ins)) FROM ranked
  UNION ALL SELECT 'one slot per operator', count(*) FROM (SELECT 1 FROM ranked GROUP BY "table", venue HAVING count(*) > 1)
  UNION ALL SELECT 'no two ranked rows read alike', count(*) FROM (
    SELECT 1 FROM shown GROUP BY "table", shown, street HAVING count(*) > 1)
  UNION ALL SELECT 'rankings carry no inspector comments',
    count(*) FILTER (WHERE contains(concat_ws(' ', facility_id, name, category, street, city), 'CFM')) FROM ranked)
SELECT label, n_bad = 0 AS ok, n_bad FROM r""")
def gate_rankings(spark, sf_dir):
    ins = _merged(spark, sf_dir)
    return Q.run_checks(gate.ranking_checks(materialise(publish.rankings(ins)), ins))


# --- streaming ----------------------------------------------------------------------

def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer page per event: one record of its user, or a body that is no page."""
    record = F.to_json(F.array(F.struct(
        _id("E", "user_id").alias("inspectionID"), F.array("event_type", F.lit("x")).alias("permitID"),
        F.col("event_id").cast("string").alias("inspectionDate"))))
    return W.table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("window"), F.lit(0).alias("start"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("<html>"), F.col("props"))).otherwise(record).alias("body"))


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """Two runs of the ingest: even events land first, odd ones later."""
    landing, target, marks = (_new_path(spark, name) for name in ("landing", "bronze", "marks"))
    pages = _landed(spark, sf_dir)
    for late in (0, 1):
        pages.filter(F.col("event_id") % 2 == late).drop("event_id").write.mode("append").json(landing)
        ingest_pages(spark, landing, target, marks).awaitTermination()
    return target


@query("ingested_records", """
SELECT 'E' || user_id AS inspectionID, event_type AS permitID, CAST(event_id AS VARCHAR) AS inspectionDate FROM events
WHERE event_type <> 'error'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 2 DESC, event_type, CAST(event_id AS VARCHAR)) = 1""")
def ingested_records(spark, sf_dir):
    return current_records(spark, _ingested(spark, sf_dir)).select("inspectionID", "permitID", "inspectionDate")


@query("ingested_faults", """
SELECT strftime(ts, '%Y-%m-%d') AS "window", '<html>' || props AS body, count(*) AS n FROM events
WHERE event_type = 'error' GROUP BY ALL""")
def ingested_faults(spark, sf_dir):
    faults = read_bronze(spark, _ingested(spark, sf_dir), FAULTS)
    return faults.groupBy("window", "body").agg(F.count(F.lit(1)).alias("n"))


__all__ = ["QUERIES", "ORACLE"]
