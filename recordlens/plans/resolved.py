"""The whole resolution as registered queries: two feeds that name places differently, their crosswalk, the merge through it.

Importing this module adds the queries to the catalog.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.address import street_only
from ..operators import quality as Q
from ..operators import resolve as R
from ..session import materialise
from ..sources.sinks import write_table
from ..sources.tables import load_inspections
from . import crosswalk as CW
from . import gate, merged
from . import worlds as W
from .catalog import _category_sql
from .whole import FEEDS_SQL, MERGE_SQL, ORACLE, QUERIES, _export, _new_path, _portal, query

# Some places change their id with the years, some have two ids at a time; the portal calls some by another name, leaves
# city and ZIP off some addresses and splits the house number of some.

RESOLVED_FEEDS_SQL = FEEDS_SQL + f""",
batch AS (SELECT * REPLACE (CASE CAST(facility_id[2:] AS BIGINT) % 4
                              WHEN 2 THEN facility_id || ':' || CAST((year(inspection_date) - 1992) // 4 AS VARCHAR)
                              WHEN 3 THEN facility_id || ':' || CAST(score % 2 AS VARCHAR) ELSE facility_id END AS facility_id)
          FROM export),
visits AS (
  SELECT p.* REPLACE (CASE WHEN k % 7 = 0 THEN 'Cafe ' || k ELSE establishmentName END AS establishmentName,
                      CASE WHEN k % 17 = 0 THEN shown[1] || ' ' || shown[2:] ELSE shown END AS addressLine1)
  FROM (SELECT portal.*, CAST(permitID[2:] AS BIGINT) AS k, CASE WHEN s4.id % 3 = 1 THEN addressLine1 ELSE s4.street END AS shown
        FROM portal JOIN s4 ON s4.id = CAST(permitID[2:] AS BIGINT)) p),
scored AS (SELECT * EXCLUDE (k, shown) FROM visits WHERE inspectionType = '{V.SCORED_TYPE}')
"""


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.substring("facility_id", 2, 20).cast("long")
    era = F.floor((F.year("inspection_date") - 1992) / 4).cast("string")
    return _export(spark, sf_dir).withColumn("facility_id", F.when(
        k % 4 == 2, F.concat("facility_id", F.lit(":"), era)).when(
        k % 4 == 3, F.concat("facility_id", F.lit(":"), (F.col("score") % 2).cast("string"))).otherwise(F.col("facility_id")))


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.substring("permitID", 2, 20).cast("long")
    shown = F.when(k % 3 == 1, F.col("addressLine1")).otherwise(street_only("addressLine1"))
    return _portal(spark, sf_dir).withColumns({
        "establishmentName": F.when(k % 7 == 0, F.concat(F.lit("Cafe "), k.cast("string"))).otherwise(F.col("establishmentName")),
        "addressLine1": F.when(k % 17 == 0, F.concat(F.substring(shown, 1, 1), F.lit(" "), F.substring(shown, 2, 1000)))
        .otherwise(shown)})


CROSSWALK_SQL = RESOLVED_FEEDS_SQL + f""",
a AS (
  SELECT permitID AS permit_id, establishmentName AS p_name_raw, addressLine1 AS p_addr_raw, city AS p_city, zip[1:5] AS p_zip,
         zip[1:5] AS zip, p_first, p_last, {W._keyed('establishmentName', 'addressLine1')}
  FROM (SELECT *, row_number() OVER (PARTITION BY permitID ORDER BY date, inspectionID) AS i,
               min(date) OVER w AS p_first, max(date) OVER w AS p_last FROM scored WINDOW w AS (PARTITION BY permitID))
  WHERE i = 1),
places_known AS (
  SELECT facility_id, restaurant_name AS i_name_raw, street AS i_addr_raw, zip5 AS zip, i_first, i_last,
         {W._keyed('restaurant_name', 'street')}
  FROM (SELECT *, row_number() OVER (PARTITION BY facility_id
                 ORDER BY inspection_date, score, restaurant_name, street, zip5) AS i,
               min(inspection_date) OVER w AS i_first, max(inspection_date) OVER w AS i_last
        FROM batch WINDOW w AS (PARTITION BY facility_id)) WHERE i = 1),
b AS (SELECT * FROM places_known WHERE i_last >= (SELECT min(date) FROM scored)),
ea AS (SELECT DISTINCT permitID AS permit_id, date AS d, score FROM scored WHERE score IS NOT NULL),
eb AS (SELECT DISTINCT facility_id, inspection_date AS d, score FROM batch WHERE score IS NOT NULL)
""" + W.RESOLVE_SQL + f""",
waiting AS (SELECT * FROM unresolved WHERE permit_id NOT IN (SELECT permit_id FROM corroborated)),
members AS (SELECT DISTINCT block, facility_id FROM pairs WHERE t = 1 AND block IN (SELECT block FROM tied WHERE t = 1 AND n > 1)),
gaps AS (SELECT block, facility_id, i_last,
                CAST(i_first - lag(i_last) OVER (PARTITION BY block ORDER BY i_first, facility_id) AS INTEGER) AS gap
         FROM members JOIN places_known USING (facility_id)),
chains AS (SELECT block, min(gap) AS gap_days, arg_max(facility_id, (i_last, facility_id)) AS live FROM gaps
           GROUP BY block HAVING count(*) >= 2 AND min(gap) >= {V.HANDOFF_MIN_GAP_DAYS}),
taken AS (SELECT permit_id, block, live, gap_days, p_name_raw FROM waiting JOIN a USING (permit_id) JOIN chains USING (block)
          WHERE t = 1),
used AS (SELECT block, live, gap_days, arg_min(p_name_raw, permit_id) AS business FROM taken GROUP BY ALL),
checked AS (
  SELECT m.*, coalesce(a.k_num <> f.k_num, false) AS crosses FROM (
    SELECT permit_id, facility_id, match_method, confidence, n_shared_events FROM tiered
    UNION ALL SELECT permit_id, facility_id, match_method, confidence, n_shared_events FROM corroborated
    UNION ALL SELECT permit_id, live, 'handoff', 'retired_permit_handoff', NULL FROM taken) m
  JOIN a USING (permit_id) LEFT JOIN places_known f USING (facility_id)),
matched AS (SELECT * FROM checked WHERE NOT crosses),
merges AS (
  SELECT facility_id AS old_facility_id, live AS new_facility_id, business, gap_days FROM members JOIN used USING (block)
  WHERE facility_id <> live AND live IN (SELECT facility_id FROM matched)
  QUALIFY row_number() OVER (PARTITION BY facility_id ORDER BY gap_days DESC, live) = 1),
lonely AS (SELECT a.*, 'P:' || permit_id AS facility_id,
                  CASE WHEN p_first > (SELECT max(inspection_date) FROM batch) THEN 'new_after_freeze' ELSE 'unmatched' END AS status
           FROM a WHERE permit_id NOT IN (SELECT permit_id FROM matched)),
crosswalk AS (
  SELECT permit_id AS permitID, facility_id, match_method, confidence, n_shared_events, p_name_raw, p_addr_raw, p_city, p_zip,
         i_name_raw, i_addr_raw, 'matched' AS status
  FROM matched JOIN a USING (permit_id) LEFT JOIN places_known USING (facility_id)
  UNION ALL SELECT permit_id, facility_id, NULL, NULL, NULL, p_name_raw, p_addr_raw, p_city, p_zip, NULL, NULL, status FROM lonely),
queue AS (
  SELECT DISTINCT permit_id, NULL AS facility_id, block, n_candidates, 'ambiguous_time_overlap' AS reason FROM waiting
  WHERE permit_id NOT IN (SELECT permit_id FROM taken)
  UNION ALL SELECT permit_id, facility_id, NULL, 1, 'address_conflict' FROM checked WHERE crosses
  UNION ALL SELECT permit_id, NULL, NULL, 0, 'no_key_match' FROM lonely WHERE status = 'unmatched'),
routine AS (SELECT permitID AS permit_id, CAST(count(*) AS INTEGER) AS n_routine, round_even(avg(score), 1) AS mean_score
            FROM scored WHERE purpose = 'Routine' GROUP BY 1),
review AS (
  SELECT q.permit_id AS permitID, q.facility_id, block, n_candidates, reason, p_name_raw, p_addr_raw, p_zip, p_first, p_last,
         coalesce(n_routine, 0) AS n_routine, mean_score, {_category_sql('p_name_raw')} AS category,
         coalesce(coalesce(n_routine, 0) >= {V.TRIAGE_MIN_RECORDS} AND mean_score < {V.TRIAGE_MAX_MEAN}
                  AND {_category_sql('p_name_raw')} = '{V.RESTAURANT}', false) AS could_affect_rankings
  FROM queue q JOIN a USING (permit_id) LEFT JOIN routine USING (permit_id))
"""


def _resolved(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, CW.Crosswalk]:
    """Both feeds, staged, and what the resolver makes of them."""
    export, portal = materialise(_batch(spark, sf_dir)), materialise(_visits(spark, sf_dir))
    return export, portal, CW.build_crosswalk(portal, export)


@query("crosswalk_published", CROSSWALK_SQL + " SELECT * FROM crosswalk")
def crosswalk_published(spark, sf_dir):
    return _resolved(spark, sf_dir)[2].crosswalk


@query("crosswalk_merges", CROSSWALK_SQL + " SELECT * FROM merges")
def crosswalk_merges(spark, sf_dir):
    return _resolved(spark, sf_dir)[2].merges


@query("crosswalk_review", CROSSWALK_SQL + " SELECT * FROM review")
def crosswalk_review(spark, sf_dir):
    return _resolved(spark, sf_dir)[2].review


@query("crosswalk_report", CROSSWALK_SQL + """
SELECT status, match_method, confidence, count(*) AS n, round_even(count(*) * 100 / (SELECT count(*) FROM crosswalk), 1) AS pct
FROM crosswalk GROUP BY ALL""")
def crosswalk_report(spark, sf_dir):
    return R.match_report(_resolved(spark, sf_dir)[2].crosswalk)


GATED_SQL = CROSSWALK_SQL + """,
numbered AS (SELECT permitID, nullif(regexp_extract(p_addr_raw, '^([0-9]+)', 1), '') AS x,
                    nullif(regexp_extract(i_addr_raw, '^([0-9]+)', 1), '') AS y FROM {rows}
             WHERE status = 'matched' AND i_addr_raw IS NOT NULL),
r AS (SELECT 'one crosswalk row per permit' AS label, permitID || '|' || count(*) AS w FROM {rows} GROUP BY permitID HAVING count(*) > 1
      UNION ALL SELECT 'no permit is matched to another street number', permitID FROM numbered WHERE x <> y),
n AS (SELECT label, count(*) AS n_bad, array_to_string(list(w ORDER BY w)[1:3], '; ') AS detail FROM r GROUP BY label)
SELECT label, n_bad IS NULL AS ok, coalesce(n_bad, 0) AS n_bad, detail FROM (
  SELECT unnest(['one crosswalk row per permit', 'no permit is matched to another street number']) AS label) LEFT JOIN n USING (label)"""


@query("gate_crosswalk", GATED_SQL.replace("{rows}", "crosswalk"))
def gate_crosswalk(spark, sf_dir):
    return Q.run_detailed(gate.crosswalk_checks(materialise(_resolved(spark, sf_dir)[2].crosswalk)))


@query("gate_crosswalk_damaged", GATED_SQL.replace("numbered AS", """damaged AS (
  SELECT * REPLACE (CASE WHEN CAST(permitID[2:] AS BIGINT) % 5 = 0 THEN '9' || p_addr_raw ELSE p_addr_raw END AS p_addr_raw)
  FROM crosswalk UNION ALL SELECT * FROM crosswalk WHERE CAST(permitID[2:] AS BIGINT) % 20 = 1),
numbered AS""", 1).replace("{rows}", "damaged"))
def gate_crosswalk_damaged(spark, sf_dir):
    """Some permits twice, some with another house number."""
    rows = materialise(_resolved(spark, sf_dir)[2].crosswalk)
    k = F.substring("permitID", 2, 20).cast("long")
    bad = rows.withColumn("p_addr_raw", F.when(k % 5 == 0, F.concat(F.lit("9"), "p_addr_raw")).otherwise(F.col("p_addr_raw")))
    return Q.run_detailed(gate.crosswalk_checks(bad.unionByName(rows.filter(k % 20 == 1))))


#: The merge fed by the crosswalk and its id merges.
THROUGH_SQL = CROSSWALK_SQL + """,
links AS (SELECT permitID, facility_id FROM crosswalk),
old AS (SELECT batch.* REPLACE (coalesce(new_facility_id, facility_id) AS facility_id)
        FROM batch LEFT JOIN merges ON old_facility_id = facility_id),
feed AS (SELECT * EXCLUDE (k, shown) FROM visits),""" + MERGE_SQL


@query("resolved_inspections", THROUGH_SQL + " SELECT * FROM ins")
def resolved_inspections(spark, sf_dir):
    """Both feeds merged through their own crosswalk, written and read back."""
    export, portal, found = _resolved(spark, sf_dir)
    path = _new_path(spark, "resolved")
    write_table(merged.merge_inspections(export, portal, materialise(found.crosswalk), materialise(found.merges)), path)
    return load_inspections(spark, path, "merged")


__all__ = ["QUERIES", "ORACLE"]
