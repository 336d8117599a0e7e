"""Record-shaped views of the shared test tables, in Spark and as SQL for the oracle.

The test tables hold no inspection records, so orders stand in for dated, scored records of
customers, and customers for establishments with messy names and addresses. Every view is a
row-by-row derivation of a whole table.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..session import dealt

# A small grammar of names and addresses: every part is picked by the key, each with a divisor of its own, so that parts meet
# in all combinations. Words between them are the nations' names; codes, cities and units are those the rules know.
LETTERS = ("_0123456789", "aeioublmnrt")  # the nations' names as letters only
CASES = 3  # words in capitals, with a capital, in small letters
JOINS = (" - ", " -", "- ", " ", " -  ")
NOUNS = (" Market", " Foods  Mart", "'s Kitchen", " Stadium/North Hall", " Children's Clinic", " Line", " Elementary", " - Grill",
         " Gift Shop", " & Sons")
LEADS = ("", "N ", "s ", "East ", " w ", "e ")
ROADS = (" St", " BLVD", " Dr.", " Ln", " rd", " AVE.", " Hwy", "", "  Pkwy")
DASHES = (" ", "-", "")
BOUNDS = ("", "", " SB", " Nb", " SVRD EB", " Hwy WB", "")
UNIT_FORMS = ("", " #", "", " Bunit", " Unit #", " # Bunit", *(f" {word}" for word in V.UNIT_WORDS_GEOCODE))
UNIT_VALUES = (" 12", " 3-B", " C", "", " 4.1", "7")
CODES = (*V.NAME_PREFIX_CITY, "OOB", "TC", "RR")
DESIGNATORS = (*V.ROAD_DESIGNATORS, "Ih", "Fm", "us", "State Loop")
#: Endings around a city, its capitals, its small letters and a ZIP.
ENDINGS = ("", " {city}", " {upper}", ", {city}", ", {upper}, TX, {zip} {city}", ", {city}, TX {zip}-0001", ", {zip}", " {lower}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], key: Column, divisor: int = 1) -> Column:
    at = (F.floor(key / divisor) % len(values)).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), at + 1)


def _sql_pick(values: tuple[str, ...], key: str, divisor: int = 1) -> str:
    return f"{_sql_list(values)}[CAST({key} // {divisor} % {len(values)} AS INTEGER) + 1]"


def _sql_list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# --- dated, scored records ---------------------------------------------------------

def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    priority = F.col("o_orderpriority")
    return o.select(
        F.col("o_orderkey").alias("rid"),
        F.col("o_custkey").alias("entity"),
        F.col("o_orderdate").cast("date").alias("d"),
        (F.floor("o_totalprice") % 101).cast("int").alias("score"),
        F.when(F.col("o_orderstatus") == "P", "Follow-Up").otherwise("Routine").alias("purpose"),
        (F.col("o_orderstatus") == "P").alias("is_followup"),
        F.when(priority == "5-LOW", "Preopening").when(priority != "4-NOT SPECIFIED", "SCORED")
        .alias("kind"),
        F.col("o_orderstatus").alias("st"),
    )


RECORDS_SQL = """
records AS (
  SELECT o_orderkey AS rid, o_custkey AS entity, CAST(o_orderdate AS DATE) AS d,
         CAST(CAST(floor(o_totalprice) AS BIGINT) % 101 AS INTEGER) AS score,
         CASE WHEN o_orderstatus = 'P' THEN 'Follow-Up' ELSE 'Routine' END AS purpose,
         o_orderstatus = 'P' AS is_followup,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'Preopening'
              WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 'SCORED' END AS kind,
         o_orderstatus AS st
  FROM orders
)"""


# --- establishments with raw names and addresses ----------------------------------

def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = dealt(table(spark, sf_dir, "customer")).join(
        table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    key = F.col("c_custkey")
    small = F.lower(F.translate("n_name", *LETTERS))
    word = F.when(key % CASES == 0, F.upper(small)).when(
        key % CASES == 1, F.concat(F.upper(F.substring(small, 1, 1)), F.substring(small, 2, 100))).otherwise(small)
    zipped = F.concat(F.lit("787"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"))
    prefix = F.when(key % 2 == 0, F.concat(_pick(CODES, key, 2), _pick(JOINS, key, 3))).otherwise("")
    tagged = F.when(F.col("c_acctbal") > 8000, F.concat(F.lit(" #"), key.cast("string"))).when(
        F.col("c_acctbal") > 6000, F.lit(" Store 12")).otherwise("")
    numbered = F.concat(_pick(DESIGNATORS, key, 5), _pick(DASHES, key, 7), (key % 90 + 1).cast("string"))
    road = F.when(key % 5 == 0, numbered).otherwise(F.concat(word, _pick(ROADS, key, 2)))
    unit = _pick(UNIT_FORMS, key, 4)
    ending = _pick(ENDINGS, key, 3)
    city = _pick(V.CITIES, key, 11)
    for mark, value in (("{city}", city), ("{upper}", F.upper(city)), ("{lower}", F.lower(city)), ("{zip}", zipped)):
        ending = F.replace(ending, F.lit(mark), value)
    return c.select(
        key.alias("id"),
        F.concat(prefix, word, _pick(NOUNS, key, 6), tagged).alias("raw_name"),
        F.concat(F.floor(F.abs("c_acctbal")).cast("string"), F.lit(" "), _pick(LEADS, key), road, _pick(BOUNDS, key, 5),
                 unit, F.when(unit == "", "").otherwise(_pick(UNIT_VALUES, key, 9)), ending).alias("address"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.concat(zipped, F.lit("-0001"))).alias("zip_code"),
    )


PLACES_SQL = f"""
places AS (
  SELECT id, prefix || word || {_sql_pick(NOUNS, 'id', 6)} || tagged AS raw_name,
         CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS VARCHAR) || ' ' || {_sql_pick(LEADS, 'id')} || road
         || {_sql_pick(BOUNDS, 'id', 5)} || unit || CASE WHEN unit = '' THEN '' ELSE {_sql_pick(UNIT_VALUES, 'id', 9)} END
         || replace(replace(replace(replace({_sql_pick(ENDINGS, 'id', 3)}, '{{city}}', town), '{{upper}}', upper(town)),
                            '{{lower}}', lower(town)), '{{zip}}', zipped) AS address,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN zipped || '-0001' END AS zip_code
  FROM (SELECT c_custkey AS id, c_acctbal, c_mktsegment, '787' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS zipped,
               lower(translate(n_name, '{LETTERS[0]}', '{LETTERS[1]}')) AS small,
               CASE c_custkey % {CASES} WHEN 0 THEN upper(small) WHEN 1 THEN upper(small[1]) || small[2:] ELSE small END AS word,
               CASE WHEN c_custkey % 2 = 0 THEN {_sql_pick(CODES, 'c_custkey', 2)} || {_sql_pick(JOINS, 'c_custkey', 3)}
                    ELSE '' END AS prefix,
               CASE WHEN c_acctbal > 8000 THEN ' #' || CAST(c_custkey AS VARCHAR)
                    WHEN c_acctbal > 6000 THEN ' Store 12' ELSE '' END AS tagged,
               CASE WHEN c_custkey % 5 = 0 THEN {_sql_pick(DESIGNATORS, 'c_custkey', 5)} || {_sql_pick(DASHES, 'c_custkey', 7)}
                         || CAST(c_custkey % 90 + 1 AS VARCHAR)
                    ELSE word || {_sql_pick(ROADS, 'c_custkey', 2)} END AS road,
               {_sql_pick(UNIT_FORMS, 'c_custkey', 4)} AS unit, {_sql_pick(V.CITIES, 'c_custkey', 11)} AS town
        FROM customer JOIN nation ON n_nationkey = c_nationkey)
)"""


# --- two sides to be matched, with the records each of them holds ------------------

def facility_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Establishments as the batch source names them."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("F"), F.col("c_custkey").cast("string")).alias("facility_id"),
        F.concat(F.initcap(F.lower("c_mktsegment")), F.lit(" Kitchen")).alias("i_name"),
        F.concat(F.floor(F.abs("c_acctbal") / 300).cast("string"), F.lit(" Main Rd")).alias("i_addr"),
        F.concat(F.lit("787"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("zip"),
    )


def permit_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same establishments as the portal names them: prefixes, longer and other names."""
    c = table(spark, sf_dir, "customer")
    nation = F.col("c_nationkey")
    seg = F.initcap(F.lower("c_mktsegment"))
    name = (
        F.when(nation < 15, F.concat(F.lit("PF - "), F.upper(seg), F.lit(" KITCHEN")))
        .when(nation < 20, F.concat(F.lit("ABIA "), seg, F.lit(" Kitchen & Bar")))
        .otherwise(F.concat(F.lit("Cafe "), F.col("c_custkey").cast("string")))
    )
    road = F.when(F.col("c_acctbal") > 5000, " Main Road Ste 4").otherwise(" MAIN RD")
    return c.select(
        F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("permit_id"),
        name.alias("p_name"),
        F.concat(F.floor(F.abs("c_acctbal") / 300).cast("string"), road).alias("p_addr"),
        F.concat(F.lit("787"), F.lpad(nation.cast("string"), 2, "0")).alias("zip"),
    )


def side_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Records per side: each source holds some the other lacks, open orders are in both."""
    r = records(spark, sf_dir)
    permit = F.concat(F.lit("P"), F.col("entity").cast("string")).alias("permit_id")
    facility = F.concat(F.lit("F"), F.col("entity").cast("string")).alias("facility_id")
    return (
        r.filter(F.col("st").isin("F", "O")).select(permit, "d", "score").distinct(),
        r.filter(F.col("st").isin("O", "P")).select(facility, "d", "score").distinct(),
    )


NORM_NAME_SQL = (
    "regexp_replace(regexp_replace(lower({0}), "
    "'^(oob|pf|lw|bc|mn|wl|sv|rw|abia|cota|tc|rr|heb)\\s*-\\s*', ''), '[^a-z0-9]+', '', 'g')"
)
LOOSE_NAME_SQL = (
    "regexp_replace(regexp_replace(regexp_replace(lower({0}), "
    "'^(oob|pf|lw|bc|mn|wl|sv|rw|abia|cota|tc|rr|heb)\\s*-?\\s*', ''), '#\\s*[0-9]+', '', 'g'), "
    "'[^a-z0-9]+', '', 'g')"
)
NORM_STREET_SQL = (
    "regexp_replace(regexp_replace(lower({0}), "
    "'\\b(suite|ste|unit|bunit|bldg|building|apt|rm|room|fl|floor)\\b', ' ', 'g'), "
    "'[^a-z0-9]+', '', 'g')"
)
SQUISH_SQL = "trim(regexp_replace({0}, '[\\t\\n\\f\\r\\p{{Z}}]+', ' ', 'g'))"
HOUSE_NUM_SQL = "nullif(regexp_extract(" + SQUISH_SQL + ", '^([0-9]+)', 1), '')"


def _keyed(name: str, street: str) -> str:
    return (
        f"{NORM_NAME_SQL.format(name)} AS k_name, {NORM_STREET_SQL.format(street)} AS k_street, "
        f"{HOUSE_NUM_SQL.format(street)} AS k_num, {LOOSE_NAME_SQL.format(name)} AS k_loose"
    )


SIDES_SQL = RECORDS_SQL + f""",
b0 AS (
  SELECT 'F' || CAST(c_custkey AS VARCHAR) AS facility_id,
         upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' Kitchen' AS i_name,
         CAST(CAST(floor(abs(c_acctbal) / 300) AS BIGINT) AS VARCHAR) || ' Main Rd' AS i_addr,
         '787' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS zip
  FROM customer
),
a0 AS (
  SELECT 'P' || CAST(c_custkey AS VARCHAR) AS permit_id,
         CASE WHEN c_nationkey < 15 THEN 'PF - ' || upper(c_mktsegment) || ' KITCHEN'
              WHEN c_nationkey < 20 THEN 'ABIA ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:])
                                         || ' Kitchen & Bar'
              ELSE 'Cafe ' || CAST(c_custkey AS VARCHAR) END AS p_name,
         CAST(CAST(floor(abs(c_acctbal) / 300) AS BIGINT) AS VARCHAR)
         || CASE WHEN c_acctbal > 5000 THEN ' Main Road Ste 4' ELSE ' MAIN RD' END AS p_addr,
         '787' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS zip
  FROM customer
),
b AS (SELECT *, {_keyed('i_name', 'i_addr')} FROM b0),
a AS (SELECT *, {_keyed('p_name', 'p_addr')} FROM a0),
ea AS (SELECT DISTINCT 'P' || CAST(entity AS VARCHAR) AS permit_id, d, score FROM records
       WHERE st IN ('F', 'O')),
eb AS (SELECT DISTINCT 'F' || CAST(entity AS VARCHAR) AS facility_id, d, score FROM records
       WHERE st IN ('O', 'P'))"""

#: From entities (a, b) and their events (ea, eb) to matches by tiers and by corroboration.
RESOLVE_SQL = """,
shared AS (SELECT permit_id, facility_id, count(*) AS s FROM ea JOIN eb USING (d, score)
           GROUP BY permit_id, facility_id),
pairs AS (
  SELECT 0 AS t, 'name+street+zip' AS tier, permit_id, facility_id,
         a.k_name || '|' || a.k_street || '|' || a.zip AS block
  FROM a JOIN b USING (k_name, k_street, zip)
  UNION ALL
  SELECT 1, 'name+num+zip', permit_id, facility_id, a.k_name || '|' || a.k_num || '|' || a.zip
  FROM a JOIN b USING (k_name, k_num, zip)
),
counted AS (
  SELECT p.*, coalesce(s, 0) AS s, count(*) OVER (PARTITION BY t, p.permit_id) AS n,
         max(coalesce(s, 0)) OVER (PARTITION BY t, p.permit_id) AS best
  FROM pairs p LEFT JOIN shared x ON x.permit_id = p.permit_id AND x.facility_id = p.facility_id
),
tied AS (SELECT *, sum(CASE WHEN s = best THEN 1 ELSE 0 END) OVER (PARTITION BY t, permit_id) AS k
         FROM counted),
tiered AS (
  SELECT permit_id, facility_id,
         CASE WHEN n = 1 THEN tier ELSE tier || '+events' END AS match_method,
         CASE WHEN n = 1 THEN 'exact' ELSE 'resolved_by_events' END AS confidence,
         CASE WHEN n > 1 THEN CAST(s AS INTEGER) END AS n_shared_events
  FROM tied WHERE n = 1 OR (s >= 2 AND s = best AND k = 1)
  QUALIFY row_number() OVER (PARTITION BY permit_id ORDER BY t) = 1
),
unresolved AS (
  SELECT DISTINCT permit_id, t, tier, block, n AS n_candidates FROM tied
  WHERE n > 1 AND permit_id NOT IN (SELECT permit_id FROM tiered)
),
near AS (
  SELECT permit_id, facility_id, coalesce(s, 0) AS s
  FROM a JOIN b USING (k_street, zip) LEFT JOIN shared USING (permit_id, facility_id)
  WHERE permit_id NOT IN (SELECT permit_id FROM tiered)
    AND (coalesce(s, 0) >= 2
         OR (length(a.k_loose) > 0 AND length(b.k_loose) > 0
             AND (contains(a.k_loose, b.k_loose) OR contains(b.k_loose, a.k_loose))))
),
corroborated AS (
  SELECT permit_id, facility_id, 'street+zip+name_corroborated' AS match_method,
         CASE WHEN s >= 2 THEN 'address+events' ELSE 'address+name_containment' END AS confidence,
         CAST(s AS INTEGER) AS n_shared_events
  FROM near QUALIFY count(*) OVER (PARTITION BY permit_id) = 1
)"""

SIDES_SQL += RESOLVE_SQL
