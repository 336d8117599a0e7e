"""One pinned schema per table; nothing is ever inferred from the data."""

from pyspark.sql import types as T

from . import fixed_values as V


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(),
}


def _schema(spec: str) -> T.StructType:
    """Schema from "name type, ..." without needing a session."""
    fields = [item.split() for item in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


RAW_EXPORT = _schema(
    "facility_id string, restaurant_name string, address string, zip_code string, "
    "inspection_date string, score int, process_description string, "
    "created_at string, updated_at string"
)
INSPECTIONS = _schema(
    "facility_id string, restaurant_name string, address string, street string, city string, "
    "zip5 string, inspection_date date, score int, purpose string, is_followup boolean, "
    "inspection_type string, program_name string, permit_id string, inspection_id string, "
    "source string"
)
PORTAL_RECORD = T.StructType([T.StructField(c, T.StringType()) for c in V.PORTAL_COLUMNS])
PORTAL_RAW = T.StructType(PORTAL_RECORD.fields + [T.StructField("scraped_at", T.StringType())])
CROSSWALK = _schema(
    "permitID string, facility_id string, match_method string, confidence string, "
    "n_shared_events int, p_name_raw string, p_addr_raw string, p_city string, p_zip string, "
    "i_name_raw string, i_addr_raw string, status string"
)
FACILITY_MERGES = _schema(
    "old_facility_id string, new_facility_id string, business string, gap_days int"
)
GEOCODE_CACHE = _schema(
    "query string, street_norm string, city string, zip5 string, latitude double, "
    "longitude double, source string"
)
LEGACY_GEOCODES = _schema("full_address string, latitude double, longitude double")
FETCH_LOG = _schema("ts string, window string, start int, outcome string, n int, note string")
FETCH_WINDOWS = _schema(
    "key date, from date, to date, state string, n int, dup int, note string, at string"
)
LANDED_PAGE = _schema("window string, start int, body string")
BRONZE = {
    "records": T.StructType([
        T.StructField("window", T.StringType()), T.StructField("scraped_at", T.StringType()), *PORTAL_RECORD.fields,
        T.StructField("batch_id", T.IntegerType())]),
    "request_log": T.StructType([*FETCH_LOG.fields, T.StructField("batch_id", T.IntegerType())]),
    "quarantine": _schema("window string, start int, scraped_at string, body string, note string, batch_id int"),
}
