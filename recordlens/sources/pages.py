"""Landed answer pages of the record portal: one row per request with the raw body."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S


def _first_char(body: Column) -> Column:
    return F.substring(F.ltrim(body), 1, 1)


def _plain(record: Column, schema: T.StructType) -> Column:
    """Text fields as plain values: of a nested list the first element counts, of an empty one nothing."""
    def value(field: T.StructField) -> Column:
        text = record[field.name]
        if not isinstance(field.dataType, T.StringType):
            return text.alias(field.name)
        nested = text.startswith("[") & F.get_json_object(text, "$").isNotNull()
        return F.when(nested, F.get_json_object(text, "$[0]")).otherwise(text).alias(field.name)

    return F.when(record.isNotNull(), F.struct(*[value(f) for f in schema.fields]))


def classify_pages(
    pages: DataFrame, record: T.StructType = S.PORTAL_RECORD, body: str = "body",
    start: str = "start",
) -> DataFrame:
    """Add ``records`` and the page's ``outcome``, ``n`` and ``note``.

    An array is a page of records. An object with ``err`` true past the first page is the end
    marker; on the first page it is a rejected request. Anything else is a fault, never an
    empty page, also an array with something behind its end.
    """
    text = F.col(body)
    parsed = F.from_json(text, T.ArrayType(record))
    # As the value of a field, an array with trailing text makes the whole object malformed.
    whole = F.from_json(F.concat(F.lit('{"page":'), text, F.lit("}")), "page string, corrupt string",
                        {"columnNameOfCorruptRecord": "corrupt"})
    closed = F.rtrim(text).endswith("]") & whole["corrupt"].isNull()
    is_array = (_first_char(text) == "[") & parsed.isNotNull() & closed
    is_object = (_first_char(text) == "{") & F.get_json_object(text, "$").isNotNull()
    is_end = is_object & (F.get_json_object(text, "$.err") == "true") & (F.col(start) > 0)
    outcome = F.when(is_array, "ok").when(is_end, "end").otherwise("fault")
    keys = F.array_join(F.json_object_keys(text), ",")
    note = (
        F.when(is_array | is_end, "")
        .when(is_object, F.concat(F.lit("object:"), keys))
        .otherwise(F.concat(F.lit("nonjson:"), F.trim(text)))
    )
    return pages.withColumns({
        "records": F.when(is_array, F.transform(parsed, lambda r: _plain(r, record))),
        "outcome": outcome,
        "n": F.when(is_array, F.size(parsed)).otherwise(0),
        "note": F.coalesce(note, F.lit("nonjson:")),
    })


def page_records(classified: DataFrame, *carry: str) -> DataFrame:
    """Records of good pages, one row each; a field a page lacks is NULL."""
    return classified.filter(F.col("outcome") == "ok").select(*carry, F.inline("records"))


def quarantined(classified: DataFrame, *carry: str, body: str = "body") -> DataFrame:
    """Pages that could not be used, with their whole bodies, kept for inspection."""
    return classified.filter(F.col("outcome") == "fault").select(*carry, body, "note")


def request_log(classified: DataFrame, stamp: Column) -> DataFrame:
    """Request-log rows of the pages."""
    return classified.select(
        stamp.alias("ts"), "window", "start", "outcome", "n", "note"
    )
