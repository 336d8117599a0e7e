"""Writers and publish formats."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.dates import recency_cutoff
from ..operators.select import newest_version
from ..operators.spread import dictionary


def utc_stamp() -> Column:
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def append_stamped(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append records with their ingest time."""
    df.withColumn("scraped_at", utc_stamp()).write.mode("append").format(fmt).save(path)


def rewrite_deduped(df: DataFrame, target: str, key: str, stamp: str, order_by: Sequence[str],
                    fmt: str = "parquet") -> None:
    """Write the newest version of every record to a new path.

    Spark cannot overwrite a path it is reading; the caller points readers at ``target``.
    """
    newest_version(df, [key], stamp, order_by).write.mode("errorifexists").format(fmt).save(target)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, escape='"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def _json_scalar(name: str) -> Column:
    boxed = F.to_json(F.array(F.col(name)))
    return F.substr(boxed, F.lit(2), F.length(boxed) - 2)


def json_array_row(cols: Sequence[str]) -> Column:
    """Row as a positional JSON array, so that key names are not repeated in every row."""
    values = [F.coalesce(_json_scalar(c), F.lit("null")) for c in cols]
    return F.concat(F.lit("["), F.concat_ws(",", *values), F.lit("]"))


def json_records(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows as JSON objects with ISO dates."""
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("record"))


def read_json_rows(rows: DataFrame, col: str, fields: Sequence[str]) -> DataFrame:
    """Published positional rows back as named text columns."""
    parsed = F.from_json(F.col(col), "array<string>")
    return rows.select(parsed.alias("_r")).select(
        *[F.col("_r")[i].alias(f) for i, f in enumerate(fields)]
    )


def publish_metrics(
    latest: DataFrame, records: DataFrame, date: str, located: Column,
    months: int = V.RECENCY_MONTHS,
) -> DataFrame:
    """Header counts and the three dates, which are never merged into one."""
    cutoff = recency_cutoff(records, date, months)
    flagged = latest.select(
        (F.col(date) >= cutoff).alias("_in"), F.coalesce(located, F.lit(False)).alias("_at")
    )
    through = records.agg(F.max(date)).scalar()
    return flagged.agg(
        F.count(F.lit(1)).alias("n_ever"),
        F.count_if("_in").alias("n_total"),
        F.count_if(F.col("_in") & F.col("_at")).alias("n_mapped"),
        F.count_if(~F.col("_in")).alias("n_excluded"),
        F.count_if(F.col("_in") & ~F.col("_at")).alias("n_unmapped"),
    ).withColumns({
        "data_through": through,
        "cutoff": cutoff,
        "generated": F.current_date(),
        "recency_months": F.lit(months),
    })


def payload_header(df: DataFrame, city: str) -> DataFrame:
    """part, code, name: what the codes and positions of payload rows stand for.

    Cities come from the rows; categories, score bands and the order of the fields are fixed.
    """
    fixed = [
        (part, code, name)
        for part, names in (("category", V.CATEGORIES), ("band", [b[0] for b in V.BANDS]), ("field", V.MAP_FIELDS))
        for code, name in enumerate(names)
    ]
    cities = dictionary(df, city).select(
        F.lit("city").alias("part"), F.col("code").cast("long").alias("code"), F.col(city).alias("name"))
    return cities.unionByName(df.sparkSession.createDataFrame(fixed, "part string, code long, name string"))
