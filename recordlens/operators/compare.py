"""Two tables compared by key: what is missing, extra or changed, and in which columns."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differences(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, status and columns: ``missing`` rows stand in ``right`` only, ``extra`` ones in ``left`` only, ``changed`` ones in
    both with other values in ``columns``. NULL keys and values are values like others.

    Rows that repeat a key are told apart by their values in order: the first of one side meets the first of the other.
    """
    keys = list(keys)
    values = [c for c in left.columns if c not in keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*values))).alias("_rows")).select(
            *[F.col(c).alias(f"_{name}_{c}") for c in keys], F.posexplode("_rows").alias(f"_{name}_n", f"_{name}"))

    a, b = side(left, "a"), side(right, "b")
    same: Column = reduce(lambda x, y: x & y, [
        F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")) for c in [*keys, "n"]])
    both = a.join(b, same, "full")
    changed = F.array_compact(F.array(*[
        F.when(~F.col("_a")[c].eqNullSafe(F.col("_b")[c]), F.lit(c)) for c in values])) if values else F.array().cast("array<string>")
    in_left, in_right = F.col("_a_n").isNotNull(), F.col("_b_n").isNotNull()
    status = F.when(~in_left, "missing").when(~in_right, "extra").when(F.size(changed) > 0, "changed")
    return both.select(
        *[F.when(in_left, F.col(f"_a_{c}")).otherwise(F.col(f"_b_{c}")).alias(c) for c in keys], status.alias("status"),
        F.when(in_left & in_right, F.array_join(changed, ",")).alias("columns")).filter("status IS NOT NULL")
