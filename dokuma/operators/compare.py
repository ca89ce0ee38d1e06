"""Comparing two tables, and schema drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_by(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key by ``order``: an aggregation with map-side combine, not a sort."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")).select(key, "_r.*").select(*df.columns)


def table_diff(a: DataFrame, b: DataFrame, key: str, columns: list[str], paths: tuple[str, ...] = ()) -> DataFrame:
    """One row per column: keys only in a, only in b and in both; differing values over common keys (null-safe; paths by base name, arrays as sets), the
    largest numeric difference and the least key that differs. One full outer join, one aggregation."""
    j = a.select(key, *columns).withColumn("_ina", F.lit(True)).alias("a").join(b.select(key, *columns).withColumn("_inb", F.lit(True)).alias("b"), key, "full_outer")
    both = F.col("_ina") & F.col("_inb")
    aggs = [F.count_if(F.col("_inb").isNull()).alias("_a"), F.count_if(F.col("_ina").isNull()).alias("_b"), F.count_if(both).alias("_both")]
    for i, c in enumerate(columns):
        kind = a.schema[c].dataType
        x, y = F.col(f"a.{c}"), F.col(f"b.{c}")
        if c in paths:
            x, y = (F.element_at(F.split(v, "/"), -1) for v in (x, y))
        elif isinstance(kind, T.ArrayType):
            x, y = (F.array_sort(F.array_distinct(v)) for v in (x, y))
        differs = F.coalesce(both, F.lit(False)) & ~x.eqNullSafe(y)
        size = F.max(F.when(both, F.abs(x.cast("double") - y.cast("double")))) if isinstance(kind, T.NumericType) else F.lit(None).cast("double")
        aggs += [F.count_if(differs).alias(f"n{i}"), size.alias(f"d{i}"), F.min(F.when(differs, F.col(key))).alias(f"e{i}")]
    one = j.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col("_a").alias("only_a"), F.col("_b").alias("only_b"), F.col("_both").alias("common"), F.col(f"n{i}").alias("n_differ"), F.col(f"d{i}").alias("max_delta"), F.col(f"e{i}").cast("string").alias("example")) for i, c in enumerate(columns)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def schema_drift(df: DataFrame, required: T.StructType, optional: tuple[str, ...] = ()) -> dict[str, list[str]]:
    """Missing, unknown and differently typed columns."""
    want, have = {f.name: f.dataType for f in required}, {f.name: f.dataType for f in df.schema}
    return {"missing": sorted(set(want) - set(have) - set(optional)), "unknown": sorted(set(have) - set(want)), "retyped": sorted(c for c in set(want) & set(have) if want[c].simpleString() != have[c].simpleString())}
