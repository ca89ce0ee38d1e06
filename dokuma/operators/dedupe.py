"""Duplicates by text and exact signal identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def mark_duplicates(df: DataFrame, key: Column, identity: list[Column], score: Column, position: list[Column], id_col: str = "id", flag: str = "duplicate") -> DataFrame:
    """Adds dedupe_key, duplicate_of (the kept row's id, null for kept rows) and the flag among ``flags``.

    Rows are one group when key and all identity values are equal; an empty or null key or a null identity value groups with nothing. The row of the highest
    score is kept (nulls last), ties by ``position``. The keeper is found by an aggregation with map-side combine and joined back,
    so a key with a third of all rows is neither sorted nor gathered in one task."""
    names = [f"_i{i}" for i in range(len(identity))]
    keyed = df.withColumn("dedupe_key", key).withColumns({n: c for n, c in zip(names, identity)})
    able = (F.coalesce(F.col("dedupe_key"), F.lit("")) != "") & F.expr(" AND ".join(f"{n} IS NOT NULL" for n in names) or "true")
    order = F.struct(*[F.coalesce(-score.cast("double"), F.lit(float("inf"))).alias("s"), *[p.alias(f"p{i}") for i, p in enumerate(position)], F.col(id_col).alias("id")])
    keepers = keyed.filter(able).groupBy("dedupe_key", *names).agg(F.min(order).alias("_best"), F.count("*").alias("_n")).filter("_n > 1").select("dedupe_key", *names, F.col("_best.id").alias("_keeper"))
    out = keyed.join(keepers, ["dedupe_key", *names], "left").withColumn("duplicate_of", F.when(F.col("_keeper") != F.col(id_col), F.col("_keeper")))
    out = out.drop(*names, "_keeper")
    if "flags" in df.columns:
        out = out.withColumn("flags", F.when(F.col("duplicate_of").isNotNull(), F.array_union(F.coalesce("flags", F.array().cast("array<string>")), F.array(F.lit(flag)))).otherwise(F.col("flags")))
    return out.select(*df.columns, "dedupe_key", "duplicate_of")


def summary(marked: DataFrame) -> DataFrame:
    """One row: duplicates and the number of kept rows that have any."""
    return marked.agg(F.count("duplicate_of").alias("duplicates"), F.countDistinct("duplicate_of").alias("kept_groups"))


def compare_definitions(df: DataFrame, definitions: dict[str, list[str]]) -> DataFrame:
    """Per definition (list of columns): rows beyond the first of each group, and groups of several rows; rows with a null in a column group with nothing."""
    parts = []
    for name, cols in definitions.items():
        g = df.dropna(subset=cols).groupBy(*cols).agg(F.count("*").alias("n")).filter("n > 1")
        parts.append(g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"), F.count("*").alias("groups")).select(F.lit(name).alias("definition"), "duplicates", "groups"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def first_in_group(df: DataFrame, groups: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group. Rows beyond are cut per task first (Spark pushes row_number limits below the shuffle)."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).filter(F.col("_rn") <= n).drop("_rn")
