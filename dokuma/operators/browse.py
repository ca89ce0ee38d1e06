"""Typed filters, sorting, paging and column profiles over a clip table: the query service as Column builders."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import lower_tr, tr_lower
from .split import hash_order
from .stats import linear_percentiles

COMPARE = {"gt": "__gt__", "ge": "__ge__", "lt": "__lt__", "le": "__le__", ">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__", "=": "__eq__"}
CONDITION = re.compile(r"^\s*([\w.]+)\s*(>=|<=|>|<|=)\s*(-?\d+(?:\.\d+)?)\s*$")


def field(df: DataFrame, name: str) -> Column:
    """A column, a metric, or a dotted part of either; unknown names are null."""
    head, _, tail = name.partition(".")
    if head in df.columns:
        if not tail:
            return F.col(head)
        kind = df.schema[head].dataType
        return F.try_element_at(F.col(head), F.lit(tail)) if isinstance(kind, T.MapType) else F.col(f"{head}.{tail}")
    if "metrics" in df.columns:
        return F.try_element_at(F.col("metrics"), F.lit(name))
    return F.lit(None)


def number(c: Column) -> Column:
    return c.cast("string").try_cast("double")


def is_empty(c: Column, kind: str) -> Column:
    if kind == "list":
        return F.coalesce(F.size(c) == 0, F.lit(True))
    return c.isNull() if kind in ("num", "bool") else F.coalesce(c.cast("string") == "", F.lit(True))


def parse_conditions(text: str) -> list[tuple[str, str, float]]:
    """``name op number;...``; parts that aren't conditions are ignored."""
    return [(m[1], m[2], float(m[3])) for m in map(CONDITION.match, (text or "").split(";")) if m]


def condition(df: DataFrame, cond: tuple[str, str, float]) -> Column:
    name, op, value = cond
    return F.coalesce(getattr(number(field(df, name)), COMPARE[op])(F.lit(value)), F.lit(False))


def match(c: Column, kind: str, op: str, raw: str = "") -> Column:
    """The operator matrix: kind num, str, enum, list or bool. Unknown operators and unreadable input match nothing; only the chosen
    operator is evaluated, so a pattern character in plain text is harmless."""
    if op == "empty":
        return is_empty(c, kind)
    if op == "notempty":
        return ~is_empty(c, kind)
    if kind == "bool":
        text = F.lower(c.cast("string"))
        return F.coalesce(text.isin("true", "1") if op == "true" else text.isin("false", "0") if op == "false" else F.lit(False), F.lit(False))
    if kind == "list":
        low = F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: lower_tr(x))
        if op in ("has", "nothas"):
            found = F.coalesce(F.exists(low, lambda x: F.contains(x, F.lit(tr_lower(raw)))), F.lit(False))
            return c.isNotNull() & (found if op == "has" else ~found)
        if op in ("count_gt", "count_lt") and re.fullmatch(r"-?\d+(\.\d+)?", raw.strip()):
            n = F.size(c)
            return F.coalesce(n > float(raw) if op == "count_gt" else n < float(raw), F.lit(False))
        return F.lit(False)
    if kind == "num" and re.fullmatch(r"\s*-?\d+(\.\d+)?\s*", raw):
        x, v = number(c), float(raw)
        if op in ("gt", "ge", "lt", "le"):
            return F.coalesce(getattr(x, COMPARE[op])(F.lit(v)), F.lit(False))
        if op == "eq":
            return F.coalesce(x == v, F.lit(False))
        if op == "ne":
            return F.coalesce(x != v, F.lit(True))
    if kind == "num" and op in ("gt", "ge", "lt", "le"):
        return F.lit(False)
    text, want = lower_tr(F.coalesce(c.cast("string"), F.lit(""))), F.lit(tr_lower(raw))
    if op in ("contains", "ncontains"):
        return F.contains(text, want) if op == "contains" else ~F.contains(text, want)
    if op in ("eq", "ne"):
        return text == want if op == "eq" else text != want
    if op in ("starts", "ends"):
        return F.startswith(text, want) if op == "starts" else F.endswith(text, want)
    if op == "re":
        try:
            re.compile(raw)
        except re.error:
            return F.lit(False)
        return F.coalesce(c.cast("string"), F.lit("")).rlike("(?iu)" + raw)
    return F.lit(False)


def parse_filters(text: str) -> list[dict]:
    """JSON rows {c, o, v}; bad JSON is no filter."""
    try:
        rows = json.loads(text or "[]")
    except ValueError:
        return []
    return [r for r in rows if isinstance(r, dict) and {"c", "o"} <= set(r)] if isinstance(rows, list) else []


def kind_of(df: DataFrame, name: str) -> str:
    if name in df.columns:
        t = df.schema[name].dataType
        return "list" if isinstance(t, T.ArrayType) else "bool" if isinstance(t, T.BooleanType) else "num" if isinstance(t, T.NumericType) else "str"
    return "num"


def select_clips(df: DataFrame, *, source: int | None = None, channel: str | None = None, ids: DataFrame | None = None, q: str = "", flag: str = "", least: float | None = None, most: float | None = None, audio: bool | None = None, cond: str = "", rec: str = "", reason: str = "", noted: str = "", f: str = "") -> DataFrame:
    """One conjunctive selection for list, statistics and histogram. Each argument is a filter; Catalyst merges and pushes them."""
    if source is not None:
        df = df.filter(F.col("source_id") == source)
    if channel:
        df = df.filter(F.col("channel") == channel)
    if ids is not None:
        df = df.join(ids.select("id").distinct(), "id", "left_semi")
    if q:
        df = df.filter(F.contains(lower_tr(F.coalesce("text", F.lit(""))), F.lit(tr_lower(q))))
    if flag:
        df = df.filter(F.coalesce(F.size("flags") == 0, F.lit(True)) if flag == "none" else F.coalesce(F.array_contains("flags", flag), F.lit(False)))
    if least is not None:
        df = df.filter(F.col("duration") >= least)
    if most is not None:
        df = df.filter(F.col("duration") <= most)
    if audio is not None:
        df = df.filter((F.coalesce("audio", F.lit("")) != "") == audio)
    for c in parse_conditions(cond):
        df = df.filter(condition(df, c))
    if rec in ("yes", "no"):
        df = df.filter(F.coalesce(F.col("recommended") == (rec == "yes"), F.lit(False)))
    if reason:
        df = df.filter(F.coalesce(F.exists("exclusion_reasons", lambda x: F.contains(x, F.lit(reason))), F.lit(False)))
    if noted:
        verdict = F.col("verdict")
        df = df.filter(verdict.isNotNull() if noted == "yes" else verdict.isNull() if noted == "no" else F.coalesce(F.array_contains("tags", noted[4:]), F.lit(False)) if noted.startswith("tag:") else F.coalesce(verdict == noted, F.lit(False)))
    for row in parse_filters(f):
        df = df.filter(match(field(df, row["c"]), row.get("t") or kind_of(df, row["c"]), row["o"], str(row.get("v", ""))))
    return df


def sort_key(df: DataFrame, name: str) -> Column:
    """Numbers as numbers, lists joined, texts in Turkish lower case; empty as null."""
    c, kind = field(df, name), kind_of(df, name)
    if kind in ("num", "bool"):
        return c.cast("double")
    text = lower_tr(F.array_join(c, ", ") if kind == "list" else c.cast("string"))
    return F.when(text != "", text)


def sort_clips(df: DataFrame, name: str, descending: bool = False, tie: str = "id") -> DataFrame:
    k = sort_key(df, name)
    return df.orderBy(k.desc_nulls_last() if descending else k.asc_nulls_last(), tie)


def page(df: DataFrame, name: str, offset: int, limit: int, descending: bool = False) -> DataFrame:
    """One page of the sorted rows; the limit is kept within 1..1000."""
    return sort_clips(df, name, descending).offset(max(0, offset)).limit(min(1000, max(1, limit)))


def seeded_sample(df: DataFrame, n: int, seed: str, id_col: str = "id") -> DataFrame:
    return df.orderBy(hash_order(seed, F.col(id_col)), id_col).limit(n)


def distribution(df: DataFrame, name: str, bins: int = 24) -> DataFrame:
    """Histogram of a numeric column between its least and greatest value: bin, bounds, count, rows below and at or above. Two aggregations; nothing is gathered."""
    v = df.select(number(field(df, name)).alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") != float("inf")))
    ends = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("total"))
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0).cast("int")
    counts = v.crossJoin(F.broadcast(ends)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))  # ends: one row
    every = ends.filter("total > 0").select("lo", "hi", "total", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    out = every.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    below = F.coalesce(F.sum("n").over(w), F.lit(0))  # over the bins only
    return out.select("bin", (F.col("lo") + F.col("bin") * width).alias("from"), (F.col("lo") + (F.col("bin") + 1) * width).alias("to"), "n", below.alias("below"), (F.col("total") - below).alias("above"))


def describe(df: DataFrame, name: str, ps: tuple[float, ...] = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)) -> DataFrame:
    """n, least, greatest, mean and interpolated percentiles of a numeric column, as one row."""
    v = number(field(df, name))
    d = df.select(F.when(~F.isnan(v), v).alias("v"))
    names = {f"p{round(100 * p):02d}": p for p in ps}
    one = d.agg(F.count("v").alias("n"), F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"))
    qs = linear_percentiles(d, [], "v", names).drop("n")
    return one.crossJoin(F.broadcast(qs)).select("n", "min", "max", F.round("mean", 6).alias("mean"), *[F.round(q, 6).alias(q) for q in names])  # one row each


def profile(df: DataFrame, names: list[str], top: int = 60) -> DataFrame:
    """Per column: filled rows, numeric rows, distinct values and the ``top`` most common ones with their counts (ties by value)."""
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("column"), (F.array_join(field(df, n), ", ") if kind_of(df, n) == "list" else field(df, n).cast("string")).alias("value")) for n in names])).alias("x")).select("x.*").filter("value is not null AND value <> ''")
    counts = cells.groupBy("column", "value").agg(F.count("*").alias("n"))
    w = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    totals = counts.groupBy("column").agg(F.sum("n").alias("n_filled"), F.sum(F.when(F.col("value").try_cast("double").isNotNull(), F.col("n")).otherwise(0)).alias("n_numeric"), F.count("*").alias("n_distinct"))
    best = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return best.join(totals, "column").select("column", "value", "n", F.col("rank").cast("int").alias("rank"), "n_filled", "n_numeric", "n_distinct")


def scorecard(df: DataFrame) -> DataFrame:
    """One row over a pool: clips, hours, judged clips, clean share, recommended and not."""
    return df.agg(
        F.count("*").alias("n"), F.round(F.sum("duration") / 3600, 4).alias("hours"), F.count("verdict").alias("judged"), F.count_if(F.col("verdict") == "temiz").alias("clean"),
        F.round(F.try_divide(F.count_if(F.col("verdict") == "temiz"), F.count("verdict")), 4).alias("clean_rate"), F.count_if(F.col("recommended")).alias("rec_yes"), F.count_if(~F.col("recommended")).alias("rec_no"), F.count_if(F.col("recommended").isNull()).alias("rec_none"),
    )


def top_values(df: DataFrame, column: str, k: int, name: str = "value") -> DataFrame:
    """The k most common values (of a list: elements), ties by value."""
    v = F.explode(column) if kind_of(df, column) == "list" else F.col(column)
    return df.select(v.alias(name)).filter(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n")).orderBy(F.desc("n"), name).limit(k)
