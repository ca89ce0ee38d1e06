"""Rule policies: each row is annotated with the reasons that exclude it; no row is dropped.

A rule is ``{"metric": name, "min": x, "max": y, "allow_missing": bool}`` or ``{"flag_absent": [names]}``; rules, thresholds and version are data.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    metric: str | None = None
    least: float | None = None
    most: float | None = None
    allow_missing: bool = False
    flags: tuple[str, ...] = ()

    @classmethod
    def of(cls, raw: dict[str, Any]) -> Rule:
        known = {"metric", "min", "max", "allow_missing", "flag_absent"}
        if set(raw) - known or ("metric" in raw) == ("flag_absent" in raw):
            raise ValueError(f"not a rule: {raw}")
        return cls(raw.get("metric"), raw.get("min"), raw.get("max"), bool(raw.get("allow_missing")), tuple(sorted(raw.get("flag_absent") or ())))

    def reason(self, metrics: Column, flags: Column) -> Column:
        """The reason against a row, or null. Thresholds are written as the configuration has them, so all engines agree on the text."""
        if self.metric is None:
            hit = F.array_sort(F.array_intersect(flags, F.array(*[F.lit(x) for x in self.flags])))
            return F.when(F.size(hit) > 0, F.concat(F.lit("isaret:"), F.array_join(hit, ",")))
        m = F.try_element_at(metrics, F.lit(self.metric))
        out = F.when(m.isNull(), F.lit(None if self.allow_missing else f"eksik_olcum:{self.metric}"))
        if self.least is not None:
            out = out.when(m < self.least, F.lit(f"{self.metric}<{self.least!r}"))
        if self.most is not None:
            out = out.when(m > self.most, F.lit(f"{self.metric}>{self.most!r}"))
        return out


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[Rule, ...] = field(default=())

    @classmethod
    def of(cls, raw: dict[str, Any]) -> Policy:
        return cls(str(raw["version"]), tuple(Rule.of(r) for r in raw.get("rules", ())))

    def reasons(self, metrics: Column, flags: Column) -> Column:
        found = [r.reason(metrics, flags) for r in self.rules]
        return F.filter(F.array(*found), lambda r: r.isNotNull()) if found else F.array().cast("array<string>")

    def annotate(self, df: DataFrame, metrics: str = "metrics", flags: str = "flags") -> DataFrame:
        """Adds exclusion_reasons (in rule order), recommended and policy_version. ``metrics``: map of doubles; ``flags``: array, null as empty."""
        marks = F.coalesce(F.col(flags), F.array().cast("array<string>"))
        return df.withColumn("exclusion_reasons", self.reasons(F.col(metrics), marks)).withColumn("recommended", F.size("exclusion_reasons") == 0).withColumn("policy_version", F.lit(self.version))


def only_reasons(annotated: DataFrame, names: list[str]) -> DataFrame:
    """Rows that are excluded by nothing but the named rules: all their reasons, without what follows the name, are among ``names``."""
    rules = F.transform("exclusion_reasons", lambda r: F.regexp_extract(r, r"^(?:eksik_olcum:)?([^<>:]+)", 1))
    return annotated.filter((F.size("exclusion_reasons") > 0) & (F.size(F.array_except(rules, F.array(*[F.lit(n) for n in names]).cast("array<string>"))) == 0))


def reason_counts(annotated: DataFrame, what: str = "exclusion_reasons", name: str = "reason") -> DataFrame:
    """How often each reason (or flag) occurs."""
    return annotated.select(F.explode(what).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def what_if(annotated: DataFrame, metric: str, below: float, group: str) -> DataFrame:
    """Recommended rows per group, and those that a further rule ``metric`` < ``below`` would take away."""
    m = F.try_element_at(F.col("metrics"), F.lit(metric))
    rec = F.col("recommended")
    return annotated.groupBy(group).agg(F.count_if(rec).alias("n_recommended"), F.count_if(rec & (m < below)).alias("n_lost"), F.round(F.try_divide(100.0 * F.count_if(rec & (m < below)), F.count_if(rec)), 3).alias("lost_pct"))


def dead_rules(df: DataFrame, policy: Policy, metrics: str = "metrics", binding_from: int = 500) -> DataFrame:
    """Per rule metric: values seen, distinct values, and whether the rule is dead (at most one distinct value in ``binding_from`` rows or more)."""
    names = sorted({r.metric for r in policy.rules if r.metric})
    aggs = []
    for i, m in enumerate(names):
        x = F.try_element_at(F.col(metrics), F.lit(m))
        aggs += [F.count(x).alias(f"c{i}"), F.countDistinct(x).alias(f"d{i}")]
    one = df.agg(F.count("*").alias("rows"), *aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"c{i}").alias("n"), F.col(f"d{i}").alias("n_distinct"), ((F.col(f"d{i}") <= 1) & (F.col("rows") >= binding_from)).alias("dead")) for i, m in enumerate(names)])).alias("r")
    return one.select(rows).select("r.*")
