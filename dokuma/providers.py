"""Stages that measure: a provider maps Arrow batches of items to declared outputs; models stay outside the engine.

A provider has a name, a revision, an output schema and a function over pandas batches; the engine takes care of pending items, owned
metrics and flags, errors as data, and completion marks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import ledger

FORBIDDEN = frozenset({"recommended", "exclusion_reasons", "policy_version", "duplicate_of"})


@dataclass(frozen=True)
class Provider:
    name: str
    version: str
    inputs: tuple[str, ...]
    metrics: tuple[str, ...]
    flags: tuple[str, ...]
    measure: Callable[[pd.DataFrame], pd.DataFrame]
    key: str = "id"

    def __post_init__(self) -> None:
        bad = FORBIDDEN & {*self.metrics, *self.flags}
        if bad:
            raise ValueError(f"{self.name}: decisions are no measurements: {', '.join(sorted(bad))}")


def verified(path: str, sha256: str | None) -> str:
    """``path`` if it is there and has the digest; weights without one, or others, are an error before anything is measured."""
    import hashlib
    import os

    if not path or not os.path.exists(path):
        raise FileNotFoundError(f"no weights at {path!r}")
    if not sha256:
        raise ValueError(f"no digest is configured for {path}")
    with open(path, "rb") as f:
        found = hashlib.file_digest(f, "sha256").hexdigest()
    if found != sha256.lower():
        raise ValueError(f"{path} has digest {found}, not {sha256}")
    return path


_known: dict[str, Provider] = {}


def register(p: Provider, override: bool = False) -> Provider:
    if p.name in _known and not override:
        raise ValueError(f"stage {p.name} is registered already")
    _known[p.name] = p
    return p


def get(name: str) -> Provider:
    return _known[name]


def run(items: DataFrame, p: Provider) -> DataFrame:
    """(key, metrics, flags, error): one row per item. A batch that raises is halved until the items that raise are alone; such an item has the error and nothing else."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        out = p.measure(pdf)
        metrics = [{m: float(r[m]) for m in p.metrics if m in out.columns and pd.notna(r[m])} for _, r in out.iterrows()]
        flags = [[f for f in p.flags if f in out.columns and bool(r[f])] for _, r in out.iterrows()]
        return pd.DataFrame({p.key: out[p.key].to_numpy(), "metrics": metrics, "flags": flags, "error": None})

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            todo = [pdf] if len(pdf) else []
            while todo:
                part = todo.pop()
                try:
                    out = one(part)
                except Exception as e:  # noqa: BLE001 - errors are data
                    if len(part) > 1:
                        todo += [part.iloc[len(part) // 2 :], part.iloc[: len(part) // 2]]
                        continue
                    out = pd.DataFrame({p.key: part[p.key].to_numpy(), "metrics": [{}], "flags": [[]], "error": [f"{type(e).__name__}: {e}"[:500]]})
                yield out

    kind = dict(items.dtypes)[p.key]
    return items.select(p.key, *p.inputs).mapInPandas(batches, f"{p.key} {kind}, metrics map<string,double>, flags array<string>, error string")


def advance(items: DataFrame, done: DataFrame, p: Provider, kind: str = "clip") -> tuple[DataFrame, DataFrame]:
    """(items, marks): pending items measured and merged; new marks of those without error."""
    from .session import materialize

    todo = ledger.pending(items, F.col(p.key), done, kind, p.name, p.version)
    found = materialize(run(todo, p), p.name)
    merged = ledger.merge_owned(items, found.filter("error is null"), list(p.metrics), list(p.flags), p.key)
    marks = found.filter("error is null").select(F.lit(kind).alias("kind"), F.col(p.key).cast("string").alias("item_key"), F.lit(p.name).alias("stage"), F.lit(p.version).alias("version"))
    return merged, marks
