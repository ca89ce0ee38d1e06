"""Registry of queries with their SQL twins, and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def clips(spark: SparkSession, sf: str) -> DataFrame:
    """Each clip id once, JSON decoded."""
    from ..schema import decode_clips

    return decode_clips(table(spark, sf, "clips"))


def clean(c: str = "channel"):  # noqa: ANN201
    return F.coalesce(F.col(c), F.lit("?"))


# SQL fragments.
ONCE = "(SELECT DISTINCT ON (id) * FROM clips WHERE id IS NOT NULL)"


def metric(name: str, col: str = "metrics_json") -> str:
    x = f"TRY_CAST(replace({col} ->> '$.{name}', ',', '.') AS DOUBLE)"
    return f"CASE WHEN json_valid({col}) AND isfinite({x}) THEN {x} END"


def low(c: str) -> str:
    return f"lower(translate({c}, 'IİÇĞÖŞÜ', 'ıiçğöşü'))"


def key(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({low(f'nfc_normalize({c})')}, '[^\p{{L}}\p{{N}}_\s\x{{00a0}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{3000}}]', ' ', 'g'), '[\s\x{{00a0}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{3000}}]+', ' ', 'g'))"
