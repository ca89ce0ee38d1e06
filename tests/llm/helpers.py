"""Small tables with every awkward case: nulls, blanks, long texts, ties, repeated rows, extra columns with names the operators use inside."""

from pyspark.sql import types as T

CLIP = "id string, source_id int, channel string, duration double, text string, text_spoken string, metrics_json string"
EXTRA = ", k1 string, n string, rank string, band string, `_rank` string, `_stratum` string, weight double"


def clips(spark, rows, extra=True):
    rows = [tuple(r) + (None,) * (7 - len(r)) for r in rows]
    if extra:
        rows = [r + ("x", "x", "x", "x", "x", "x", 1.0) for r in rows]
    return spark.createDataFrame(rows, CLIP + (EXTRA if extra else ""))


def documents(spark, rows):
    rows = [tuple(r) + ("x", "x", 1) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, n_tokens string, host string, evidence int")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


LONG = " ".join(f"kelime{i % 977}" for i in range(60_000))
__all__ = ["LONG", "T", "clips", "documents", "rows"]
