"""All problem queries over empty tables, and over tables with extra columns whose names the operators use inside."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from dokuma.llm.queries import ALL

NAMES = "k1 k2 n rank band node root score evidence host piece run group_id item _rank _part w bm feats held line_no key count position rows p v metric hot _hot part owner slots size".split()


@pytest.fixture(scope="module")
def shaped(sf, tmp_path_factory):
    base = tmp_path_factory.mktemp("shaped")
    for kind in ("empty", "extra"):
        (base / kind).mkdir()
    for f in os.listdir(sf):
        t = pq.read_table(f"{sf}/{f}")
        pq.write_table(t.slice(0, 0), base / "empty" / f)
        for c in NAMES:
            if c not in t.column_names:
                t = t.append_column(c, pa.array(["x"] * len(t)))
        pq.write_table(t, base / "extra" / f)
    return base


@pytest.mark.parametrize("name", sorted(ALL))
def test_empty_tables(spark, shaped, name):
    out = ALL[name](spark, str(shaped / "empty"))
    assert out.count() == {"p7_summary": 1, "p7_checks": 6, "p5_checks": 4}.get(name, 0)


@pytest.mark.parametrize("name", sorted(ALL))
def test_extra_columns(spark, sf, shaped, name):
    a, b = (ALL[name](spark, d) for d in (sf, str(shaped / "extra")))
    assert a.columns == b.columns
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
