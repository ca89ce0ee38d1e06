"""Queries of the engine over empty tables: a defined result, no failure."""

import os

import pyarrow.parquet as pq
import pytest

from dokuma import catalogue

ONE_ROW = {"duplicate_summary", "scorecard", "corpus_counts", "percentile_linear", "ablation_stats", "spearman", "spearman_lineitem"}


@pytest.fixture(scope="module")
def empty(sf, tmp_path_factory):
    base = tmp_path_factory.mktemp("empty")
    for f in os.listdir(sf):
        pq.write_table(pq.read_table(f"{sf}/{f}").slice(0, 0), base / f)
    return str(base)


@pytest.mark.parametrize("name", ["manifest", "policy_annotate", "dead_rule_check", "duplicate_mark", "split_assign", "quota_trim", "round_robin_sources", "strided_sample", "distribution_hist", "column_profile", "findings_pivot", "sentence_spans", "attach_clitics", "segment_sentences", "segment_silence", "ablation_two_arms", "boilerplate_phrases", "phrase_spans", "margins", "cluster", "eer_threshold", "quantile_floor", "manifest_diff", "owned_key_merge", "session_regions", *sorted(ONE_ROW)])
def test_empty_tables(spark, empty, name):
    n = catalogue.queries()[name](spark, empty).count()
    if name in ONE_ROW:
        assert n == 1
