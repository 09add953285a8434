"""Plan shapes that matter at scale: map-side partial aggregation before
shuffles, windows partitioned by bucket (never one global task over rows),
bounded broadcasts, and no Python evaluation in the hot path."""

import re

import pytest

import __spark_entry__ as se
from conftest import SF_SMALL

QUERIES = se.queries()


@pytest.fixture()
def plans(spark, monkeypatch):
    """The plans of a query: of every table that it stores on the way, and of its result."""
    kind, seen = type(spark.range(0)), []
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    checkpoint = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda self, *a, **k: (seen.append(text(self)), checkpoint(self, *a, **k))[1])

    def of(name):
        seen.clear()
        df = QUERIES[name](spark, SF_SMALL)
        return "\n".join([*seen, text(df)])
    return of


def _windows(plan):
    return re.findall(r"Window \[.*?\], \[(.*?)\], \[", plan)


@pytest.mark.parametrize("name", ["dedup_text", "duplicate_count", "activity_label_lineitem",
                                  "term_stats", "bootstrap_ci"])
def test_partial_aggregation_before_shuffle(plans, name):
    plan = plans(name)
    assert "partial_" in plan


@pytest.mark.parametrize("name", ["roc_points", "auc_roc", "stratified_split"])
def test_row_level_windows_are_partitioned(plans, name):
    plan = plans(name)
    parts = _windows(plan)
    assert parts, plan
    # windows over rows carry a range or bucket in their partition spec; the only
    # unpartitioned window is over the totals of the ranges
    assert any("__range" in p or "__cb" in p for p in parts)


@pytest.mark.parametrize("name", ["roc_points", "auc_roc", "compare_models", "term_stats", "vocab_tfidf"])
def test_documents_are_read_once(plans, name):
    """One scan of the texts or lengths; a count of rows may read the file's footer besides."""
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*documents\.parquet", plans(name))
    assert len([x for x in scans if x]) == 1


@pytest.mark.parametrize("name", ["text_features_ref", "text_features_script", "text_features_words",
                                  "term_stats", "vocab_tfidf", "bootstrap_ci", "class_profile"])
def test_no_python_in_plan(plans, name):
    plan = plans(name)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_vocab_broadcast_is_the_bounded_vocabulary(plans):
    plan = plans("vocab_tfidf")
    assert "BroadcastExchange" in plan and "TakeOrderedAndProject" in plan
