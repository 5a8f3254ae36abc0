"""The physical plans the library counts on."""

import pytest

import __spark_entry__ as entry_points
from tidemark.operators import counts, distinct
from tidemark.operators.lateness import RunningMax
from tidemark.plans import registry, views

QUERIES = entry_points.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def plans(spark, sf_small):
    return {name: plan(query(spark, sf_small)) for name, query in registry.BATCH.items()}


def test_no_python_and_no_cross_join(plans):
    for name, text in plans.items():
        for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert operator not in text, name


def test_overlapping_windows_do_not_copy_rows(plans):
    for name in ("item_view_counts", "page_view_counts", "hot_items_top5", "hot_pages_top3"):
        assert "Expand" not in plans[name], name


def test_rankings_are_cut_before_they_are_shuffled(plans):
    for name in ("hot_items_top5", "hot_pages_top3", "hot_pages_final_top3"):
        assert "Partial" in plans[name] and plans[name].count("WindowGroupLimit") >= 2, name


def test_only_the_columns_of_a_query_are_read(plans):
    schema = lambda name: plans[name].split("ReadSchema: ")[1].split("\n")[0]
    assert "user_id" not in schema("pv_hourly") and "props" not in schema("pv_hourly")
    assert "props" not in schema("uv_hourly") and "value" not in schema("uv_hourly")
    assert "user_id" not in schema("page_view_counts")


def test_filters_reach_the_scan(spark, sf_small, tmp_path):
    path = str(tmp_path / "behavior")
    views.behavior_events(spark, sf_small).write.parquet(path)
    table = spark.read.parquet(path)
    for df in (counts.page_views(table), counts.item_view_counts(table), distinct.unique_visitors(table)):
        assert "EqualTo(behavior,pv)" in plan(df)


def test_log_rows_are_not_shuffled_to_find_the_running_maximum(plans):
    text = plans["page_counts_final"]
    assert "BroadcastHashJoin LeftOuter BuildRight" in text
    assert "SortMergeJoin" not in text


def test_first_arrivals_are_found_without_a_sort_of_the_rows(spark, sf_small):
    rows = views.arrival_events(spark, sf_small)
    text = plan(RunningMax(rows, ["arrival_key", "event_id"], 5_000, at_most=1).marks)
    assert "HashAggregate" in text and "Sort" not in text


def test_bitmaps_and_sketches_are_merged_by_pane(plans):
    assert "bitmap_or_agg" in plans["uv_sliding_bitmap"] and "hll_union_agg" in plans["uv_sliding_sketch"]
