"""Physical-plan properties that the design relies on at scale.

Plans are taken with static broadcasts disabled (as when inputs are large),
so only broadcasts of a known size remain.
"""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


@pytest.fixture
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(spark, name, capsys):
    df = entry.queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    df.explain("formatted")
    return capsys.readouterr().out


def test_dedup_combines_map_side(no_auto_broadcast, capsys):
    plan = _plan(no_auto_broadcast, "clean_items", capsys)
    assert "partial_max(struct(" in plan
    # orders and pre-aggregated line items are shuffled once each, and the
    # dedup reuses the join's partitioning on the item key (no third shuffle)
    assert len(re.findall(r"hashpartitioning\((o_orderkey|l_orderkey)", plan)) == 2
    assert "hashpartitioning(movie_id" not in plan
    assert "partial_collect_set" in plan


def test_flagship_reads_what_it_needs(no_auto_broadcast, capsys):
    plan = _plan(no_auto_broadcast, "top_genres", capsys)
    assert "documents" not in plan  # no language lookup
    scans = set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in scans
    assert not any("o_totalprice" in s or "o_orderdate" in s for s in scans)
    assert "hashpartitioning(movie_id" not in plan  # both sides keep the dedup's partitioning
    assert "TakeOrderedAndProject" in plan


def test_building_a_query_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    for name in ("top_genres", "row_counts", "items_enriched", "dq_relationships", "fact_by_calendar", "metric_p99"):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        entry.queries()[name](spark, SF_SMALL)
        # Reading a table's schema is the one job of a first use of a table.
        entry.queries()[name](spark, SF_SMALL)
        jobs = len(tracker.getJobIdsForGroup(f"build-{name}"))
        spark.sparkContext.setJobGroup(f"again-{name}", name)
        entry.queries()[name](spark, SF_SMALL)
        assert tracker.getJobIdsForGroup(f"again-{name}") == [], (name, jobs)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_plans_build_at_the_partition_count_of_100_tb(spark):
    from reelhouse.session import sizing_conf

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", sizing_conf(100 * 1024**4, 8000)["spark.sql.shuffle.partitions"])
    try:
        for name in ("top_genres", "row_counts", "dq_suite_dirty", "metric_rate"):
            entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_a_large_parent_is_not_hinted(no_auto_broadcast, capsys):
    plan = _plan(no_auto_broadcast, "items_enriched", capsys)
    assert "strategy=broadcast" not in plan and "SortMergeJoin LeftOuter" in plan


def test_paging_has_no_global_sort(spark, capsys):
    plan = _plan(spark, "discover_page", capsys)
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_counter_samples_are_read_once(spark, capsys):
    df = entry.queries()["metric_increase"](spark, SF_SMALL)
    df.collect()
    df.explain("formatted")  # final adaptive plan of this execution
    plan = capsys.readouterr().out
    final = plan.split("== Initial Plan ==")[0]
    # the predecessor window and the per-bucket frame share one shuffle
    assert len(re.findall(r"Scan parquet", final)) == 1
    assert "Reused" in final


def test_scans_read_only_needed_columns(spark, capsys):
    plan = _plan(spark, "metric_p99", capsys)
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert set(schemas) == {"struct<user_id:bigint,event_type:string,value:double>"}
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in plan


def test_no_python_in_batch_queries(spark, capsys):
    for name in ("clean_items", "metric_mapping", "dq_suite", "metric_rate"):
        plan = _plan(spark, name, capsys)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_suite_scans_the_item_layer_a_few_times(spark):
    df = entry.queries()["dq_suite"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[movie_id", plan)) <= 8
    assert "Expand" not in plan


def test_sized_bounds_tasks_and_gives_settings_back(spark):
    from reelhouse.session import sized

    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"]
    before = [spark.conf.get(k) for k in keys]
    with sized(spark, 36_000_000):
        assert [spark.conf.get(k) for k in keys] == ["180", "8388608", "8388608"]
    assert [spark.conf.get(k) for k in keys] == before
    spark.conf.set(keys[2], "2m")
    try:
        with sized(spark, 5):  # smaller tasks that a session asks for stay
            assert [spark.conf.get(keys[0]), spark.conf.get(keys[2])] == [before[0], str(2 << 20)]
        assert spark.conf.get(keys[2]) == "2m"
    finally:
        spark.conf.set(keys[2], before[2])


def test_views_query_runs_sized(spark, monkeypatch):
    from reelhouse.plans import pipeline as steps, queries
    from tests.conftest import SF_SMALL

    seen, models = [], steps.warehouse_catalogue
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    monkeypatch.setattr(steps, "warehouse_catalogue", lambda s, *a: seen.append(s.conf.get(key)) or models(s, *a))
    assert queries.q_views_top_genres(spark, SF_SMALL).count() == 5
    assert seen == [str(8 << 20)]
