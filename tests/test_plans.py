"""Physical-plan checks: the shapes the operators are designed to produce."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import listenlab as L
from listenlab.registry import QUERIES
from listenlab.sources import files
from listenlab.sources.tables import listens


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def scans(p: str, table: str) -> int:
    return p.count(f"{table}.parquet]")


@pytest.fixture(scope="module")
def plans(spark, sf_small):
    return {k: plan(q(spark, sf_small)) for k, q in QUERIES.items() if k not in ("read_listens", "read_clean")}


def test_no_python_evaluation(plans):
    for k, p in plans.items():
        for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
            assert marker not in p, (k, marker)


def test_no_cross_or_nested_loop_joins(plans):
    for k, p in plans.items():
        for marker in ("CartesianProduct", "BroadcastNestedLoopJoin", "Cross"):
            assert marker not in p, (k, marker)


SINGLE_PASS = [
    "artist_state_listens", "artist_state_listens_all", "artists_over", "top_n_by_listens", "states_list",
    "top_artists", "top_artists_all", "bottom_artists", "top_songs_free", "top_songs_paid", "top_songs_all",
    "kpis", "kpi_cards", "subscription_mix", "subscription_mix_all", "state_map", "state_map_all", "map_stats",
    "map_summary_prompt", "bottom_artists_prompt", "qa_context", "clean_listens",
]
# The set of paid users is a second, narrow pass.
TWO_PASSES = [
    "effective_subscription", "monthly_listening", "monthly_listening_all", "monthly_stats",
    "monthly_summary_prompt", "table_prompt",
]


@pytest.mark.parametrize("key", SINGLE_PASS)
def test_fact_table_read_once(plans, key):
    # "all locations" forms roll Nationwide up from the per-state aggregate:
    # the fact rows are scanned and joined once, not once per grouping.
    assert scans(plans[key], "lineitem") == 1, key


@pytest.mark.parametrize("key", TWO_PASSES)
def test_paid_users_are_a_narrow_second_pass(plans, key):
    assert scans(plans[key], "lineitem") <= 2, key


def test_effective_subscription_is_lazy(spark, sf_small):
    d = listens(spark, sf_small)
    spark.sparkContext.setJobGroup("lazy", "plan only")
    L.effective_subscription(d)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")) == []
    spark.sparkContext.setJobGroup("other", "")


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_effective_subscription_in_both_join_forms(spark, sf_small, threshold):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = L.effective_subscription(listens(spark, sf_small))
        rows = df.collect()
        p = df._jdf.queryExecution().executedPlan().toString()  # final, once it ran
        p = p[: p.index("Initial Plan")]
        assert ("SortMergeJoin [userId" if threshold == "-1" else "BroadcastHashJoin [userId") in p
        assert "InSet" not in p
        users = {r.userId for r in df.where("raw_subscription = 'paid'").select("userId").collect()} - {None}
        for r in rows:
            assert r.subscription == ("paid" if r.userId in users else r.raw_subscription)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_top_k_plans_hold_for_any_n(spark, sf_small):
    d = listens(spark, sf_small)
    assert "TakeOrderedAndProject" in plan(L.top_artists(d, n=5000))
    rows = spark.range(30_000).selectExpr("id % 3 as g", "id", "id % 1000 as n")
    from listenlab.plans.topk import top_k

    big = top_k(rows, 2000, [F.desc("n"), F.asc("id")], ["g"])
    got = {(r.g, r["rank"]): (r.n, r.id) for r in big.collect()}
    for g in range(3):
        order = sorted(((-(i % 1000), i) for i in range(g, 30_000, 3)))[:2000]
        assert [got[g, k + 1] for k in range(2000)] == [(-n, i) for n, i in order]
    assert "_topk_part" not in str(big.columns)


@pytest.mark.parametrize("key", ["top_artists_all", "top_songs_all"])
def test_topk_per_group_limits_before_shuffle(plans, key):
    assert "WindowGroupLimit" in plans[key] and "Partial" in plans[key], key


@pytest.mark.parametrize("key", ["top_artists", "bottom_artists", "top_n_by_listens", "top_songs_free", "top_songs_paid"])
def test_global_topk_is_take_ordered(plans, key):
    # an unpartitioned row_number() <= k becomes a per-task top-k merged once
    assert "TakeOrderedAndProject" in plans[key], key


def test_state_map_without_join(spark):
    df = spark.createDataFrame(
        [("A", "CA"), ("A", "NY"), ("B", "PR"), (None, "CA")], "artist string, state string"
    )
    for out in (L.state_map_all(df), L.state_map(df, "A"), L.map_stats_all(df)):
        p = plan(out)
        assert "Join" not in p and "CartesianProduct" not in p


def test_monthly_listening_filters_at_the_scan(spark, sf_small, tmp_path):
    path = str(tmp_path / "clean")
    files.write_clean(listens(spark, sf_small), path)
    stored = files.read_clean(spark, path)
    p = plan(L.monthly_listening(stored, "CA"))
    assert "PushedFilters: [IsNotNull(state), EqualTo(state,CA)]" in p
    assert "EqualTo(subscription,paid)" in p
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(L.monthly_listening_all(stored))
        # the user-month rows for their sum, then once by user; and the ids of paid users. Listens are never exchanged.
        assert p.count("Exchange hashpartitioning(userId") == 3 and "Window" not in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_stored_clean_pushdown(spark, sf_small, tmp_path):
    path = str(tmp_path / "clean")
    files.write_clean(listens(spark, sf_small), path)
    stored = files.read_clean(spark, path)
    p = plan(stored.where((F.col("year") == 1996) & (F.col("state") == "CA")).select("artist"))
    assert "PartitionFilters: [isnotnull(year" in p and "(year#" in p
    assert "PushedFilters: [IsNotNull(state), EqualTo(state,CA)]" in p
    assert "ReadSchema: struct<artist:string,state:string>" in p
