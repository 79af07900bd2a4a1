"""Contiguous ids, stable splits and samples, windows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from encore.operators import indexing, prefix, sampling
from encore.sources import tables
from tests.conftest import SF


def test_contiguous_index_matches_global_row_number(spark):
    df = spark.createDataFrame([(f"u{i % 37:03d}",) for i in range(500)] + [(None,)], "user_id string")
    got = {r["user_id"]: r["user_idx"] for r in indexing.index_users(df.repartition(7), n_parts=5).collect()}
    w = Window.orderBy("user_id")
    want = {
        r["user_id"]: r["i"]
        for r in df.where("user_id is not null").distinct().select("user_id", (F.row_number().over(w) - 1).alias("i")).collect()
    }
    assert got == want
    assert sorted(got.values()) == list(range(37))  # 0..n-1, gap-free, no null key


def test_index_invariant_under_partitioning(spark):
    inter = tables.interactions(spark, SF)
    a = indexing.index_items(inter.repartition(1), n_parts=3)
    b = indexing.index_items(inter.repartition(7), n_parts=11)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_index_interactions_drops_unknown(spark):
    inter = spark.createDataFrame([(1, 10, 1.0), (1, 10, 2.0), (None, 11, 1.0), (2, None, 1.0)], "user_id long, item_id long, plays double")
    users = indexing.index_users(inter)
    items = indexing.index_items(inter)
    out = indexing.index_interactions(inter, users, items).collect()
    assert sorted(tuple(r) for r in out) == [(0, 0, 1.0), (0, 0, 2.0)]


def test_metadata_left_join_keeps_unplayed(spark):
    inter = spark.createDataFrame([(1, 10, 1.0)], "user_id long, item_id long, plays double")
    meta = spark.createDataFrame([(10, "a"), (99, "never played")], "item_id long, name string")
    got = {r["item_id"]: r["item_idx"] for r in indexing.attach_item_index(meta, indexing.index_items(inter)).collect()}
    assert got == {10: 0, 99: None}


def test_hash_split_disjoint_complete_stable(spark):
    inter = tables.interactions(spark, SF)
    parts = sampling.hash_split(inter, ["user_id", "item_id"])
    n = [p.count() for p in parts]
    assert sum(n) == inter.count()
    assert parts[0].join(parts[1], ["user_id", "item_id"], "left_semi").count() == 0
    again = sampling.hash_split(inter.repartition(5), ["user_id", "item_id"])
    assert parts[0].exceptAll(again[0]).count() == 0
    assert 0.5 < n[0] / sum(n) < 0.7


def test_split_label_equals_hash_split(spark):
    inter = tables.interactions(spark, SF)
    lab = sampling.split_label(inter, ["user_id", "item_id"], (0.6, 0.2, 0.2), ("a", "b", "c"))
    parts = sampling.hash_split(inter, ["user_id", "item_id"])
    assert lab.where("split = 'b'").drop("split").exceptAll(parts[1]).count() == 0


def test_hash_sample_fraction_and_stability(spark):
    inter = tables.interactions(spark, SF)
    s1 = sampling.hash_sample(inter, 0.1, ["user_id", "item_id"])
    s2 = sampling.hash_sample(inter.repartition(3), 0.1, ["user_id", "item_id"])
    assert s1.exceptAll(s2).count() == 0
    assert 0.05 < s1.count() / inter.count() < 0.15


def test_recent_window_and_reference_branches(spark):
    inter = tables.interactions(spark, SF)
    w = sampling.recent_window(inter, 30)
    mx = inter.agg(F.max("ts")).first()[0]
    assert w.agg(F.min("ts")).first()[0] >= mx.replace(microsecond=0) - __import__("datetime").timedelta(days=30, seconds=1)
    assert sampling.reference_window(inter).count() == w.count()
    no_ts = inter.drop("ts")
    assert sampling.reference_window(no_ts, fraction=0.1).count() == sampling.hash_sample(no_ts, 0.1, no_ts.columns).count()


def test_running_totals_global_order(spark):
    df = spark.createDataFrame([(float(v), 1, v % 3) for v in range(200)], "value double, r int, c int")
    got = prefix.running_totals(df, "value", ["r", "c"], n_parts=6).orderBy("value").collect()
    cr = cc = 0
    for i, row in enumerate(got):
        cr += 1
        cc += i % 3
        assert (row["cum_r"], row["cum_c"]) == (cr, cc)
        assert row["next_key"] == (float(i + 1) if i < 199 else None)


def test_index_pair_equals_single_indexes(spark):
    inter = tables.interactions(spark, SF)
    users, items = indexing.index_pair(inter, n_parts=5)
    assert users.exceptAll(indexing.index_users(inter)).count() == 0
    assert items.exceptAll(indexing.index_items(inter)).count() == 0
    assert users.count() == inter.select("user_id").distinct().count()
    assert sorted(r[0] for r in items.select("item_idx").collect()) == list(range(items.count()))


def test_recent_window_anchors(spark):
    import datetime

    df = spark.createDataFrame(
        [(datetime.datetime(2024, 1, 1),), (datetime.datetime(2024, 1, 20),), (datetime.datetime.now() - datetime.timedelta(days=2),)],
        "ts timestamp_ntz",
    )
    assert sampling.recent_window(df, 30, as_of="now").count() == 1
    # a lower bound only (ts >= as_of - days), as in the trailing-window filter
    assert sampling.recent_window(df, 10, as_of="2024-01-25").count() == 2


def test_xxhash_split_disjoint_complete(spark):
    inter = tables.interactions(spark, SF)
    parts = sampling.hash_split(inter, ["user_id", "item_id"], method="xxhash64")
    assert sum(p.count() for p in parts) == inter.count()
    assert parts[0].join(parts[2], ["user_id", "item_id"], "left_semi").count() == 0


def test_scale_settings(spark):
    from encore.session import scale_settings

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n = scale_settings(spark, 100 * (128 << 20))
        assert n == max(100, 2 * spark.sparkContext.defaultParallelism)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_bucketed_interactions_join_without_exchange(spark):
    tables.bucket_order_tables(spark, SF, buckets=4, prefix="t_bucket_")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = tables.interactions_bucketed(spark, prefix="t_bucket_")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = tables.interactions(spark, SF)
        assert df.exceptAll(want).count() == 0 and want.exceptAll(df).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_index_pair_with_different_key_types(spark):
    df = spark.createDataFrame([("b", 10), ("a", 3), ("b", 3), (None, 7)], "user_id string, item_id long")
    users, items = indexing.index_pair(df, n_parts=2)
    assert {r["user_id"]: r["user_idx"] for r in users.collect()} == {"a": 0, "b": 1}
    assert {r["item_id"]: r["item_idx"] for r in items.collect()} == {3: 0, 7: 1, 10: 2}


def test_dictionary_broadcast_behind_size_check(spark):
    inter = tables.interactions(spark, SF)
    users, items = indexing.index_pair(inter)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = indexing.index_interactions(inter, users, items)
        plan = small._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") >= 2  # both dictionaries are under the limit
        big = indexing.index_interactions(inter, users, items, broadcast_limit=0)
        plan = big._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan  # over the limit: shuffled join
        assert small.exceptAll(big).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
