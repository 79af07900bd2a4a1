"""A user with a third of all rows: nothing dropped, no oversized list."""

import math

from pyspark.sql import functions as F

from encore.operators import history, indexing, ranking


def hot_frame(spark):
    hot = spark.range(25_000).select(F.lit(7).alias("user_idx"), F.col("id").cast("int").alias("item_idx"), F.lit(1.0).alias("plays"))
    rest = spark.range(50_000).select(
        (F.col("id") % 1000 + 100).cast("int").alias("user_idx"), (F.col("id") % 997).cast("int").alias("item_idx"), F.lit(2.0).alias("plays")
    )
    return hot.unionByName(rest)


def test_hot_user_history_is_chunked_and_whole(spark):
    df = hot_frame(spark)
    h = history.user_history(df, chunk_size=10_000)
    hot = h.where("user_idx = 7").collect()
    assert len(hot) == math.ceil(25_000 / 10_000)
    assert max(len(r["items"]) for r in hot) < 12_000  # bounded lists
    assert sorted(x for r in hot for x in r["items"]) == list(range(25_000))  # whole
    assert h.where("user_idx != 7").agg(F.max("chunk")).first()[0] == 0


def test_hot_user_chunks_are_built_in_many_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        h = history.user_history(hot_frame(spark), chunk_size=1000).where("user_idx = 7")
        assert h.withColumn("task", F.spark_partition_id()).select("task").distinct().count() > 1
        assert h.agg(F.max(F.size("items"))).first()[0] < 1500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_equal_rows_spread_over_chunks(spark):
    same = spark.range(5000).select(F.lit(1).alias("user_idx"), F.lit(3).alias("item_idx"), F.lit(1.0).alias("plays"))
    lists = history.ground_truth_lists(same, chunk_size=100).collect()
    assert len(lists) == 50 and max(len(r["true_items"]) for r in lists) < 200
    assert sum(len(r["true_items"]) for r in lists) == 5000


def test_hot_user_metrics_and_sums(spark):
    df = hot_frame(spark)
    preds = spark.range(10).select(F.lit(7).alias("user_idx"), (F.col("id") + 1).cast("int").alias("rank"), (F.col("id") * 3).cast("int").alias("item_idx"))
    r = ranking.per_user_metrics(preds, df, 10).first()
    assert r["n_truth"] == 25_000 and r["hits_at_k"] == 10 and r["precision_at_k"] == 1.0
    sums = history.user_item_plays(df, "user_idx", "item_idx")
    assert sums.where("user_idx = 7").count() == 25_000
    assert sums.agg(F.sum("n_events")).first()[0] == 75_000


def test_hot_user_index(spark):
    df = hot_frame(spark).select(F.col("user_idx").alias("user_id"), F.col("item_idx").alias("item_id"), "plays")
    users, items = indexing.index_pair(df, n_parts=6)
    assert users.count() == 1001 and items.count() == 25_000
    joined = indexing.index_interactions(df, users, items)
    assert joined.count() == 75_000


def test_bitmaps_bound_the_rows_of_a_hot_user(spark):
    """A user with a third of all plays: one row for each 32,768 items, whatever the plays; same sets and differences."""
    from encore.operators import history

    hot = [(0, i * 13) for i in range(20_000)] * 2
    rows = hot + [(1 + i % 500, (i * 7919) % 300_000) for i in range(20_000)] + [(7, None), (8, 0), (8, 32767), (8, 32768)]
    df = spark.createDataFrame(rows, "user_idx int, item_idx int").repartition(6)
    maps = history.history_bitmaps(df)
    sizes = {(r["user_idx"], r["bucket"]): r["n"] for r in maps.select("user_idx", "bucket", F.bitmap_count("items").alias("n")).collect()}
    want = {}
    for u, i in {r for r in rows if r[1] is not None}:
        want[u, 1 + i // 32768] = want.get((u, 1 + i // 32768), 0) + 1
    assert sizes == want and sum(u == 0 for u, _ in sizes) == 8
    cands = spark.createDataFrame([(u, i, "x") for u in (0, 1, 7, 8, 9999) for i in (0, 13, 32767, 32768, 7919, 299_999)], "user_idx int, item_idx int, extra string")
    key = lambda d: sorted(map(tuple, d.collect()))
    assert key(history.unseen_by_bitmaps(cands, maps)) == key(history.unseen_items(cands, df)) != key(cands)
    halves = [df.where("item_idx % 2 = 0"), df.where("item_idx % 2 = 1")]
    merged = history.merged_bitmaps(*[history.history_bitmaps(h) for h in halves])
    assert merged.exceptAll(maps).count() == 0 and maps.exceptAll(merged).count() == 0


def test_estimated_bytes_measures_text(spark):
    from encore.operators import indexing

    wide = spark.createDataFrame([("x" * 1000, 1), (None, 2)], "user_id string, user_idx int")
    assert indexing.estimated_bytes(wide) == 1000 + 2 * (4 + 16)
    assert indexing.estimated_bytes(wide.limit(0)) == 0


def test_bitmaps_are_neither_shuffled_nor_sorted(spark):
    """A bitmap is 4 KB however few items it holds: rows are dealt out as single bits, a sparse user's too."""
    from encore.operators import history

    df = spark.createDataFrame([(u, (u * 7919 + j * 40_000) % 400_000) for u in range(300) for j in range(9)], "user_idx int, item_idx int")
    plan = history.history_bitmaps(df)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.rindex("partial_bitmap_construct_agg")]
    assert "Exchange" not in above and "Sort [" not in above
    # the candidates' side moves to the bitmaps, which are not taken for small
    cands = df.where("user_idx < 3")
    assert "BroadcastHashJoin" not in history.unseen_by_bitmaps(cands, history.history_bitmaps(df))._jdf.queryExecution().executedPlan().toString()
