"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each query reads the given tables (or data Spark derives from them) whole.
Output columns are aliased to the names used by the DuckDB oracle in
``encore.plans.oracle``; counts are bigint, indexes int, doubles rounded to
six places so both engines print the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore import schemas
from encore.operators import als, drift, events, factorize, history, indexing, ranking, runs, sampling, topk
from encore.plans import evaluate, train
from encore.plans.prepare import SPLIT_KEYS, prepare_tables, write_reference
from encore.session import scratch_path
from encore.sources import files, sinks, tables
from encore.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the mapping to the given tables (FIXTURES.md section 2):
# drift reference = play events before the cutoff, current = the rest;
# embedding rows whose id the share divides are users, the others items; K of the
# evaluation and of top-K reports; sample share; trailing window in days.
DRIFT_CUTOFF = "2024-01-15"
EVAL_K = 10
TOPK_K = 10
EMBEDDING_USERS_EACH = 10
SAMPLE_FRACTION = 0.1
WINDOW_DAYS = 30
REFERENCE_DAY = "1997-01-01"
# regularisation, alpha and rounds of the fits of rank two, which SQL can follow
SMALL_FIT = (0.01, 40.0, 3)
# files the event table is dealt into for streams of several micro-batches
STREAM_FILES = 3


def r6(name: str) -> Column:
    """Column rounded to six places, keeping its name."""
    return F.round(F.col(name).cast("double"), 6).alias(name)


# ---------------------------------------------------------------- shared views
def _interactions(spark: SparkSession, sf: str) -> DataFrame:
    return tables.interactions(spark, sf)


def _plays(spark: SparkSession, sf: str) -> DataFrame:
    return tables.play_events(spark, sf)


def _drift_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    p = _plays(spark, sf)
    cut = F.lit(DRIFT_CUTOFF).cast("timestamp_ntz")
    return p.where(F.col("ts") < cut), p.where(F.col("ts") >= cut)


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    return events.classify(tables.raw_event_values(spark, sf), tables.PLAY_EVENT_TYPE)


def _embedding_topk(spark: SparkSession, sf: str) -> DataFrame:
    emb = tables.table(spark, sf, "embeddings")
    users = emb.where(F.col("vec_id") % EMBEDDING_USERS_EACH == 0)
    items = emb.where(F.col("vec_id") % EMBEDDING_USERS_EACH != 0)
    return topk.pruned_topk(users, items, TOPK_K, id_col="vec_id", vec_col="embedding")


# ---------------------------------------------------------------- scans, prep
def q_scan_interactions(spark, sf):
    return _interactions(spark, sf)


def q_index_users(spark, sf):
    return indexing.index_users(_interactions(spark, sf))


def q_index_items(spark, sf):
    return indexing.index_items(_interactions(spark, sf))


def q_index_interactions(spark, sf):
    # the join of the two tables is written once and read by both steps
    return prepare_tables(spark, sf, once=True).indexed


def _split(i: int) -> Query:
    def q(spark, sf):
        return sampling.hash_split(_interactions(spark, sf), SPLIT_KEYS)[i]

    return q


def q_hash_sample(spark, sf):
    return sampling.hash_sample(_interactions(spark, sf), SAMPLE_FRACTION, SPLIT_KEYS)


def q_bernoulli_sample(spark, sf):
    return sampling.bernoulli_sample(_interactions(spark, sf), SAMPLE_FRACTION)


def q_random_split_train(spark, sf):
    return sampling.random_split(_interactions(spark, sf))[0]


def q_recent_window(spark, sf):
    # the join of the two tables is evaluated once: the newest time and the rows come from the written table
    path = scratch_path(spark, "recent")
    sinks.write_overwrite(_interactions(spark, sf), path)
    written = spark.read.parquet(path)
    return sampling.recent_window(written, WINDOW_DAYS, written.select(F.max("ts")).scalar())


def q_reference_window(spark, sf):
    # indexed interactions carry no time column: the stable-sample branch
    return sampling.reference_window(prepare_tables(spark, sf, once=True).indexed, WINDOW_DAYS, SAMPLE_FRACTION)


def q_reference_recent(spark, sf):
    # the branch of tables with a time column, up to a given day, as a job
    ref = write_reference(_interactions(spark, sf), scratch_path(spark, "reference"), days=WINDOW_DAYS, as_of=REFERENCE_DAY)
    return ref


def q_reference_all(spark, sf):
    return write_reference(_interactions(spark, sf), scratch_path(spark, "reference"), recent=False)


def q_index_item_mapping(spark, sf):
    inter = _interactions(spark, sf)
    return indexing.attach_item_index(tables.item_tracks(spark, sf), indexing.index_items(inter))


def q_index_metadata(spark, sf):
    inter = _interactions(spark, sf)
    return indexing.attach_item_index(tables.item_metadata(spark, sf), indexing.index_items(inter))


# ---------------------------------------------------------------- events
def q_filter_plays(spark, sf):
    return events.filter_plays(tables.events(spark, sf), tables.PLAY_EVENT_TYPE).select(
        "user_id", tables.event_item().alias("item_id"), F.col("value").alias("plays"), "ts"
    )


def q_parse_events(spark, sf):
    return events.kept_events(_classified(spark, sf), keep=("event_id",))


def q_quarantine_events(spark, sf):
    return events.quarantined(_classified(spark, sf), keep=("event_id",))


def q_cast_interactions(spark, sf):
    good = events.kept_events(_classified(spark, sf), keep=("event_id",))
    return events.cast_interactions(good, keep=("event_id",))


def q_to_kafka_records(spark, sf):
    return sinks.to_kafka_records(_plays(spark, sf))


def q_daily_partition_counts(spark, sf):
    return sinks.daily_partition_counts(_plays(spark, sf))


def q_latest_batch(spark, sf):
    return files.latest_partition(sinks.with_event_date(_plays(spark, sf)), "dt").drop("dt")


def q_latest_model_version(spark, sf):
    """Two trainings (the popularity runs on validation, then on test), the best of each published; which is the newest."""
    p = prepare_tables(spark, sf)
    root = scratch_path(spark, "published")
    for name, truth in (("first", p.validation), ("second", p.test)):
        table = evaluate.popularity_runs(p.train, truth)
        table = table.withColumns({"training": F.lit(name), "path": F.concat(F.lit(f"models/training={name}/run="), F.col("run_id"))})
        missing = {f.name: F.lit(None).cast(f.dataType) for f in schemas.RUNS.fields if f.name not in table.columns}
        sinks.append_runs(table.withColumns(missing).select(*[F.col(f.name).cast(f.dataType) for f in schemas.RUNS.fields]), f"{root}/runs")
        train.publish(spark, root, runs.best_run(train.run_log(spark, root).where(F.col("training") == name)))
    newest = train.latest_published(spark, root).select(F.col("version").alias("newest"))
    log = train.run_log(spark, root).where(F.col("version").isNotNull())
    # one row: the newest version
    marked = log.join(F.broadcast(newest), F.col("version") == F.col("newest"), "left")
    return marked.select("version", "training", "run_id", "k", r6("map"), "path", F.col("newest").isNotNull().alias("is_newest"))


def q_daily_plays(spark, sf):
    p = _plays(spark, sf)
    w = F.window("ts", "1 day")  # on timestamp_ntz: wall-clock days in any session zone
    return (
        p.groupBy(w.alias("w"))
        .agg(F.count(F.lit(1)).cast("bigint").alias("n_events"), F.round(F.sum("plays"), 6).alias("plays"))
        .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "n_events", "plays")
    )


# ---------------------------------------------------------------- histories
def q_distinct_users(spark, sf):
    return history.distinct_values(_interactions(spark, sf), "user_id")


def q_distinct_items(spark, sf):
    return history.distinct_values(_interactions(spark, sf), "item_id")


def q_user_item_plays(spark, sf):
    agg = history.user_item_plays(_interactions(spark, sf))
    return agg.select("user_id", "item_id", r6("plays"), F.col("n_events").cast("bigint"))


def q_ground_truth_lists(spark, sf):
    return history.ground_truth_lists(prepare_tables(spark, sf, once=True).validation)


def q_user_history(spark, sf):
    return history.user_history(prepare_tables(spark, sf, once=True).train)


def q_user_history_all(spark, sf):
    p = prepare_tables(spark, sf)
    return history.user_history_all(p.users, history.user_history(p.train))


def q_unseen_items(spark, sf):
    p = prepare_tables(spark, sf)
    users = p.validation.select("user_idx").distinct()
    cands = evaluate.popularity_predictions(p.train, users, EVAL_K)
    return history.unseen_items(cands, p.train)


def q_user_history_bitmaps(spark, sf):
    b = history.history_bitmaps(prepare_tables(spark, sf, once=True).train)
    return b.select("user_idx", F.col("bucket").cast("bigint"), F.bitmap_count("items").alias("n_items"))


def q_unseen_by_bitmaps(spark, sf):
    p = prepare_tables(spark, sf)
    users = p.validation.select("user_idx").distinct()
    cands = evaluate.popularity_predictions(p.train, users, EVAL_K)
    return history.unseen_by_bitmaps(cands, history.history_bitmaps(p.train))


def q_union_history(spark, sf):
    train = sampling.hash_split(_interactions(spark, sf), SPLIT_KEYS)[0]
    return history.union_history(train, _plays(spark, sf))


# ---------------------------------------------------------------- ranking
def _per_user_out(df: DataFrame) -> DataFrame:
    return df.select(
        "user_idx",
        F.col("n_pred").cast("bigint").alias("n_pred"),
        F.col("n_truth").cast("bigint").alias("n_truth"),
        F.col("hits_at_k").cast("bigint").alias("hits_at_k"),
        *[r6(m) for m in ranking.METRICS],
    )


def q_ranking_metrics_per_user(spark, sf):
    p = prepare_tables(spark, sf)
    return _per_user_out(evaluate.popularity_per_user(p.train, p.validation, EVAL_K))


def q_ranking_metrics(spark, sf):
    p = prepare_tables(spark, sf)
    m = ranking.mean_metrics(evaluate.popularity_per_user(p.train, p.validation, EVAL_K))
    return m.select(F.col("users_scored").cast("bigint"), *[r6(x) for x in ranking.METRICS])


def q_best_run(spark, sf):
    p = prepare_tables(spark, sf)
    best = runs.best_run(evaluate.popularity_runs(p.train, p.validation), "map")
    return best.select("run_id", "k", F.col("users_scored").cast("bigint"), r6("map"), r6("precision_at_k"))


def q_topk_for_users(spark, sf):
    t = _embedding_topk(spark, sf)
    return t.select("user_id", "item_id", r6("score"), F.col("rank").cast("int"))


def q_recommendation_ranks(spark, sf):
    recs = topk.as_recommendation_lists(_embedding_topk(spark, sf))
    return topk.recommendation_ranks(recs).select("user_id", "rank", "item_id", r6("score"))


def q_recommendation_ids(spark, sf):
    return topk.recommendation_ids(topk.as_recommendation_lists(_embedding_topk(spark, sf)))


# ---------------------------------------------------------------- ALS (rows)
def q_als_user_factors(spark, sf):
    p = prepare_tables(spark, sf)
    return factorize.factorize(p.train, 32, 0.01, 40.0).users


def q_als_topk(spark, sf):
    p = prepare_tables(spark, sf)
    return factorize.recommend(factorize.factorize(p.train, 32, 0.01, 40.0), TOPK_K)


def _two(df: DataFrame, kind: str) -> DataFrame:
    """Vectors of rank two as columns."""
    return df.select(F.lit(kind).alias("kind"), "id", *[F.round(F.col("features")[i], 6).alias(f"f{i}") for i in range(2)])


def q_als_rank_two(spark, sf):
    p = prepare_tables(spark, sf)
    model = factorize.factorize(p.train, 2, *SMALL_FIT)
    return _two(model.users, "user").union(_two(model.items, "item"))


def q_als_fold_in(spark, sf):
    # validation users as new ones, against the items of the fit on train
    p = prepare_tables(spark, sf)
    return _two(factorize.fold_in(p.validation, factorize.factorize(p.train, 2, *SMALL_FIT)), "new")


def q_als_warm_refit(spark, sf):
    # one more round over train and validation, from the vectors of the fit on train
    p = prepare_tables(spark, sf)
    model = factorize.refit(factorize.factorize(p.train, 2, *SMALL_FIT), p.train, p.validation, 1)
    return _two(model.users, "user").union(_two(model.items, "item"))


def q_grid_runs(spark, sf):
    p = prepare_tables(spark, sf)
    table, _ = als.grid_search(p.train, p.validation)
    return table


def q_als_refresh(spark, sf):
    p = prepare_tables(spark, sf)
    # hyper-parameters of the best run of the full selection grid
    table, _ = als.grid_search(p.train, p.validation)
    best = runs.best_run(table).first().asDict()
    new = p.validation  # held-out interactions arrive as the new batch
    model = als.refresh(p.train, new, best, mode="union")
    return als.user_factors(model)


# ---------------------------------------------------------------- drift
def q_drift_ks_plays(spark, sf):
    ref, cur = _drift_sides(spark, sf)
    s = drift.ecdf_stats(ref, cur, "plays")
    return s.select("n_ref", "n_cur", r6("ks"), r6("ks_p_value"))


def q_drift_wasserstein_plays(spark, sf):
    ref, cur = _drift_sides(spark, sf)
    s = drift.ecdf_stats(ref, cur, "plays")
    return s.select(r6("wasserstein"), r6("std_ref"), r6("wasserstein_norm"))


def _js(col: str) -> Query:
    def q(spark, sf):
        ref, cur = _drift_sides(spark, sf)
        return drift.js_distance(ref, cur, col).select(F.col("n_categories").cast("bigint"), r6("js"))

    return q


def q_drift_chisquare_item(spark, sf):
    ref, cur = _drift_sides(spark, sf)
    s = drift.chi_square(ref, cur, "item_id")
    return s.select(F.col("n_categories").cast("bigint"), r6("chi2"), "dof", r6("p_value"))


def q_drift_report(spark, sf):
    ref, cur = _drift_sides(spark, sf)
    rep = drift.drift_report(ref, cur, ["plays"], ["user_id", "item_id"])
    return rep.select("column", "method", r6("score"), "threshold", "drifted")


def q_drift_report_small(spark, sf):
    ref, cur = _drift_sides(spark, sf)
    rep = drift.drift_report(ref, cur, ["plays"], ["user_id", "item_id"], size="small")
    return rep.select("column", "method", r6("score"), "threshold", "drifted")


def q_drift_dataset(spark, sf):
    ref, cur = _drift_sides(spark, sf)
    d = drift.dataset_drift(drift.drift_report(ref, cur, ["plays"], ["user_id", "item_id"]))
    return d.select(F.col("n_columns").cast("bigint"), "n_drifted", r6("share"), "threshold", "drifted")


def q_drift_report_merged(spark, sf):
    # both sides counted day by day, as batches would be, then merged: no row is read twice
    ref, cur = _drift_sides(spark, sf)
    columns = (["plays"], ["user_id", "item_id"])
    daily = [drift.value_counts(side.withColumn("dt", F.to_date("ts")), *columns, by=["dt"]) for side in (ref, cur)]
    rep = drift.report_from_counts(drift.paired_counts(*[drift.merged_counts(d) for d in daily]), *columns)
    return rep.select("column", "method", r6("score"), "threshold", "drifted")


def q_column_profile(spark, sf):
    # profiles of each day, merged; the sketches' quantiles are approximate, the rest is exact
    daily = drift.numeric_profile(_plays(spark, sf).withColumn("dt", F.to_date("ts")), ["plays", "user_id", "item_id"], by=["dt"])
    return drift.merged_profile(daily).select("column", F.col("n").cast("bigint"), F.col("n_null").cast("bigint"), r6("low"), r6("high"))


# ---------------------------------------------------------------- streaming
def _run_stream(spark: SparkSession, sf: str) -> tuple[str, str]:
    root = scratch_path(spark, "stream")
    raw = tables.event_messages(tables.event_stream(spark, sf))
    q = ingest.ingest_plays(
        raw, f"{root}/plays", f"{root}/quarantine", f"{root}/_checkpoint", tables.PLAY_EVENT_TYPE, keep=("event_id",)
    )
    ingest.run_to_end(q)
    return f"{root}/plays", f"{root}/quarantine"


def q_stream_plays(spark, sf):
    good, _ = _run_stream(spark, sf)
    return spark.read.parquet(good).select("event_id", "user_id", "item_id", "plays", "ts", "event_type")


def q_stream_daily(spark, sf):
    good, _ = _run_stream(spark, sf)
    return (
        spark.read.parquet(good)
        .groupBy("dt")
        .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
        .select(F.date_format("dt", "yyyy-MM-dd").alias("dt"), "n_rows")
    )


def _event_files(spark: SparkSession, df: DataFrame, copies: int = 1) -> DataFrame:
    """``df`` dealt into files by row hash and read as a stream, one file a
    micro-batch, ``copies`` times over. Each file has events of all days, so
    later files bring late ones."""
    root = scratch_path(spark, "event-files")
    for i in range(copies):
        df.repartition(STREAM_FILES, F.xxhash64(*[c for c in df.columns])).write.parquet(f"{root}/copy={i}")
    reader = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
    return reader.parquet(root)


def q_stream_daily_plays(spark, sf):
    root = scratch_path(spark, "stream-daily-plays")
    stream = _event_files(spark, _plays(spark, sf))
    ingest.run_to_end(ingest.write_daily_plays(stream, f"{root}/daily", f"{root}/_checkpoint", compact_every=2))
    return spark.read.parquet(f"{root}/daily").select(
        F.col("day").cast("string").alias("day"), F.col("n_events").cast("bigint"), r6("plays")
    )


def q_stream_resent(spark, sf):
    # every message arrives a second time, in later files; compacted on the way
    root = scratch_path(spark, "stream-resent")
    raw = _event_files(spark, tables.raw_event_values(spark, sf), copies=2)
    ingest.run_to_end(ingest.ingest_plays(
        raw, f"{root}/plays", f"{root}/quarantine", f"{root}/_checkpoint", tables.PLAY_EVENT_TYPE, keep=("event_id",), dedupe_on="event_id", compact_every=3
    ))
    return ingest.read_plays(spark, f"{root}/plays").select("event_id", "user_id", "item_id", "plays", "ts", "event_type")


QUERIES: dict[str, Query] = {
    "scan_interactions": q_scan_interactions,
    "index_users": q_index_users,
    "index_items": q_index_items,
    "index_interactions": q_index_interactions,
    "split_train": _split(0),
    "split_validation": _split(1),
    "split_test": _split(2),
    "hash_sample": q_hash_sample,
    "recent_window": q_recent_window,
    "bernoulli_sample": q_bernoulli_sample,
    "random_split_train": q_random_split_train,
    "reference_window": q_reference_window,
    "reference_recent": q_reference_recent,
    "reference_all": q_reference_all,
    "index_item_mapping": q_index_item_mapping,
    "index_metadata": q_index_metadata,
    "filter_plays": q_filter_plays,
    "parse_events": q_parse_events,
    "quarantine_events": q_quarantine_events,
    "cast_interactions": q_cast_interactions,
    "to_kafka_records": q_to_kafka_records,
    "daily_partition_counts": q_daily_partition_counts,
    "latest_batch": q_latest_batch,
    "latest_model_version": q_latest_model_version,
    "daily_plays": q_daily_plays,
    "distinct_users": q_distinct_users,
    "distinct_items": q_distinct_items,
    "user_item_plays": q_user_item_plays,
    "ground_truth_lists": q_ground_truth_lists,
    "user_history": q_user_history,
    "user_history_all": q_user_history_all,
    "unseen_items": q_unseen_items,
    "user_history_bitmaps": q_user_history_bitmaps,
    "unseen_by_bitmaps": q_unseen_by_bitmaps,
    "union_history": q_union_history,
    "ranking_metrics_per_user": q_ranking_metrics_per_user,
    "ranking_metrics": q_ranking_metrics,
    "best_run": q_best_run,
    "topk_for_users": q_topk_for_users,
    "recommendation_ranks": q_recommendation_ranks,
    "recommendation_ids": q_recommendation_ids,
    "drift_ks_plays": q_drift_ks_plays,
    "drift_wasserstein_plays": q_drift_wasserstein_plays,
    "drift_js_user": _js("user_id"),
    "drift_js_item": _js("item_id"),
    "drift_chisquare_item": q_drift_chisquare_item,
    "drift_report": q_drift_report,
    "drift_report_small": q_drift_report_small,
    "drift_dataset": q_drift_dataset,
    "drift_report_merged": q_drift_report_merged,
    "column_profile": q_column_profile,
    "stream_plays": q_stream_plays,
    "stream_daily": q_stream_daily,
    "stream_daily_plays": q_stream_daily_plays,
    "stream_resent": q_stream_resent,
    "als_user_factors": q_als_user_factors,
    "als_topk": q_als_topk,
    "als_rank_two": q_als_rank_two,
    "als_fold_in": q_als_fold_in,
    "als_warm_refit": q_als_warm_refit,
    "grid_runs": q_grid_runs,
    "als_refresh": q_als_refresh,
}
