"""Mixing: targets, epochs, closeness, skew, edge rows, reruns."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from encore.llm import mix
from tests.conftest import SF


def water_fill(sizes, weights=(5, 2, 1), most=3.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    open_, left = set(names), float(sum(sizes.values()))
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > most * sizes[s]}
        for s in over or open_:
            target[s] = most * sizes[s] if over else left * w[s] / total
        if not over:
            break
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def check(rows, n_docs):
    assert len(rows) == n_docs
    sizes, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    want = water_fill(sizes)
    for s, size in sizes.items():
        mine = [r for r in rows if r["source"] == s]
        assert all(r["source_size"] == size and abs(r["target"] - want[s]) < 1e-6 * max(1, want[s]) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= largest[s] / 2 + 1
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in mine)
        epochs = int(want[s] // size) if size else 0
        assert all(r["taken"] in (epochs * r["size"], (epochs + 1) * r["size"]) for r in mine)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mix.mix(docs).collect()
    check(rows, docs.count())
    again = mix.mix(docs.repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in rows) == sorted((r["doc_id"], r["taken"]) for r in again)


@pytest.mark.parametrize("cell", [2000, 5])
def test_hot_source_nulls_and_odd_rows(spark, monkeypatch, cell):
    monkeypatch.setattr(mix, "CELL", cell)
    rows = [(i, "w " * (i % 7 + 1), "hot" if i % 3 else f"s{i % 11}") for i in range(400)]
    rows += [(900 + i, "word " * 50, None) for i in range(5)] + [(None, "a b", "s1"), (None, None, "s1"), (7, "dup dup", "Z"), (7, "dup dup", "Z"), (8, "", "empty"), (9, None, "empty"), (10, "x " * 50_000, "é"), (11, "x", "é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("x") for c in ("size", "n", "key", "cell", "place", "row", "target", "w", "rest", "quality", "copies")})
    got = mix.mix(docs).collect()
    check(got, len(rows))
    out = mix.mixed(docs)
    assert out.columns == docs.columns
    count = defaultdict(int)
    for r in out.collect():
        count[r["doc_id"], r["text"], r["source"]] += 1
    assert sum(count.values()) == sum(1 if g["size"] == 0 else g["copies"] for g in got)
    assert set(count) <= {(d, t, s) for d, t, s in rows}


def test_cell_of_one_repeated_id_is_sorted_in_ranges(spark, monkeypatch):
    """A third of a source's rows share one id (and so one key), more than a cell holds; the budget ends among them."""
    monkeypatch.setattr(mix, "CELL", 10)
    rows = [(7, "w w", "a")] * 900 + [(i, "w w w", "a") for i in range(100, 160)] + [(None, "x", "a")] * 300 + [(1000 + i, "w " * 30, "b") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mix.mix(docs, weights=(1, 4)).collect()
    mine = [r for r in got if r["source"] == "a"]
    assert len(got) == len(rows) and abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 2.5
    assert len({r["place"] for r in got}) == len(rows)


def test_quality_weights_draw_more(spark):
    rows = [(i, "word " * 10, "a", 1.0 if i % 2 else 0.2) for i in range(4000)] + [(10_000 + i, "word " * 10, "b", 1.0) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, q double")
    got = mix.mix(docs, quality=F.col("q"), weights=(1, 2)).where("source = 'a'").groupBy("quality").agg(F.sum("copies").alias("c")).collect()
    taken = {r["quality"]: r["c"] for r in got}
    assert taken[1.0] > 1.5 * taken[0.2] > 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix.mix(docs).collect() == [] and mix.mixed(docs).collect() == []


def test_mixed_when_the_table_is_split_anew_between_jobs(spark, tmp_dir):
    """More cores between two jobs change the splits, and with them row numbers."""
    rows = [(i, "w " * (i % 7 + 1), f"s{i % 3}") for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(16, "doc_id").write.parquet(f"{tmp_dir}/docs")
    docs, cores = spark.read.parquet(f"{tmp_dir}/docs"), "spark.sql.files.minPartitionNum"
    want = {r["doc_id"]: r["copies"] for r in mix.mix(docs).collect() if r["copies"]}
    try:
        spark.conf.set(cores, "1")
        out = mix.mixed(docs)
        spark.conf.set(cores, "1000")
        count = defaultdict(int)
        for r in out.collect():
            count[r["doc_id"]] += 1
    finally:
        spark.conf.unset(cores)
    assert count == want
