"""Toxicity: held-out accuracy, noisy-or, sentences, edge rows."""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from encore.llm import toxicity as tox
from encore.llm.common import joined
from encore.llm.labelled import training_sample

SF = "/root/testdata/sf0.1"


def planted(n, seed=3):
    rng = np.random.default_rng(seed)
    words = ["the", "wind", "over", "hills", "runs", "green", "river", "stone", "light", "and"]
    bad = ["grumble", "grumbling", "snarf"]
    texts, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choice(words, 6)) for _ in range(rng.integers(1, 8))]
        toxic = i % 4 == 0
        if toxic:
            k = rng.integers(len(sentences))
            sentences[k] += " " + str(rng.choice(bad))
        texts.append(". ".join(sentences) + ".")
        labels.append(int(toxic))
    return texts, np.array(labels)


def scores(texts, model):
    return tox.score_bodies(*joined(pa.array([t.encode() for t in texts], pa.binary())), model)[0]


def test_held_out_accuracy_on_given_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = tox.fit_toxicity(docs, labels, ~tox.is_held_out())
    got = tox.score_toxicity(docs, model).join(labels, "doc_id").where(tox.is_held_out()).select("toxic", (F.col("score") >= 0.3).alias("p")).toPandas()
    y, p = got["toxic"] == 1, got["p"]
    assert (p & y).sum() / y.sum() > 0.85 and (p & ~y).sum() / (~y).sum() < 0.03


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(0).alias("quality"), F.lit(1).alias("toxic"))
    used = {r["doc_id"] for r in training_sample(docs, labels, "toxic", ~tox.is_held_out(), 1000, 10**6).collect()}
    held = {r["doc_id"] for r in docs.where(tox.is_held_out()).collect()}
    assert held and not used & held and len(used | held) == 200
    few = training_sample(docs, labels, "toxic", F.lit(True), 7, 10**6).count()
    assert few == 7


def test_fit_finds_sentences_from_document_labels(spark):
    texts, labels = planted(400)
    model = tox.fit([t.encode() for t in texts], labels)
    fresh, truth = planted(200, seed=9)
    assert ((scores(fresh, model) >= 0.3) == (truth == 1)).all()
    found = tox.toxic_sentences(spark.createDataFrame([(1, "Über hills. the SNARF, and light. Green river."), (2, "stone")], "doc_id long, text string"), model).collect()
    assert [("Über hills. the SNARF, and light. Green river."[r["start"] : r["end"]]) for r in found] == ["the SNARF, and light"]


def test_noisy_or_is_the_product_rule():
    z, doc = np.array([-2.0, 0.5, -1.0]), np.array([0, 0, 2])
    p = 1 / (1 + np.exp(-z))
    assert np.allclose(tox.noisy_or(z, doc, 3), [1 - (1 - p[0]) * (1 - p[1]), 0, p[2]])
    assert np.allclose(tox.noisy_or(z, doc, 3, floor=0.2), [p[1], 0, p[2]])


def test_long_texts_of_documents_that_are_clean_by_themselves():
    """20 texts of 300 KB joined from held-out clean documents that score under 0.3 each."""
    docs = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    label = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    known = [(r["text"] or "", label[r["doc_id"]], zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in docs if r["doc_id"] in label]
    model = tox.fit([t.encode() for t, _, held in known if not held], np.array([y for _, y, held in known if not held]))
    clean = [t for t, y, held in known if held and not y]
    clean = [t for t, s in zip(clean, scores(clean, model)) if s < 0.3]
    rng, long = np.random.default_rng(0), []
    for _ in range(20):
        order = [clean[i] for i in rng.permutation(len(clean))]
        size = np.cumsum([len(t) for t in order])
        long.append("\n".join(order[: int(np.searchsorted(size, 300_000)) + 1]))
    assert all(len(t) > 290_000 for t in long) and (scores(long, model) >= 0.3).sum() <= 1


def test_edge_rows(spark):
    texts, labels = planted(200)
    model = tox.fit([t.encode() for t in texts], labels)
    rows = [(None, "grumble."), (1, None), (1, None), (2, ""), (3, " \n.!"), (4, "wind " * 100_000 + "snarf"), (5, "w" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("body", "score", "label", "cell")})
    got = sorted(((r["doc_id"], r["score"] >= 0.3) for r in tox.score_toxicity(docs, model).collect()), key=str)
    assert got == sorted([(None, True), (1, False), (1, False), (2, False), (3, False), (4, True), (5, False)], key=str)
    assert tox.score_toxicity(docs.limit(0), model).collect() == []
    assert (scores(["x", ""], tox.fit([], np.array([]))) < 0.01).all()


def test_length_alone_does_not_make_a_text_toxic(spark):
    texts, labels = planted(400)
    model = tox.fit([t.encode() for t in texts], labels)
    rng = np.random.default_rng(4)
    words = "the wind over hills runs green river stone light and".split()
    clean = [" ".join(rng.choice(words, 6)) for _ in range(20_000)]
    toxic = [*clean[:12_345], "the SNARF and light", *clean[12_345:]]
    long = [". ".join(s) for s in (clean, toxic)]
    assert (scores(long, model) >= 0.3).tolist() == [False, True]
    # at the bias a fit starts from, and with a text above any bound of the fit
    start = tox.ToxicityModel(np.zeros(1 << tox.BITS, np.float32), -9.0)
    assert scores([long[0], ". ".join(clean * 10)], start).max() < 1e-6
    docs = spark.createDataFrame([(1, long[0]), (2, long[1])], "doc_id long, text string")
    assert [r["doc_id"] for r in tox.drop_toxic(docs, model).collect()] == [1]
    found = tox.toxic_sentences(docs, model).collect()
    assert [(r["doc_id"], long[1][r["start"] : r["end"]]) for r in found] == [(2, "the SNARF and light")]


def test_sample_bounds_rows_and_bytes(spark):
    """A third of all rows has one id; absent texts take no place; long texts come whole."""
    rows = [(7, f"copy {i % 5}") for i in range(150)] + [(i, f"text {i}") for i in range(100, 250)] + [(i, "long " * 100) for i in range(300, 450)] + [(500, "x" * 90_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("toxic")).union(spark.range(1000, 1400).select("id", F.lit(0)))

    def sample(most_rows, most_bytes, table=docs):
        return [(r["doc_id"], bytes(r["body"]).decode()) for r in training_sample(table, labels, "toxic", F.lit(True), most_rows, most_bytes).collect()]

    every = sample(1000, 10**6)
    assert sorted(i for i, _ in every) == [7, *range(100, 250), *range(300, 450), 500] and set(every) <= set(rows)
    few = sample(120, 10**6)
    assert len(few) == len({i for i, _ in few}) == 120
    # the first ids in hash order, as many as fit; a text above the bound by itself is passed over
    some = sample(1000, 20_000)
    assert 15_000 < sum(len(t) for _, t in some) <= 20_000 and 500 not in {i for i, _ in some} and {len(t) for _, t in some} > {500}
    assert set(some) < set(every) and set(sample(1000, 10**6, docs.repartition(7))) == set(every)
