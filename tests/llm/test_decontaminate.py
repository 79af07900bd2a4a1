"""Containment search: brute force, exact recall bound, edge rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from encore.llm import decontaminate as dec
from encore.llm.common import joined
from encore.llm.words import SPACED, words
from tests.conftest import SF


def shingles(text, size=5):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(docs, items, share=0.8):
    best = {}
    wanted = [(i, shingles(t)) for i, t in items]
    for d, t in docs:
        w = (t or "").encode().lower().split()
        have = shingles(t) | {b" ".join(w[i : i + k]) for k in (3, 4) for i in range(len(w) - k + 1)}
        for i, s in wanted:
            n = len(s & have)
            if s and n >= share * len(s) - 1e-9:
                best[d, i] = max(best.get((d, i), (0,)), (n / len(s), len(s), n))
    return sorted(((d, i, b[1], b[2], round(b[0], 12)) for (d, i), b in best.items()), key=str)


def result(df):
    return sorted(((r["doc_id"], r["item_id"], r["n_item"], r["n_shared"], round(r["containment"], 12)) for r in df.collect()), key=str)


def test_given_tables_match_brute_force(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    assert want and result(dec.contained_items(docs, bench)) == want
    kept = dec.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - len({w[0] for w in want})


@pytest.mark.parametrize("share", [0.8, 0.55])
def test_partial_copies_at_the_threshold_are_not_missed(spark, share):
    """Items with every number of words missing, inside long documents."""
    rng = np.random.default_rng(5)
    items = [(i, " ".join(f"w{int(x)}" for x in rng.integers(0, 10**6, n))) for i, n in enumerate([1, 3, 5, 6, 9, 14, 20, 33, 40, 70])]
    docs = []
    for i, text in items:
        w = text.split()
        for cut in range(0, len(w), 2):
            filler = [f"x{int(x)}" for x in rng.integers(0, 50, 300)]
            at = int(rng.integers(300))
            docs.append((len(docs), " ".join(filler[:at] + w[cut // 2 : len(w) - (cut - cut // 2)] + filler[at:])))
        docs.append((len(docs), text.upper().replace(" ", " \n\t")))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert result(dec.contained_items(d, b, share=share)) == brute(docs, items, share)


def test_edge_rows(spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta"
    docs = [(None, f"x {item} y"), (1, None), (2, ""), (3, " \n "), (4, item), (4, item), (4, "alpha beta gamma delta epsilon zeta eta"), (5, "few words"), (6, "a " * 200_000 + item), (7, "few words more")]
    items = [(10, item), (11, None), (12, ""), (13, "few words"), (None, item), (10, item), (14, "É É É É É É")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("row_id", "h", "item", "item_id", "body", "_found", "row")})
    b = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in ("item", "n", "h", "doc_id")})
    assert result(dec.contained_items(d, b)) == brute(docs, items)
    assert sorted((r["doc_id"] for r in dec.drop_contaminated(d, b).collect()), key=str) == [1, 2, 3, 7]
    assert dec.contained_items(d.limit(0), b).collect() == [] and dec.contained_items(d, b.limit(0)).collect() == []
    assert dec.drop_contaminated(d, b.limit(0)).count() == len(docs)


def test_clean_rows_of_a_shared_or_null_id_stay(spark, tmp_dir):
    item = "Alpha beta gamma delta epsilon zeta eta theta"
    clean = [(None, f"plain words of row {i} and no more") for i in range(20)] + [(None, None), (4, "alpha beta gamma delta epsilon zeta eta"), (4, None), (5, "other words")]
    docs = [(None, f"x {item} y"), (4, item), (4, item), (6, f"x {item} y"), *clean]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("row_id", "_row_id", "_gone", "_found", "row")})
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    b = spark.read.parquet(f"{tmp_dir}/benchmark.parquet")
    kept = corpus_pipeline.decontamination(spark, d, tmp_dir)
    assert kept.columns == d.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(clean, key=str)
    assert sorted((r["doc_id"] for r in dec.drop_contaminated(d, b).collect()), key=str) == sorted([5, *[None] * 21], key=str)


def test_short_items_inside_long_texts(spark):
    items = [(1, "alpha beta gamma"), (2, "one two three four"), (3, "few words"), (4, "alone"), (5, "a b c d e")]
    docs = [(1, "x " * 900 + "Alpha BETA\tgamma" + " y" * 900), (2, "alpha beta"), (3, "zero one two three four five"), (4, "few words here"), (5, "few words"), (6, "alone"), (7, "alpha beta gamma"), (8, "a b c d"), (9, "beta gamma alpha")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = result(dec.contained_items(d, b))
    assert got == brute(docs, items) and [g[:2] for g in got] == [(1, 1), (3, 2), (5, 3), (6, 4), (7, 1)]


def test_hashes_are_equal_for_equal_shingles_only():
    texts = ["a b c d e f", "A  B\tc d e g", "b c d e f", "a", "ab c d e f", "a bc d e f"]
    h, first, length = dec.shingle_hashes(words(*joined(pa.array([t.encode() for t in texts], pa.binary())), SPACED), 5)
    assert h[0] == h[2] and h[1] == h[4] and len(set(h.tolist())) == len(h) - 2 and length.tolist().count(1) == 1
