"""Suffix dedup: loser tree, brute force on documents and random strings, edge rows, hot grams."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm import suffix_dedup as sd
from encore.llm.loser_tree import front_code, merge, shared
from tests.conftest import SF


def brute(rows, length):
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum())
        kept = bytes(c for c, g in zip(b, gone[1:]) if not g)
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()), key=str)


def test_loser_tree_merges_and_knows_shared_lengths():
    rng = random.Random(2)
    for _ in range(300):
        runs = [sorted(bytes(rng.choices(b"ab", k=rng.randint(0, 9))) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 7))]
        out = list(merge([list(front_code(r)) for r in runs]))
        want = sorted((s, i) for i, r in enumerate(runs) for s in r)
        assert [(s, r) for r, _, _, s in out] == want
        assert all(runs[r][p] == s for r, p, _, s in out)
        before = None
        for _, _, h, s in out:
            assert before is None or h == shared(before, s)
            before = s


def test_given_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 20000")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, 400)
    assert sum(w[2] for w in want) > 0 and result(sd.suffix_dedup(docs)) == want


@pytest.mark.parametrize("hot,piece", [(20_000, 2 << 20), (3, 300)])
def test_shuffled_fragments_match_brute_force(spark, monkeypatch, hot, piece):
    """Strings of 24 bytes over texts cut from shared fragments, so that left
    and right contexts differ in every way; also with every common gram hot
    and texts longer than a piece."""
    monkeypatch.setattr(sd, "HOT", hot)
    monkeypatch.setattr(sd, "PIECE", piece)
    rng = random.Random(hot)
    fragments = ["".join(rng.choices("abcdé ", k=rng.randint(5, 60))) for _ in range(12)]
    rows = []
    for i in range(70):
        t = "".join(x[rng.randint(0, 8) :] if rng.random() < 0.5 else x[: rng.randint(10, 60)] for x in rng.choices(fragments, k=rng.randint(0, 9)))
        rows.append((i, t + "".join(rng.choices("xyz", k=rng.randint(0, 30)))))
    rows += [(900, "ab" * 300), (901, "q" * 25), (902, "q" * 24), (903, "z" * 23), (None, rows[3][1]), (3, rows[3][1]), (3, rows[3][1]), (904, None), (905, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("body", "mark", "found", "low", "kept", "touched")})
    assert result(sd.suffix_dedup(docs, length=24, gram=6)) == brute(rows, 24)


@pytest.mark.parametrize("hot", [1, 20_000])
def test_table_split_anew_between_jobs(spark, tmp_dir, monkeypatch, hot):
    """More cores between two jobs change the splits, and with them the pieces of text."""
    monkeypatch.setattr(sd, "HOT", hot)
    rng = random.Random(hot)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    passages = [" ".join(word() for _ in range(90)) for _ in range(20)]
    rows = [(i, " ".join([word(), passages[i % 20], word()])) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(16, "doc_id").write.parquet(f"{tmp_dir}/docs")
    docs, cores, write = spark.read.parquet(f"{tmp_dir}/docs"), "spark.sql.files.minPartitionNum", sd.stored
    settings = iter(["1", "1000", "1", "1000", "1", "1000"])

    def stored(df, name):
        spark.conf.set(cores, next(settings))
        return write(df, name)

    monkeypatch.setattr(sd, "stored", stored)
    try:
        assert result(sd.suffix_dedup(docs)) == brute(rows, 400)
    finally:
        spark.conf.unset(cores)


def test_many_equal_rows_without_id(spark):
    """5,000 rows of one text and no id: each piece settles its own, equal rows are cut once."""
    rng = random.Random(7)
    text = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(200))
    rows = [(None, text)] * 5000 + [(1, "x " + text[100:900]), (2, "plain"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = result(sd.suffix_dedup(docs))
    empty = hashlib.sha256(b"").hexdigest()
    assert got[:3] == sorted([(1, 802, 800, 1, hashlib.sha256(b"x ").hexdigest()), (2, 5, 0, 0, hashlib.sha256(b"plain").hexdigest()), (3, 0, 0, 0, empty)], key=str)
    assert got[3:] == [(None, len(text), len(text), 1, empty)] * 5000


def test_empty_table(spark):
    assert sd.suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def slow_passages(rows, length):
    texts = [(t or "").encode().split() for _, t in rows]
    holders = {}
    for k, w in enumerate(texts):
        for i in range(len(w) - length + 1):
            holders.setdefault(tuple(w[i : i + length]), set()).add(k)
    out = []
    for (d, _), w in zip(rows, texts):
        inside = set()
        for i in range(len(w) - length + 1):
            if len(holders[tuple(w[i : i + length])]) > 1:
                inside.update(range(i, i + length))
        out.append((d, len(inside)))
    return sorted(out, key=str)


def passage_words(df):
    return sorted(((r["doc_id"], r["n_passage_words"]) for r in df.collect()), key=str)


def test_planted_passages_of_over_50_words_are_counted(spark):
    """Passages of 51 to 60 short words are under 400 bytes: their bytes stay, their words are counted; clean documents have none."""
    rng = random.Random(51)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    passages = [[word() for _ in range(51 + i % 10)] for i in range(20)]
    rows = [(i, " ".join([word() for _ in range(80)] + passages[i % 20] + [word() for _ in range(60)])) for i in range(60)]
    clean = [(100 + i, " ".join(word() for _ in range(200))) for i in range(40)]
    # 50 shared words are not over 50, and a passage said twice in one document only is in no other
    clean += [(200, " ".join([word(), *passages[0][:50], word()])), (201, " ".join(passages[0][1:51])), (202, " ".join([*(alone := [word() for _ in range(60)]), word(), *alone]))]
    docs = spark.createDataFrame(rows + clean, "doc_id long, text string").repartition(5)
    got = sd.suffix_dedup(docs)
    assert passage_words(got) == slow_passages(rows + clean, 51)
    assert result(got) == brute(rows + clean, 400)
    caught = {r["doc_id"]: r["n_passage_words"] for r in got.collect()}
    assert all(caught[d] >= 51 for d, _ in rows) and not any(caught[d] for d, _ in clean)


@pytest.mark.parametrize("hot,piece", [(20_000, 2 << 20), (3, 160), (9, 1 << 10)])
def test_passage_words_match_brute_force(spark, monkeypatch, hot, piece):
    """Few words, copies, null ids and texts, any white space, words and texts longer than a piece, hot grams."""
    monkeypatch.setattr(sd, "HOT", hot)
    monkeypatch.setattr(sd, "PIECE", piece)
    rng = random.Random(piece)
    vocabulary = ["a", "b", "Ab", "ab", "é", "x" * 40, "x" * 41, "y" * 95]
    fragments = [rng.choices(vocabulary, k=rng.randint(3, 14)) for _ in range(9)]
    rows = []
    for i in range(60):
        words = [w for f in rng.choices(fragments, k=rng.randint(0, 5)) for w in f[rng.randint(0, 3) :]]
        rows.append((i, "".join(w + rng.choice([" ", "\n", "\t ", "  "]) for w in words)))
    rows += [(None, rows[3][1]), (3, rows[3][1]), (70, "only once " * 6), (71, None), (72, ""), (73, " " * 100), (74, "z" * 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = slow_passages(rows, 6)
    assert 5 < sum(n > 0 for _, n in want) < len(rows)
    assert passage_words(sd.suffix_dedup(docs, length=24, gram=6, passage=6)) == want
