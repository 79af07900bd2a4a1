"""Spelling variants: brute force over all pairs, hot cells, chains, edge rows."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm import spelling
from tests.conftest import SF

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def slow_vocabulary(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_variants(words, ratio=5):
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    out = {}
    for w, n in words.items():
        near = [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if v != w and is_near(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] < ratio * n:
            best = None
        out[w] = (best, n, len(near), words.get(best))
    rows = set()
    for w, (form, n, near, form_n) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.add((w, form, root, n, near, form_n))
    return rows


def result(df):
    rows = [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_given_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = slow_vocabulary([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = result(spelling.spelling_groups(docs))
    assert len(got) > 100 and got == slow_variants(words)


@pytest.mark.parametrize(("block", "classes"), [(2048, 3), (8, 2), (5, 5)])
def test_random_words_in_small_blocks(spark, monkeypatch, block, classes):
    """A hot cell (one length, few letters) is dealt into many blocks."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    rng = np.random.default_rng(block)
    words = {"".join(rng.choice(list("aéÿx"), int(k))): int(n) for k, n in zip(rng.integers(6, 9, 300), rng.integers(5, 4000, 300))}
    words |= {"é" * 5000: 9, "é" * 4999 + "a": 50, "é" * 5001: 9}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(spelling.spelling_variants(df, classes=classes)) == slow_variants(words)


def test_chain_of_forms_ends_at_its_root(spark):
    words = {"aaaaaa" + "b" * i: 5 * 5**i for i in range(9)}
    got = result(spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == slow_variants(words) and {r[2] for r in got} == {"aaaaaabbbbbbbb"}


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "12 !? \n"), (None, "Colour COLOUR colour Colour colour kolour"), (4, "colour× kolour kolour kolour kolour. " * 2), (4, "gruppeé gruppee " * 40)]
    rows += [(5, "ab " * 30_000 + "Straße " * 7)] * 3 + [(i, "grüppee") for i in range(100, 120)] + [(6, "x" * 300_000)] * 5
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], SCHEMA)
    docs = docs.withColumns({c: F.lit("x") for c in ("word", "n", "run", "id", "h", "cell", "sides", "a", "b", "left", "own")})
    assert result(spelling.spelling_groups(docs)) == slow_variants(slow_vocabulary(rows))


def test_empty_table(spark):
    assert spelling.spelling_groups(spark.createDataFrame([], SCHEMA)).collect() == []
