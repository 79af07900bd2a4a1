"""SimHash: brute force, ties, nulls, repeated rows, clashing columns."""

import itertools

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from encore.llm import simhash
from tests.conftest import SF

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_groups(rows):
    marks = [slow_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (marks[i] ^ marks[j]).bit_count() <= 4:
            root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, f"{marks[i]:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=str)


def test_given_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert result(simhash.simhash_dedup(docs)) == slow_groups(rows)


def test_edge_rows(spark):
    rows = [(5, None), (3, ""), (9, " \t\n"), (None, "a b c d e f g h"), (1, "A B c d e f g h"), (1, "A B c d e f g h"), (7, "one two"), (8, "é ü x"), (2, "w " * 200_000)]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], SCHEMA).withColumns({c: F.lit("x") for c in ("fp", "body", "place", "row", "k", "t", "u", "n", "component_id")})
    assert result(simhash.simhash_dedup(docs)) == slow_groups(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 2, 3, 7, 8]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.simhash_dedup(docs).collect() == [] and simhash.keep_one(docs).collect() == []


def test_every_pair_within_the_radius_collides_in_some_table():
    rng = np.random.default_rng(1)
    keep = [m & (2**64 - 1) for m in simhash.masks(4)]
    for _ in range(3000):
        diff = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(diff & m == 0 for m in keep)
    assert len(keep) == 31 and max(m.bit_count() for m in keep) <= 35


@pytest.mark.parametrize("bucket", [4096, 8])
def test_large_group_of_near_fingerprints(spark, monkeypatch, bucket):
    """Chains, dense balls and far values; small blocks give the same links."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = np.random.default_rng(bucket)
    base = int(rng.integers(1 << 62))
    marks = {base ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 4)), replace=False)) for _ in range(150)}
    x = int(rng.integers(1 << 62))
    for i in range(0, 60, 4):
        x ^= 0b1111 << i
        marks.add(x)
    marks |= {int(v) for v in rng.integers(1 << 62, size=40)}
    rows = sorted(marks)
    df = spark.createDataFrame([(i, m - (1 << 64) if m >> 63 else m) for i, m in enumerate(rows)], "doc_id long, fp long")
    got = {r["fp"]: r["component_id"] for r in simhash.simhash_groups(df).collect()}
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (rows[i] ^ rows[j]).bit_count() <= 4:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    assert got == {m - (1 << 64) if m >> 63 else m: find(i) for i, m in enumerate(rows)}


def test_keep_one_when_the_table_is_split_anew_between_jobs(spark, tmp_dir):
    """More cores between two jobs change the splits, and with them row numbers."""
    rows = [(i, f"the {i // 2} a{i // 2} b{i // 2} c{i // 2} d{i // 2} e{i // 2}", None, None, None) for i in range(400)]
    spark.createDataFrame(rows, SCHEMA).repartition(16, "doc_id").write.parquet(f"{tmp_dir}/docs")
    docs, cores = spark.read.parquet(f"{tmp_dir}/docs"), "spark.sql.files.minPartitionNum"
    want = sorted({g[2] for g in slow_groups([r[:2] for r in rows])})
    try:
        spark.conf.set(cores, "1")
        kept = simhash.keep_one(docs)
        spark.conf.set(cores, "1000")
        assert sorted(r["doc_id"] for r in kept.collect()) == want
    finally:
        spark.conf.unset(cores)
