"""Quality rules: figures by brute force, EM, native plan, edge rows."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from encore.llm import quality_rules as qr
from tests.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = collections.Counter(windows)
    repeated = {j for i, x in enumerate(windows) if count[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def test_figures_of_given_documents_and_edge_rows(spark):
    odd = [(None, "a b c a b c a b c d"), (1, None), (1, None), (2, ""), (3, " \n\t"), (4, "w " * 200_000), (5, "é ü 🙂\n\né ü 🙂\né ü 🙂 \n"), (6, "x y"), (7, "x y z"), (8, "a\x0bb\x0cc\rd a b c d")]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    docs = docs.withColumns({c: F.lit("x") for c in ("w", "l", "t", "g", "flat", "v0", "kept", "n")})
    out = qr.quality_rules(docs)
    got = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in out.collect()), key=str)
    assert got == sorted(((r["doc_id"], *slow(r["text"])) for r in docs.collect()), key=str)
    assert out.where("base_failed and kept").count() == 0
    plan = qr.figures(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_em_recovers_which_rules_to_trust(spark):
    """Five rules of known behaviour on independent texts; the useless one gets no say."""
    import numpy as np

    rng = np.random.default_rng(4)
    good = rng.random(6000) < 0.7
    votes = []
    for rate_good, rate_bad in ((0.9, 0.05), (0.8, 0.1), (0.85, 0.1), (0.7, 0.1), (0.5, 0.5)):
        yes = rng.random(6000) < np.where(good, rate_good, rate_bad)
        votes.append(np.where(rng.random(6000) < 0.2, None, yes.astype(int)))
    rows = collections.Counter(zip(*votes))
    schema = ", ".join(f"v{i} int" for i in range(5)) + ", n long"
    patterns = spark.createDataFrame([(*map(lambda v: None if v is None else int(v), k), n) for k, n in rows.items()], schema)
    model = qr.fit(patterns, [qr.BOTH] * 5)
    assert abs(model.good - 0.7) < 0.06
    assert model.on_good[0][0] > 0.6 > 0.2 > model.on_bad[0][0]
    assert abs(model.on_good[4][0] - model.on_bad[4][0]) < 0.1
    p = {tuple(r[f"v{i}"] for i in range(5)): r["p"] for r in patterns.withColumn("p", model.posterior()).collect()}
    right = sum((p[tuple(None if v is None else int(v) for v in k)] >= 0.5) == g for k, g in zip(zip(*votes), good))
    assert right / 6000 > 0.93


def test_verdicts_follow_quality_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    got = qr.quality_rules(docs).where("not base_failed").select("doc_id", "kept").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in got}
    assert kept[1] > 0.97 and kept[0] < 0.1


def test_empty_table(spark):
    assert qr.quality_rules(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert qr.fit(spark.createDataFrame([], "v0 int, n long"), [qr.BOTH]).good == pytest.approx(0.8)
