"""Quality classifier: held-out accuracy, gradients, attention, edge rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from encore.llm import quality_mil as mil
from encore.llm.common import joined

SF = "/root/testdata/sf0.01"


def laid_out(texts):
    return joined(pa.array([t.encode() for t in texts], pa.binary()))


def test_held_out_accuracy_on_given_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = mil.fit_quality(docs, labels, ~mil.is_held_out())
    got = mil.score_quality(docs, model).join(labels, "doc_id").where(mil.is_held_out()).select("quality", (F.col("score") >= 0.3).alias("p")).toPandas()
    y, p = got["quality"] == 1, got["p"]
    assert (p & y).sum() / y.sum() > 0.95 and (p & ~y).sum() / (~y).sum() < 0.2


def test_gradients_match_differences():
    rng = np.random.default_rng(2)
    width = mil.FIGURES + mil.SKETCH
    x, first, y = rng.normal(size=(9, width)), np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0])
    model = mil.fit([], np.zeros(0))

    def loss():
        s = model.forward(x, first)["score"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    grads = mil._gradients(model, x, first, y)
    for k, g in grads.items():
        flat = model.params[k].reshape(-1)
        for i in rng.integers(0, len(flat), 3):
            old, step = flat[i], 1e-5
            flat[i] = old + step
            up = loss()
            flat[i] = old - step
            down = loss()
            flat[i] = old
            assert abs((up - down) / (2 * step) - g.reshape(-1)[i]) < 1e-6, k


def test_attention_finds_the_deciding_passage(spark):
    rng = np.random.default_rng(0)
    words = ["alpha", "beta", "gamma", "delta", "river", "stone"]
    texts, labels = [], []
    for i in range(240):
        parts = [" ".join(rng.choice(words, mil.PASSAGE)) for _ in range(4)]
        if i % 2:
            k = rng.integers(4)
            parts[k] = " ".join("%%%" + w for w in parts[k].split())
        texts.append(" ".join(parts))
        labels.append(1 - i % 2)
    model = mil.fit([t.encode() for t in texts[:200]], np.array(labels[:200]), epochs=40)
    scores = mil.score_bodies(*laid_out(texts[200:]), model)
    assert ((scores >= 0.5) == (np.array(labels[200:]) == 1)).all()
    bad = [(i, t) for i, (t, q) in enumerate(zip(texts, labels)) if not q][-5:]
    rows = mil.passage_attention(spark.createDataFrame(bad, "doc_id long, text string"), model).collect()
    for i, t in bad:
        mine = [r for r in rows if r["doc_id"] == i]
        assert abs(sum(r["attention"] for r in mine) - 1) < 1e-6
        top = max(mine, key=lambda r: r["attention"])
        assert "%%%" in t[top["start"] : top["end"]]


def test_edge_rows(spark):
    model = mil.fit([b"good words here", b"### %%% $$$"] * 20, np.array([1, 0] * 20))
    rows = [(None, "good words here"), (1, None), (1, None), (2, ""), (3, " \n"), (4, "word " * 200_000), (5, "x" * 300_000), (6, "é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("body", "score", "quality", "label")})
    got = mil.score_quality(docs, model).collect()
    assert sorted((r["doc_id"] for r in got), key=str) == sorted((r[0] for r in rows), key=str)
    assert all(0 <= r["score"] <= 1 for r in got) and len({r["score"] for r in got if r["doc_id"] in (1, 2, 3)}) == 1
    assert mil.score_quality(docs.limit(0), model).collect() == []
    alone = {t: mil.score_bodies(*laid_out([t or ""]), model)[0] for _, t in rows}
    together = mil.score_bodies(*laid_out([t or "" for _, t in rows]), model)
    assert np.allclose(together, [alone[t] for _, t in rows])
