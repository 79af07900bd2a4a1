"""Personal data: base rules by plain patterns, LSTM-CRF gradients, held-out tagging, edge rows."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from encore.llm import pii
from encore.llm.bilstm_crf import Tagger

SF = "/root/testdata/sf0.01"
PLAIN = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def slow_spans(text):
    out = [(m.start(), 0, m.end()) for m in PLAIN[0].finditer(text)]
    out += [(m.start(), 1, m.end()) for m in PLAIN[1].finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in PLAIN[2].finditer(text):
        d = [int(c) for c in m[0] if c in "0123456789"]
        if 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PLAIN[3].finditer(text) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(out)


def test_base_rules_match_plain_patterns_on_random_texts():
    rng = random.Random(3)
    bits = ["a", "B.", "@", "x-y", ".com", ".", "1", "25", "255", "999", "000", " ", "-", "+", "(", ")", "4111111111111111", "+1 555", "é", "%", "_", "\n", "5500 0000 0000 0004"]
    for _ in range(20_000):
        t = "".join(rng.choices(bits, k=rng.randint(0, 16)))
        assert pii.base_spans(t) == slow_spans(t), t


def test_likelihood_and_gradients_match_enumeration():
    rng = np.random.default_rng(0)
    tagger = Tagger.new(5, 3, 2, seed=1)
    tagger.params["a"] = rng.normal(size=(3, 3)).astype(np.float32)
    x, y = rng.integers(0, 5, (2, 4)), rng.integers(0, 3, (2, 4))

    def loss():
        e, _ = tagger.scores(x)
        a, total, best = tagger.params["a"], 0.0, []
        for n in range(2):
            value = {p: sum(e[t, n, p[t]] for t in range(4)) + sum(a[p[t - 1], p[t]] for t in range(1, 4)) for p in itertools.product(range(3), repeat=4)}
            total += np.log(sum(np.exp(float(v)) for v in value.values())) - float(value[tuple(y[n])])
            best.append(max(value, key=value.get))
        return total / 2, best

    want, best = loss()
    got, grads = tagger.gradients(x, y)
    assert abs(got - want) < 1e-4 and [tuple(r) for r in tagger.decode(x)] == best
    for k, g in grads.items():
        flat = tagger.params[k].reshape(-1)
        for i in rng.integers(0, len(flat), 4):
            old = flat[i]
            flat[i] = old + 1e-2
            up = loss()[0]
            flat[i] = old - 1e-2
            down = loss()[0]
            flat[i] = old
            assert abs((up - down) / 2e-2 - g.reshape(-1)[i]) < 2e-3, k


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit_pii(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), rows=3000)


def test_rewritten_data_in_texts_the_fit_has_not_seen():
    """Fitted on half of the texts with digits or @, measured on the other half: added spans, by kind of rewriting."""
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet").column("text").to_pylist()
    able = [t for t in texts if t and re.search("[0-9@]", t)]
    model = pii.fit([t for t in able if zlib.crc32(t.encode()) % 2])
    rest = [t for t in able if not zlib.crc32(t.encode()) % 2]

    def measured(ways):
        rng = np.random.default_rng(7)
        told = [pii.rewritten(t, ways, rng, 0.6) for t in rest]
        wanted = found = added = right = 0
        for (_, spans, changed), row in zip(told, pii.all_spans([t for t, _, _ in told], model)):
            mine = [(s["start"], s["end"], s["kind"]) for s in row if not s["base"]]
            true = [(s, e, pii.KINDS[k]) for (s, k, e), c in zip(spans, changed) if c]
            wanted, added = wanted + len(true), added + len(mine)
            found += sum(any(a < e and s < b and k == q for a, b, q in mine) for s, e, k in true)
            right += sum(any(a < e and s < b and k == q for s, e, k in true) for a, b, q in mine)
        return wanted, found / wanted, right / max(1, added)

    wanted, recall, precision = measured(pii.SEEN)
    assert wanted > 100 and recall >= 0.9 and precision >= 0.9, (recall, precision)
    wanted, recall, precision = measured(pii.UNSEEN)
    print("rewritings kept from the fit: recall", recall, "precision", precision)
    # reported in the README; ways that are neither learned nor near to one are mostly missed
    assert wanted > 100 and recall > 0.25 and precision > 0.6, (recall, precision)
    # texts as they are: what the rules rejected (a card that fails its check) is not added
    assert sum(not s["base"] for row in pii.all_spans(rest, model) for s in row) <= 0.02 * len(rest)


def test_rewritings_keep_texts_and_places():
    rng = np.random.default_rng(1)
    text = "a x@y.com, b 10.1.2.3; c 4111 1111 1111 1111 d +1 (555) 123-4567 é"
    for ways in (pii.SEEN, pii.UNSEEN):
        for _ in range(60):
            told, spans, changed = pii.rewritten(text, ways, rng, 0.7)
            assert [k for _, k, _ in spans] == [0, 1, 2, 3]
            base = {(s, e) for s, _, e in pii.base_spans(told)}
            for (s, k, e), c, old in zip(spans, changed, pii.base_spans(text)):
                assert (told[s:e] != text[old[0] : old[2]]) == c and (c or (s, e) in base)
                assert not c or pii.triggers(pii.code_array(told[s:e])).any()
            gaps = [told[i:j] for i, j in zip([0, *[e for _, _, e in spans]], [*[s for s, _, _ in spans], len(told)])]
            assert gaps == ["a ", ", b ", "; c ", " d ", " é"]


def test_viterbi_of_stretches_and_long_runs_agree_with_enumeration(monkeypatch):
    rng = np.random.default_rng(3)
    tagger = Tagger.new(5, 3, 2, seed=1)
    tagger.params["a"] = rng.normal(size=(3, 3)).astype(np.float32)
    sizes = [3, 1, 5, 5, 2]
    e, offsets = rng.normal(size=(sum(sizes), 3)).astype(np.float32), np.cumsum([0, *sizes])
    got = tagger.viterbi(e, offsets)
    for s, t in zip(offsets[:-1], offsets[1:]):
        score = lambda p, s=s, t=t: sum(e[s + i, p[i]] for i in range(t - s)) + sum(tagger.params["a"][p[i - 1], p[i]] for i in range(1, t - s))
        assert tuple(got[s:t]) == max(itertools.product(range(3), repeat=t - s), key=score)
    # a stretch of many windows, passed whole and in parts
    model = pii.PiiModel(Tagger.new(pii.CLASSES, pii.TAGS, 4, seed=2))
    model.tagger.params["a"] *= 0
    text = " ".join(f"{i}@x" for i in range(3000))
    whole = pii._added([text, "no", text[:100]], model)
    monkeypatch.setattr(pii, "RUN", 3)
    monkeypatch.setattr(pii, "AT_ONCE", 7)
    assert pii._added([text, "no", text[:100]], model) == whole and whole[0]


def test_windows_cover_every_trigger_and_scores_are_averaged():
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice(["abc", "1", "@", ".", " dot ", "DOT", " anecdote "]) if rng.random() < 0.05 else "x" for _ in range(rng.randint(0, 900)))
        codes = pii.code_array(text)
        hot = {m.start() for m in re.finditer(r"[0-9@]|(?<![A-Za-z])[dD][oO][tT](?![A-Za-z])", text)}
        assert set(np.flatnonzero(pii.triggers(codes)).tolist()) == hot
        covered = np.zeros(len(codes) + 2 * pii.WINDOW, bool)
        for s in pii.window_starts(codes).tolist():
            covered[s + pii.WINDOW : s + 2 * pii.WINDOW] = True
        assert all(covered[pii.WINDOW + max(0, h - pii.HALF // 2) : pii.WINDOW + h + pii.HALF // 2].all() for h in hot)
    scores = np.arange(pii.WINDOW * 3 * 2, dtype=np.float64).reshape(pii.WINDOW, 3, 2)
    mean = pii.averaged(scores)
    for p in range(len(mean)):
        over = [scores[p - w * pii.HALF, w] for w in range(3) if 0 <= p - w * pii.HALF < pii.WINDOW]
        assert np.allclose(mean[p], np.mean(over, axis=0))


def test_query_digest_and_edge_rows(spark, model):
    odd = [(None, "mail a.b@c.de now"), (1, None), (1, None), (2, ""), (3, "é" * 30_000 + " +1 (555) 123-4567 x@y.z"), (4, "1" * 100_000), (5, "a" * 100_000 + "@"), (6, "1." * 30_000), (7, "@" * 5000), (8, "card 4111 1111 1111 1112 end")]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).union(spark.createDataFrame(odd, "doc_id long, text string"))
    docs = docs.withColumns({c: F.lit("x") for c in ("body", "spans", "base", "h", "kind")})
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    got = pii.digest(pii.find_pii(docs, model)).collect()

    def want(d, t):
        spans = pii.base_spans(t)
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        return (d, *[sum(s[1] == k for s in spans) for k in range(4)], hashlib.sha256(text.encode()).hexdigest())

    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((want(*r) for r in rows), key=str)
    for r in got:
        spans = [s for s in r["spans"].split(",") if s]
        assert len(spans) >= r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"]
    assert pii.find_pii(docs.limit(0), model).collect() == []
