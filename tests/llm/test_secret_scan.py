"""Secret scan: the automaton against regular expressions, offsets, edge rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from encore.llm import secret_scan
from encore.llm.automaton import compile_rules, parse
from tests.conftest import SF

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KINDS = ("assign", "access", "hex")
SCANNER = secret_scan.Scanner(secret_scan.RULES)


def slow_spans(t):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def fast_spans(t):
    body = t.encode()
    spans = SCANNER.spans(body)
    at = secret_scan.code_points(body, [p for _, s, e in spans for p in (s, e)])
    return [(k, at[2 * i], at[2 * i + 1]) for i, (k, _, _) in enumerate(spans)]


def test_random_texts_match_regular_expressions():
    rng = random.Random(7)
    bits = ["password", "PASSWD", "Secret", "token", "api", "_", "key", '"', "'", " ", ":", "=", "a", "0f", "AKIA", "Z9Z9Z9", "abcdef0123", "é", "\n", "-", "Key", "ſecret"]
    for _ in range(20_000):
        t = "".join(rng.choices(bits, k=rng.randint(0, 25)))
        assert [s for s in fast_spans(t) if s[0] in KINDS] == slow_spans(t), t


@pytest.mark.parametrize(
    "text,kind",
    [("x ghp_" + "a1B2" * 9 + " y", "forge"), ("-----BEGIN RSA PRIVATE KEY-----", "pem"), ("xoxb-1234567890-abcdefghij", "chat"), ("eyJhbGci.eyJzdWIi.c2ln", "jwt")],
)
def test_added_rules(text, kind):
    assert [text[a:b] for k, a, b in fast_spans("é" + text) if k == kind] or kind in {k for k, _, _ in fast_spans(text)}


def test_minimal_automaton_is_small_and_right():
    a = compile_rules([parse("(ab|cd)*x{2,}"), parse("[0-9]+")], anchored=True)
    for text in ("xx", "abxx", "abcdxxx", "x", "ax", "12", "", "1a"):
        state = 0
        for c in text.encode():
            state = a.table[state][a.classes[c]]
        want = (1 if re.fullmatch("(ab|cd)*x{2,}", text) else 0) | (2 if re.fullmatch("[0-9]+", text) else 0)
        assert a.accept[state] == want, text


def test_query_digest_over_given_documents_and_edge_rows(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(None, 'token = "abcdefghijklmnop"'), (1, None), (1, None), (2, ""), (3, "é" * 50_000 + " " + "0123456789abcdef" * 3), (4, "a" * 300_000), (4, "token=" * 20_000)]
    docs = given.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string")).withColumns({c: F.lit("x") for c in ("body", "spans", "kind", "n_hex")})
    got = secret_scan.digest(secret_scan.find_secrets(docs), list(KINDS)).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]

    def want(d, t):
        spans = slow_spans(t or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        return (d, *[sum(s[0] == k for s in spans) for k in KINDS], hashlib.sha256(text.encode()).hexdigest())

    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted((want(*r) for r in rows), key=str)
    assert secret_scan.find_secrets(given.limit(0)).collect() == []
