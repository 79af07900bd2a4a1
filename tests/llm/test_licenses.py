"""License scans: brute force over words, notices with changes, edge rows."""

import math
import re

from pyspark.sql import functions as F

from encore.llm import licenses
from tests.conftest import SF

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def slow_base(doc, text):
    words = words_of(text)
    found = sorted((i, label) for label, phrase in (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")) for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
    return (doc, len(words), len(found), found[0][0] if found else None, found[-1][0] if found else None, ",".join(sorted({label for _, label in found})))


def slow_notices(rows):
    """Labels and score of each row, straight from the definition: template
    starts by the words of highest IDF, grouped up to the slack, key phrases at their places."""
    texts = [words_of(t) for _, t in rows]
    vocabulary = sorted({w.decode() for t in licenses.TEMPLATES for w in t.words})
    idf = {w: math.log((len(rows) + 1) / (sum(w in set(t) for t in texts) + 1)) for w in vocabulary}
    out = []
    for text in texts:
        labels, score = set(), 0.0
        for t in licenses.NOTICES:
            mine = [w.decode() for w in t.words]
            rare = sorted(set(mine), key=lambda w: (-idf[w], vocabulary.index(w)))[: licenses.RARE]
            indexed = [(p, w) for p, w in enumerate(mine) if w in rare]
            starts = sorted((i - p, p) for p, w in indexed for i, v in enumerate(text) if v == w)
            groups = []
            for s, p in starts:
                if groups and s - groups[-1][-1][0] <= licenses.SLACK:
                    groups[-1].append((s, p))
                else:
                    groups.append([(s, p)])
            for g in groups:
                low, high = g[0][0] - licenses.SLACK, g[-1][0] + licenses.SLACK
                if 2 * len({p for _, p in g}) < len(indexed):
                    continue

                def stands(phrase, place):
                    return any(text[i : i + len(phrase)] == phrase for i in range(max(0, low + place), min(len(text), high + place + 1)))

                keys = [words_of(k) for k in t.keys]
                places = [next(p for p in range(len(mine)) if mine[p : p + len(k)] == k) for k in keys]
                if all(stands(k, p) for k, p in zip(keys, places)):
                    labels.add(t.label)
                    score = max(score, sum(stands([w], p) for p, w in enumerate(mine)) / len(mine))
        out.append((labels, score))
    return out


def check(spark, docs, rows):
    got = licenses.digest(licenses.find_licenses(docs)).collect()
    want = []
    for row, (labels, score) in zip(rows, slow_notices(rows)):
        base = slow_base(*row)
        every = sorted(labels | set(filter(None, base[5].split(","))))
        want.append((*base, ",".join(every), round(1.0 if base[2] else score, 9)))
    assert sorted(((*r[:7], round(r[7], 9)) for r in got), key=str) == sorted(want, key=str)
    return {r["doc_id"]: r for r in got}


def test_given_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(spark, docs, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_notices_with_changes(spark):
    rows = [
        (1, "x y\n# Licensed under the\n# Apache License, Version 2.0 (the \"License\")"),
        (2, "licensed under the apache software license, version 2.0"),
        (3, "the MIT License is named here. The version of apache was 2 0."),
        (4, "Permission is hereby granted, free of charge, to any person getting a copy of this software and the associated documentation files"),
        (5, "This work is licensed under the GNU General Public License, version 3. General public license! General, public; license?"),
        (6, "All Rights\n\nReserved, all-rights-reserved; all rights: reserved. CC-BY 4.0 cc_by CC/BY"),
        (7, "Licensed under CC BY-NC 4.0."),
        (8, "Redistribution and use in source and binary forms, with or without modification, are permitted if you like"),
        (9, "GNU Lesser General Public License, under the terms of"),
        (10, "license " * 50 + "mit license " * 3),
        (11, "all rights"),
        (12, "reserved"),
        (13, "CC"),
        (14, "BY and by"),
    ]
    found = check(spark, spark.createDataFrame([(d, t, None, None, None) for d, t in rows], SCHEMA).coalesce(1), rows)
    assert found[1]["labels"] == "apache-2.0" and found[4]["labels"] == "mit" and found[5]["labels"] == "gpl,gpl-3.0" and found[8]["labels"] == ""
    assert found[7]["labels"] == "cc-by,cc-by-nc-4.0" and found[3]["labels"] == "mit" and found[6]["base_labels"] == "cc-by,reserved"


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(licenses, "PIECE", 1 << 16)
    rows = [(1, None), (2, ""), (3, " \t\n.,"), (None, "cc by"), (4, "CC BY"), (4, "CC BY"), (5, "é cc ÿby cc by\u0080 ccby cc by İcc by"), (6, "z" * 400_000 + " cc by " + "general public license " * 20_000)]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], SCHEMA)
    docs = docs.withColumns({c: F.lit("x") for c in ("body", "word", "n", "places", "n_words", "label", "score", "labels")})
    check(spark, docs, rows)


def test_empty_table(spark):
    assert licenses.digest(licenses.find_licenses(spark.createDataFrame([], SCHEMA))).collect() == []
