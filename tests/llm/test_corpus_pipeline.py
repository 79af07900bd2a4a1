"""The pipeline, stage by stage, against brute force on small tables."""

import os
from collections import Counter

import corpus_pipeline as cp
from encore.llm.common import stored
from encore.llm.queries import TOKENIZER
from encore.llm.token_files import load_tokenizer
from tests.conftest import SF
from tests.llm.test_decontaminate import brute
from tests.llm.test_mix import water_fill
from tests.llm.test_simhash import slow_groups


def test_stages_against_brute_force(spark, tmp_dir):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**6, "", "en", "src0", 0), (10**6, "", "en", "src0", 0), (10**6 + 1, "plain words only here", "en", None, 5)], given.schema)
    given.union(odd).write.parquet(f"{tmp_dir}/documents.parquet")
    for name in ("labels", "benchmark"):
        os.symlink(f"{SF}/{name}.parquet", f"{tmp_dir}/{name}.parquet")
    docs, seen = spark.read.parquet(f"{tmp_dir}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        before = docs
        docs = stored(stage(spark, before, tmp_dir), "test-stage")
        seen[name] = ([tuple(r) for r in before.collect()], [tuple(r) for r in docs.collect()])
        if name != cp.STAGES[-1][0]:
            assert docs.schema.names == given.schema.names

    before, after = seen["toxicity"]
    assert not Counter(after) - Counter(before) and len(after) > 0.8 * len(before)

    before, after = seen["simhash near-dedup"]
    groups = slow_groups([(r[0], r[1]) for r in before])
    assert not Counter(after) - Counter(before)
    assert sorted((r[0] for r in after), key=str) == sorted({g[2] for g in groups}, key=str)

    before, after = seen["benchmark decontamination"]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {b[0] for b in brute([(r[0], r[1]) for r in before], bench)}
    assert Counter(after) == Counter(r for r in before if r[0] not in bad)

    before, after = seen["mixing sources"]
    size = {r: len((r[1] or "").encode().split()) for r in before}
    per = Counter()
    for r in before:
        per[r[3]] += size[r]
    target, taken = water_fill(per), Counter()
    for r in after:
        taken[r[3]] += size[r]
    assert all(abs(taken[s] - t) <= max((size[r] for r in before if r[3] == s), default=0) / 2 + 1 for s, t in target.items())

    before, after = seen["token files"]
    library = load_tokenizer(TOKENIZER)
    want = Counter((r[0], len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1) for r in before)
    assert Counter((r[0], r[2]) for r in after) == want
    assert sum(r[2] for r in after) == max(r[1] + r[2] for r in after)
