"""Randomised properties (hypothesis): metrics and indexes against plain Python."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from encore.operators import indexing, ranking

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def python_metrics(pred, truth, k):
    lab = set(truth)
    hits, prec_sum, apk, dcg = 0, 0.0, 0.0, 0.0
    for i, p in enumerate(pred):
        if p in lab:
            hits += 1
            prec_sum += hits / (i + 1)
            if i < k:
                apk += hits / (i + 1)
                dcg += 1 / math.log(i + 2)
    hk = sum(1 for p in pred[:k] if p in lab)
    idcg = sum(1 / math.log(i + 2) for i in range(min(len(lab), k)))
    return {
        "map": prec_sum / len(lab),
        "map_at_k": apk / min(len(lab), k),
        "precision_at_k": hk / k,
        "ndcg_at_k": dcg / idcg,
        "recall_at_k": hk / len(lab),
    }


lists = st.dictionaries(
    st.integers(0, 30),
    st.tuples(
        st.lists(st.integers(0, 25), min_size=1, max_size=12, unique=True),
        st.lists(st.integers(0, 25), min_size=1, max_size=15),
    ),
    min_size=1,
    max_size=12,
)


@SETTINGS
@given(data=lists, k=st.integers(1, 8))
def test_metrics_equal_plain_python(spark, data, k):
    preds = spark.createDataFrame(
        [(u, r + 1, it) for u, (p, _) in data.items() for r, it in enumerate(p)], "user_idx long, rank int, item_idx long"
    )
    truth = spark.createDataFrame([(u, it) for u, (_, t) in data.items() for it in t], "user_idx long, item_idx long")
    got = {r["user_idx"]: r for r in ranking.per_user_metrics(preds, truth, k).collect()}
    assert set(got) == set(data)
    for u, (p, t) in data.items():
        want = python_metrics(p, t, k)
        for m, v in want.items():
            assert abs(got[u][m] - v) < 1e-12, (u, m)


@SETTINGS
@given(keys=st.lists(st.one_of(st.none(), st.text(min_size=0, max_size=4)), min_size=1, max_size=60), parts=st.integers(1, 9))
def test_contiguous_index_equals_sorted_rank(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "user_id string").repartition(parts)
    got = {r["user_id"]: r["user_idx"] for r in indexing.index_users(df, n_parts=parts).collect()}
    distinct = sorted({k for k in keys if k is not None}, key=lambda s: s.encode("utf-8"))
    assert got == {k: i for i, k in enumerate(distinct)}
