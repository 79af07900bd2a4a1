"""Drift statistics: identities, extremes, empty sides, p-value checks."""

import math

import pytest
from pyspark.sql import functions as F

from encore.operators import drift


def frame(spark, values, col="x"):
    return spark.createDataFrame([(v,) for v in values], f"{col} double")


def test_table_with_itself_is_zero(spark):
    df = frame(spark, [1.0, 2.0, 2.0, 5.0, 9.5])
    s = drift.ecdf_stats(df, df, "x").first()
    assert s["ks"] == 0 and s["wasserstein"] == 0 and s["ks_p_value"] == 1.0
    assert drift.js_distance(df, df, "x").first()["js"] == pytest.approx(0.0, abs=1e-9)


def test_disjoint_constants(spark):
    a, b = frame(spark, [1.0] * 5), frame(spark, [3.0] * 4)
    s = drift.ecdf_stats(a, b, "x").first()
    assert s["ks"] == 1.0
    assert s["wasserstein"] == pytest.approx(2.0)
    assert s["wasserstein_norm"] == pytest.approx(2.0 / 0.001)  # std of a constant is floored
    assert drift.js_distance(a, b, "x").first()["js"] == pytest.approx(math.sqrt(math.log(2)))


def test_wasserstein_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    a, b = rng.normal(0, 1, 300).round(2), rng.normal(0.5, 2, 200).round(2)
    s = drift.ecdf_stats(frame(spark, a.tolist()), frame(spark, b.tolist()), "x").first()
    grid = np.sort(np.unique(np.concatenate([a, b])))
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    assert s["ks"] == pytest.approx(np.max(np.abs(fa - fb)))
    assert s["wasserstein"] == pytest.approx(np.sum(np.abs(fa - fb)[:-1] * np.diff(grid)))


def test_empty_side_no_drift_no_error(spark):
    a, empty = frame(spark, [1.0, 2.0]), frame(spark, [])
    rep = drift.drift_report(a, empty, ["x"], [], size="large").first()
    assert rep["score"] is None and rep["drifted"] is False
    rep = drift.drift_report(a, empty, [], ["x"], size="small").first()
    assert rep["score"] is None and rep["drifted"] is False


def test_chi_square_p_value_known_points(spark):
    # chi2 survival values: (x, dof) -> p
    cases = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (11.070497693516351, 5, 0.05), (0.0, 3, 1.0), (20.0, 10, 0.02925268807696113)]
    df = spark.createDataFrame([(x, d) for x, d, _ in cases], "x double, d int")
    got = df.select(drift.chi2_sf(F.col("x"), F.col("d")).alias("p")).collect()
    for (x, d, p), r in zip(cases, got):
        assert r["p"] == pytest.approx(p, abs=1e-9), (x, d)


def test_chi_square_table(spark):
    ref = spark.createDataFrame([("a",)] * 30 + [("b",)] * 10, "x string")
    cur = spark.createDataFrame([("a",)] * 10 + [("b",)] * 30, "x string")
    r = drift.chi_square(ref, cur, "x").first()
    # 2x2 table [[30,10],[10,30]]: expected 20 everywhere -> chi2 = 4 * 100/20 = 20
    assert r["chi2"] == pytest.approx(20.0) and r["dof"] == 1
    assert r["p_value"] == pytest.approx(7.744216431044e-06, rel=1e-6)


def test_kolmogorov_sf_points(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (1.36,), (2.0,)], "l double")
    got = [r[0] for r in df.select(drift.kolmogorov_sf(F.col("l"))).collect()]
    want = [2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * x * x) for j in range(1, 101)) for x in (0.5, 1.0, 1.36, 2.0)]
    assert got == pytest.approx(want, abs=1e-12)
    assert got[1] == pytest.approx(0.26999967, abs=1e-7)  # published value of Q(1)


def test_kolmogorov_sf_near_zero(spark):
    df = spark.createDataFrame([(x,) for x in (1e-6, 0.0005, 0.001, 0.01, 0.1, 0.3, 0.99, 1.01)], "l double")
    got = [r[0] for r in df.select(drift.kolmogorov_sf(F.col("l"))).collect()]
    assert got[:5] == pytest.approx([1.0] * 5, abs=1e-12)
    # both series agree where both converge
    for x, p in zip((0.3, 0.99, 1.01), got[5:]):
        assert p == pytest.approx(2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * x * x) for j in range(1, 400)), abs=1e-10)


def test_one_row_or_nan_apart_is_no_drift(spark):
    ref = spark.range(20_000).select((F.col("id") % 977).cast("double").alias("x"))
    other = spark.range(20_000).select(F.when(F.col("id") == 5, 1e6).otherwise((F.col("id") % 977).cast("double")).alias("x"))
    row = drift.column_drift(ref, other, "x", "ks").first()
    assert row["score"] == pytest.approx(1.0, abs=1e-9) and row["drifted"] is False
    odd = ref.union(spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),)], "x double"))
    for method in ("ks", "wasserstein"):
        row = drift.column_drift(ref, odd, "x", method).first()
        assert row["drifted"] is False and not math.isnan(row["score"])


def test_chi2_tail_at_any_degree(spark):
    def series(x, dof):
        a, z = dof / 2, x / 2
        return 1 - math.fsum(math.exp((a + n) * math.log(z) - z - math.lgamma(a + n + 1)) for n in range(int(z + 12 * math.sqrt(z) + 40)))

    cases = [(x, d) for d in (399, 400, 401, 402, 1000, 20_001) for x in (d - 2 * math.sqrt(2 * d), float(d), d + 2 * math.sqrt(2 * d))]
    df = spark.createDataFrame(cases, "x double, d long")
    for (x, d), r in zip(cases, df.select(drift.chi2_sf(F.col("x"), F.col("d")).alias("p")).collect()):
        assert r["p"] == pytest.approx(series(x, d), abs=1e-8), (x, d)
    big = [(1e9, 10**9), (1e9 + 2 * math.sqrt(2e9), 10**9), (1e12, 10), (5.0, 10**9), (1e10, 5 * 10**9)]
    got = [r[0] for r in spark.createDataFrame(big, "x double, d long").select(drift.chi2_sf(F.col("x"), F.col("d"))).collect()]
    assert got == pytest.approx([0.5, 0.02275, 0.0, 1.0, 0.0], abs=1e-4)


def test_dataset_drift_share(spark):
    rep = spark.createDataFrame([("a", "m", 0.2, 0.1, True), ("b", "m", 0.0, 0.1, False)], drift_schema())
    d = drift.dataset_drift(rep).first()
    assert d["n_drifted"] == 1 and d["share"] == 0.5 and d["drifted"] is True


def drift_schema():
    from encore import schemas

    return schemas.DRIFT_REPORT


def test_golden_values_on_events(spark):
    """Values pinned in the blueprint for sf0.01 events (reference = before 2024-01-15)."""
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    ref, cur = ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)
    assert drift.ecdf_stats(ref, cur, "value").first()["wasserstein"] == pytest.approx(0.7601607133788, abs=1e-9)
    assert drift.js_distance(ref, cur, "event_type").first()["js"] == pytest.approx(0.0069087642368, abs=1e-10)
    chi = drift.chi_square(ref, cur, "event_type").first()
    assert chi["chi2"] == pytest.approx(0.9503203466661, abs=1e-9) and chi["dof"] == 4
    assert chi["p_value"] == pytest.approx(0.9172, abs=5e-5)
    small = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ks = drift.ecdf_stats(small.where("event_type = 'click'"), small.where("event_type = 'view'"), "value").first()["ks"]
    assert ks == pytest.approx(0.0646403242148, abs=1e-10)


def test_chi_square_matches_spark_ml(spark):
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    ref, cur = ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)
    mine = drift.chi_square(ref, cur, "event_type").first()
    labelled = ev.withColumn("side", (F.col("ts") >= cut).cast("double"))
    idx = StringIndexer(inputCol="event_type", outputCol="cat").fit(labelled).transform(labelled)
    vec = VectorAssembler(inputCols=["cat"], outputCol="features").transform(idx)
    ml = ChiSquareTest.test(vec, "features", "side").first()
    assert mine["chi2"] == pytest.approx(ml["statistics"][0], rel=1e-9)
    assert mine["p_value"] == pytest.approx(ml["pValues"][0], abs=1e-9)
    assert mine["dof"] == ml["degreesOfFreedom"][0]
