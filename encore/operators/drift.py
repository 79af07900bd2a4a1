"""Distribution drift between a reference and a current table.

All statistics are aggregates over value counts, computed on the cluster:

* counts: each side is scanned once for all report columns; its rows are
  exploded into ``(column, value)`` pairs and counted (partial aggregation
  first, so a value holding a large share of rows is summed map-side); counts
  of batches add up, so a reference is counted once and kept (``value_counts``);
* per-column side totals are a table of one row per column (bounded by the
  number of columns, broadcast);
* the empirical CDFs come from running totals over range-partitioned value
  counts, per column (``prefix.running_totals``), never from one ordered
  partition.

Statistics (``score`` of the report):

* ``wasserstein``: integral of |F_ref - F_cur| over the value axis, divided
  by ``max(stddev_pop(ref), 0.001)`` (drift when >= 0.1)
* ``jensenshannon``: sqrt(1/2 KL(p||m) + 1/2 KL(q||m)), natural log, over
  the union of categories (drift when >= 0.1)
* ``ks``: p-value of the two-sample Kolmogorov-Smirnov statistic, from the
  asymptotic Kolmogorov distribution (drift when < 0.05)
* ``chisquare``: p-value of Pearson's chi-square test of independence of
  value and side over the 2 x k table, df = k - 1 (drift when < 0.05)

NaN and infinities are not values: they are left out of the counts of a
numeric column, as nulls are. An empty side gives a null score, and a null
or NaN score is no decision, hence no drift.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.operators.prefix import running_totals
from encore.session import scratch_path

# Method thresholds, dataset share and std floor.
THRESHOLDS = {"wasserstein": 0.1, "jensenshannon": 0.1, "ks": 0.05, "chisquare": 0.05}
DATASET_SHARE = 0.5
STD_FLOOR = 0.001
KS_TERMS = 20
SERIES_DOF = 400
SIMPSON_STEPS = 2048
LARGE = {"numeric": "wasserstein", "categorical": "jensenshannon"}
SMALL = {"numeric": "ks", "categorical": "chisquare"}


PROFILE = "column string, num double, cat string, n long"


def value_counts(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``column, num, cat, n``: rows of each non-null value, all columns at once (and for each ``by``).

    Numeric columns carry their value in ``num`` (double), categorical ones
    in ``cat`` (text; distinct values stay distinct). Counts of parts of a
    table add up to those of the whole (``merged_counts``).
    """

    def finite(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.when(F.abs(v) < float("inf"), v)  # NaN sorts above infinity

    cells = [F.struct(F.lit(c).alias("column"), finite(c).alias("num"), F.lit(None).cast("string").alias("cat")) for c in numeric]
    cells += [F.struct(F.lit(c).alias("column"), F.lit(None).cast("double").alias("num"), F.col(c).cast("string").alias("cat")) for c in categorical]
    long = df.select(*by, F.explode(F.array(*cells)).alias("_e")).select(*by, "_e.column", "_e.num", "_e.cat")
    there = long.where(F.col("num").isNotNull() | F.col("cat").isNotNull())
    return there.groupBy(*by, "column", "num", "cat").agg(F.count(F.lit(1)).alias("n"))


def merged_counts(first: DataFrame, *more: DataFrame) -> DataFrame:
    """``column, num, cat, n`` of several ``value_counts`` together."""
    every = first.select("column", "num", "cat", "n")
    for m in more:
        every = every.unionByName(m.select("column", "num", "cat", "n"))
    return every.groupBy("column", "num", "cat").agg(F.sum("n").alias("n"))


def paired_counts(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """``column, num, cat, r, c`` from the ``value_counts`` of both sides.

    Written to the shared checkpoint folder and read back: several
    statistics read the counts, so each side is counted once and lineage is cut.
    """
    zero = F.lit(0).cast("bigint")
    tagged = ref.select("column", "num", "cat", F.col("n").alias("_r"), zero.alias("_c")).unionByName(
        cur.select("column", "num", "cat", zero.alias("_r"), F.col("n").alias("_c"))
    )
    counts = tagged.groupBy("column", "num", "cat").agg(F.sum("_r").cast("bigint").alias("r"), F.sum("_c").cast("bigint").alias("c"))
    path = scratch_path(ref.sparkSession, "drift-counts")
    counts.write.mode("overwrite").parquet(path)
    return ref.sparkSession.read.parquet(path)


def long_counts(ref: DataFrame, cur: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """``column, num, cat, r, c``: rows per non-null value and side, all columns at once."""
    return paired_counts(value_counts(ref, numeric, categorical), value_counts(cur, numeric, categorical))


#: Accuracy of the quantile sketches (log2 of their size): rank errors of about a third of a percent.
SKETCH_K = 800


def numeric_profile(df: DataFrame, numeric: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``column, n, n_null, low, high, sketch`` of numeric columns (and for each ``by``):
    a summary of bounded size, whose quantile sketches merge (``merged_profile``)."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in numeric]
    long = df.select(*by, F.explode(F.array(*cells)).alias("_e")).select(*by, "_e.column", "_e.x")
    finite = F.when(F.abs("x") < float("inf"), F.col("x"))
    return long.groupBy(*by, "column").agg(
        F.count(finite).alias("n"), F.count_if(finite.isNull()).alias("n_null"), F.min(finite).alias("low"), F.max(finite).alias("high"),
        F.kll_sketch_agg_double(finite, F.lit(SKETCH_K)).alias("sketch"),
    )


def merged_profile(profile: DataFrame) -> DataFrame:
    """``numeric_profile`` of the whole from those of its parts."""
    return profile.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def profile_quantiles(profile: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``column, n, n_null, low, high, quantiles``: approximate values at ``shares``, null without values."""
    at = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(s)) for s in shares]))
    return profile.select("column", "n", "n_null", "low", "high", F.when(F.col("n") > 0, at).alias("quantiles"))


def _columns(spark, cols: Sequence[str]) -> DataFrame:
    """One row per report column, so a column with no values still gets a row."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("column"))


def _xlogy(x: Column, y: Column) -> Column:
    return F.when(x > 0, x * F.log(x / y)).otherwise(F.lit(0.0))


def categorical_stats(counts: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column, n_categories, js, chi2, dof, p_value`` from ``long_counts``."""
    cat = counts.where(F.col("cat").isNotNull() & F.col("column").isin(*cols)).select("column", "r", "c")
    tot = cat.groupBy("column").agg(F.sum("r").cast("double").alias("_nr"), F.sum("c").cast("double").alias("_nc"))
    j = cat.join(F.broadcast(tot), "column")
    nr, nc = F.col("_nr"), F.col("_nc")
    p, q = F.try_divide(F.col("r"), nr), F.try_divide(F.col("c"), nc)
    m = (p + q) / 2
    n, t = nr + nc, F.col("r") + F.col("c")
    er, ec = F.try_divide(nr * t, n), F.try_divide(nc * t, n)
    cell = F.try_divide((F.col("r") - er) ** 2, er) + F.try_divide((F.col("c") - ec) ** 2, ec)
    agg = j.groupBy("column").agg(
        F.count(F.lit(1)).alias("_k"),
        F.sum(_xlogy(p, m) + _xlogy(q, m)).alias("_js2"),
        F.sum(cell).alias("_chi2"),
        ((F.max(nr) > 0) & (F.max(nc) > 0)).alias("_valid"),
    )
    out = _columns(counts.sparkSession, cols).join(F.broadcast(agg), "column", "left")
    k = F.coalesce(F.col("_k"), F.lit(0)).cast("bigint")
    valid = F.coalesce(F.col("_valid"), F.lit(False))
    return out.select(
        "column",
        k.alias("n_categories"),
        F.when(valid, F.sqrt(F.greatest(F.col("_js2") / 2, F.lit(0.0)))).alias("js"),
        F.when(valid, F.col("_chi2")).alias("chi2"),
        (k - 1).alias("dof"),
        F.when(valid & (k > 1), chi2_sf(F.col("_chi2"), k - 1)).alias("p_value"),
    )


def numeric_stats(counts: DataFrame, cols: Sequence[str], n_parts: int | None = None) -> DataFrame:
    """``column, n_ref, n_cur, ks, ks_p_value, wasserstein, std_ref, wasserstein_norm``.

    The CDFs come from per-column running totals; the reference standard
    deviation is taken from the same counts (weighted, two passes: mean,
    then squared deviations), so the reference rows are not read again.
    """
    num = counts.where(F.col("num").isNotNull() & F.col("column").isin(*cols)).select(
        "column", F.col("num").alias("value"), "r", "c"
    )
    cdf = running_totals(num, "value", ["r", "c"], n_parts, group="column")
    nr, nc = F.col("tot_r").cast("double"), F.col("tot_c").cast("double")
    diff = F.abs(F.try_divide(F.col("cum_r"), nr) - F.try_divide(F.col("cum_c"), nc))
    gap = F.coalesce(F.col("next_key") - F.col("value"), F.lit(0.0))
    stats = cdf.groupBy("column").agg(
        F.max(nr).alias("_nr"), F.max(nc).alias("_nc"), F.max(diff).alias("_ks"), F.sum(diff * gap).alias("_w")
    )
    mean = num.groupBy("column").agg(F.try_divide(F.sum(F.col("r") * F.col("value")), F.sum("r")).alias("_mean"))
    var = (
        num.join(F.broadcast(mean), "column")
        .groupBy("column")
        .agg(F.try_divide(F.sum(F.col("r") * (F.col("value") - F.col("_mean")) ** 2), F.sum("r")).alias("_var"))
    )
    base = (
        _columns(counts.sparkSession, cols)
        .join(F.broadcast(stats), "column", "left")
        .join(F.broadcast(var), "column", "left")
        .select(
            "column",
            F.coalesce("_nr", F.lit(0.0)).alias("_nr"),
            F.coalesce("_nc", F.lit(0.0)).alias("_nc"),
            "_ks",
            "_w",
            F.sqrt(F.greatest(F.col("_var"), F.lit(0.0))).alias("std_ref"),
        )
    )
    valid = (F.col("_nr") > 0) & (F.col("_nc") > 0)
    base = base.select(
        "column", "_nr", "_nc", F.when(valid, F.col("_ks")).alias("ks"), F.when(valid, F.col("_w")).alias("wasserstein"), "std_ref"
    )
    lam = F.sqrt(F.col("_nr") * F.col("_nc") / (F.col("_nr") + F.col("_nc"))) * F.col("ks")
    return base.select(
        "column",
        F.col("_nr").cast("bigint").alias("n_ref"),
        F.col("_nc").cast("bigint").alias("n_cur"),
        "ks",
        F.when(F.col("ks").isNotNull(), kolmogorov_sf(lam)).alias("ks_p_value"),
        "wasserstein",
        "std_ref",
        (F.col("wasserstein") / F.greatest(F.col("std_ref"), F.lit(STD_FLOOR))).alias("wasserstein_norm"),
    )


def ecdf_stats(ref: DataFrame, cur: DataFrame, col: str, n_parts: int | None = None) -> DataFrame:
    """``n_ref, n_cur, ks, ks_p_value, wasserstein, std_ref, wasserstein_norm`` of one column."""
    return numeric_stats(long_counts(ref, cur, [col], []), [col], n_parts).drop("column")


def js_distance(ref: DataFrame, cur: DataFrame, col: str) -> DataFrame:
    """``n_categories, js`` over the union of categories."""
    return categorical_stats(long_counts(ref, cur, [], [col]), [col]).select("n_categories", "js")


def chi_square(ref: DataFrame, cur: DataFrame, col: str) -> DataFrame:
    """``n_categories, chi2, dof, p_value`` of the 2 x k independence test."""
    return categorical_stats(long_counts(ref, cur, [], [col]), [col]).select("n_categories", "chi2", "dof", "p_value")


def chi2_sf(x: Column, dof: Column) -> Column:
    """Upper tail Q(a, z) of the chi-square distribution, a = dof/2, z = x/2.

    Up to ``SERIES_DOF`` degrees it is 1 - P(a, z) with the series
    P(a, z) = sum_n exp((a+n) ln z - z - ln Gamma(a+n+1)) in log space; z
    beyond the range where Q is above 1e-300 gives 0, so the series is short.
    Above, the density is integrated over t = a + x sqrt(a) by Simpson's rule
    on a fixed number of points: there it is nearly normal, its logarithm
    needs only log1p and Stirling's correction, and the cost does not grow
    with the degrees of freedom.
    """
    a = dof.cast("double") / 2
    z = x / 2
    far = z > 2000
    # bounded arguments, since both branches of a condition may be evaluated
    sa, sz = F.least(a, F.lit(SERIES_DOF / 2)), F.least(z, F.lit(2000.0))
    steps = F.sequence(F.lit(0), (F.ceil(sa) - 1).cast("int"))
    lg = F.aggregate(steps, F.lit(0.0), lambda acc, j: acc + F.log(sa - j)) + F.when(
        F.floor(sa) != sa, F.log(F.sqrt(F.lit(math.pi)))
    ).otherwise(F.lit(0.0))
    n_terms = F.ceil(sz + F.sqrt(sz) * 12 + 40).cast("int")
    lnz = F.log(sz)
    init = F.struct(lg.alias("lg"), F.exp(sa * lnz - sz - lg).alias("s"))
    series = F.aggregate(
        F.sequence(F.lit(1), n_terms),
        init,
        lambda acc, n: F.struct(
            (acc["lg"] + F.log(sa + n)).alias("lg"),
            (acc["s"] + F.exp((sa + n) * lnz - sz - acc["lg"] - F.log(sa + n))).alias("s"),
        ),
    )["s"]
    small = F.when(far, F.lit(0.0)).otherwise(1 - series)
    root = F.sqrt(a)
    low = F.greatest((z - a) / root, F.lit(-13.0))
    step = (13.0 - low) / SIMPSON_STEPS

    def density(i: Column) -> Column:
        at = low + step * i
        weight = F.when((i == 0) | (i == SIMPSON_STEPS), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        return weight * F.exp((a - 1) * F.log1p(at / root) - root * at - 1 / (12 * a))

    total = F.aggregate(F.sequence(F.lit(0), F.lit(SIMPSON_STEPS)), F.lit(0.0), lambda acc, i: acc + density(i))
    large = F.when(low >= 13, F.lit(0.0)).otherwise(total * step / 3 / math.sqrt(2 * math.pi))
    tail = F.when(dof > SERIES_DOF, large).otherwise(small)
    return F.when(x <= 0, F.lit(1.0)).otherwise(F.greatest(F.least(tail, F.lit(1.0)), F.lit(0.0)))


def kolmogorov_sf(lam: Column) -> Column:
    """Q(lambda) of the Kolmogorov distribution, clamped to [0, 1].

    Above 1 the alternating series 2 sum (-1)^(j-1) exp(-2 j^2 lambda^2), below
    its dual 1 - sqrt(2 pi)/lambda sum exp(-(2j-1)^2 pi^2 / (8 lambda^2)):
    each converges within ``KS_TERMS`` terms on its side.
    """
    terms = F.sequence(F.lit(1), F.lit(KS_TERMS))
    # bounded away from zero, since both branches may be evaluated
    safe = F.greatest(lam, F.lit(1e-3))
    dual = F.aggregate(
        terms, F.lit(0.0), lambda acc, j: acc + F.exp(-(2.0 * j - 1) * (2.0 * j - 1) * math.pi**2 / (8 * safe * safe))
    )
    below = 1 - math.sqrt(2 * math.pi) / safe * dual
    series = F.aggregate(
        terms, F.lit(0.0), lambda acc, j: acc + F.pow(F.lit(-1.0), j - 1) * F.exp(-2.0 * j * j * lam * lam)
    )
    value = F.when(lam < 1, below).otherwise(2 * series)
    return F.when(lam <= 0, F.lit(1.0)).otherwise(F.greatest(F.least(value, F.lit(1.0)), F.lit(0.0)))


def _row(method: str, score: Column, threshold: float) -> list[Column]:
    score = F.nanvl(score.cast("double"), F.lit(None).cast("double"))
    drifted = (score < threshold) if method in ("ks", "chisquare") else (score >= threshold)
    return [
        F.col("column"),
        F.lit(method).alias("method"),
        score.alias("score"),
        F.lit(float(threshold)).alias("threshold"),
        F.coalesce(drifted, F.lit(False)).alias("drifted"),
    ]


def column_drift(ref: DataFrame, cur: DataFrame, column: str, method: str, threshold: float | None = None) -> DataFrame:
    """One report row for ``column`` with the given method."""
    numeric = [column] if method in ("wasserstein", "ks") else []
    categorical = [] if numeric else [column]
    if method not in THRESHOLDS:
        raise ValueError(f"unknown drift method {method!r}")
    return _report(long_counts(ref, cur, numeric, categorical), numeric, categorical, method, method, {method: threshold} if threshold is not None else {})


def _report(counts: DataFrame, numeric, categorical, num_method: str, cat_method: str, thresholds: dict) -> DataFrame:
    parts = []
    if numeric:
        score = F.col("wasserstein_norm") if num_method == "wasserstein" else F.col("ks_p_value")
        parts.append(numeric_stats(counts, numeric).select(*_row(num_method, score, thresholds.get(num_method, THRESHOLDS[num_method]))))
    if categorical:
        score = F.col("js") if cat_method == "jensenshannon" else F.col("p_value")
        parts.append(categorical_stats(counts, categorical).select(*_row(cat_method, score, thresholds.get(cat_method, THRESHOLDS[cat_method]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drift_report(
    ref: DataFrame,
    cur: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    size: str = "large",
    thresholds: dict[str, float] | None = None,
) -> DataFrame:
    """``column, method, score, threshold, drifted``: one row per column.

    ``size="large"`` uses the distances, ``"small"`` the p-value tests. Each
    side is scanned once for all columns (``long_counts``).
    """
    return report_from_counts(long_counts(ref, cur, numeric, categorical), numeric, categorical, size, thresholds)


def report_from_counts(
    counts: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    size: str = "large",
    thresholds: dict[str, float] | None = None,
) -> DataFrame:
    """``drift_report`` from ``paired_counts``: no row of either side is read again."""
    methods = LARGE if size == "large" else SMALL
    return _report(counts, list(numeric), list(categorical), methods["numeric"], methods["categorical"], thresholds or {})


def dataset_drift(report: DataFrame, share: float = DATASET_SHARE) -> DataFrame:
    """``n_columns, n_drifted, share, threshold, drifted`` (share >= threshold)."""
    return report.agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.sum(F.col("drifted").cast("int")).cast("bigint").alias("n_drifted"),
    ).select(
        "n_columns",
        "n_drifted",
        (F.col("n_drifted") / F.col("n_columns")).alias("share"),
        F.lit(float(share)).alias("threshold"),
        (F.col("n_drifted") / F.col("n_columns") >= share).alias("drifted"),
    )
