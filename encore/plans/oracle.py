"""DuckDB SQL equal to each registered query (views named after the tables).

Written independently of the Spark plans, as plain SQL with window
functions: global ``row_number`` for the indexes, ``sum() over (order by)``
for CDFs, cross products for the popularity and embedding candidates (fine
for a reference run on small data; the Spark plans avoid all three).
"""

from __future__ import annotations

import re

INT = """(SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
                 CAST(l.l_quantity AS DOUBLE) AS plays, l.l_shipdate AS ts
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

PLAYS = """(SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
                   value AS plays, ts
            FROM events WHERE event_type = 'view')"""


def bucket(keys: str, buckets: int) -> str:
    """``md5`` bucket of ``concat_ws('|', keys)`` (same as functions.hashing)."""
    return f"(('0x' || substr(md5(concat_ws('|', {keys})), 1, 8))::BIGINT % {buckets})"


SPLIT = bucket("CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR)", 100)

USERS = f"""(SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS INTEGER) AS user_idx
            FROM (SELECT DISTINCT user_id FROM {INT} WHERE user_id IS NOT NULL))"""
ITEMS = f"""(SELECT item_id, CAST(row_number() OVER (ORDER BY item_id) - 1 AS INTEGER) AS item_idx
            FROM (SELECT DISTINCT item_id FROM {INT} WHERE item_id IS NOT NULL))"""

# indexed train / validation parts of the stable split
PREP = f"""
  S AS (SELECT *, {SPLIT} AS b FROM {INT}),
  U AS {USERS},
  I AS {ITEMS},
  IDX AS (SELECT u.user_idx, i.item_idx, s.plays, s.b FROM S s JOIN U u USING (user_id) JOIN I i USING (item_id)),
  TRAIN AS (SELECT user_idx, item_idx, plays FROM IDX WHERE b < 60),
  VALID AS (SELECT user_idx, item_idx, plays FROM IDX WHERE b >= 60 AND b < 80)"""


def pop_metrics_cte(k: int, name: str = "PER") -> str:
    """Per-user metrics of the popularity top-k for validation users."""
    return f"""
  POP{k} AS (SELECT item_idx, CAST(row_number() OVER (ORDER BY sum(plays) DESC, item_idx) AS INTEGER) AS rank
             FROM TRAIN GROUP BY item_idx QUALIFY rank <= {k}),
  PRED{k} AS (SELECT v.user_idx, p.rank, p.item_idx FROM (SELECT DISTINCT user_idx FROM VALID) v, POP{k} p),
  TRUTH{k} AS (SELECT DISTINCT user_idx, item_idx FROM VALID),
  SIZES{k} AS (SELECT user_idx, count(*) AS n_truth FROM TRUTH{k} GROUP BY user_idx),
  FLAG{k} AS (SELECT p.user_idx, p.rank, CASE WHEN t.item_idx IS NULL THEN 0 ELSE 1 END AS hit
              FROM PRED{k} p LEFT JOIN TRUTH{k} t USING (user_idx, item_idx)),
  CUM{k} AS (SELECT *, sum(hit) OVER (PARTITION BY user_idx ORDER BY rank) AS c FROM FLAG{k}),
  AGG{k} AS (SELECT user_idx, count(*) AS n_pred,
                    sum(CASE WHEN rank <= {k} THEN hit ELSE 0 END) AS hits,
                    sum(CASE WHEN hit = 1 THEN c / rank ELSE 0 END) AS ap_sum,
                    sum(CASE WHEN hit = 1 AND rank <= {k} THEN c / rank ELSE 0 END) AS apk_sum,
                    sum(CASE WHEN hit = 1 AND rank <= {k} THEN 1 / ln(rank + 1) ELSE 0 END) AS dcg
             FROM CUM{k} GROUP BY user_idx),
  {name} AS (SELECT a.user_idx, CAST(a.n_pred AS BIGINT) AS n_pred, CAST(s.n_truth AS BIGINT) AS n_truth,
                    CAST(a.hits AS BIGINT) AS hits_at_k,
                    a.ap_sum / s.n_truth AS map,
                    a.apk_sum / least(s.n_truth, {k}) AS map_at_k,
                    a.hits / {k} AS precision_at_k,
                    a.dcg / list_sum(list_transform(range(1, least(s.n_truth, {k}) + 1), lambda i: 1 / ln(i + 1))) AS ndcg_at_k,
                    a.hits / s.n_truth AS recall_at_k
             FROM AGG{k} a JOIN SIZES{k} s USING (user_idx))"""


def on_test(cte: str) -> str:
    """The common table expressions of ``pop_metrics_cte`` with the test part as truth."""
    return re.sub(r"\b(POP|PRED|TRUTH|SIZES|FLAG|CUM|AGG|PER)(\d+)", r"T\1\2", cte).replace("VALID", "TESTING")


METRICS = ("map", "map_at_k", "precision_at_k", "ndcg_at_k", "recall_at_k")
R6 = ", ".join(f"round({m}, 6) AS {m}" for m in METRICS)
AVG6 = ", ".join(f"round(avg({m}), 6) AS {m}" for m in METRICS)

# ---------------------------------------------------------------- events as messages
MSG = """(SELECT *, coalesce(event_id % 10, -1) AS dmg,
                 CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
          FROM events)"""

# JSON text as Spark's to_json writes it (null fields omitted)
BODY = """'{' || concat_ws(',',
      CASE WHEN user_id IS NOT NULL THEN '"user_id":' || CAST(user_id AS VARCHAR) END,
      CASE WHEN k IS NOT NULL THEN '"song_id":' || CAST(k AS VARCHAR) END,
      CASE WHEN dmg = 1 THEN '"timestamp":"not-a-time"'
           WHEN ts IS NOT NULL THEN '"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"' END,
      CASE WHEN event_type IS NOT NULL THEN '"event_type":"' || event_type || '"' END,
      CASE WHEN value IS NOT NULL THEN '"plays":' || CAST(value AS VARCHAR) END) || '}'"""

KEPT = f"""(SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, CAST(k AS VARCHAR) AS item_id,
                   value AS plays, ts, event_type
            FROM {MSG} WHERE dmg NOT IN (0, 1) AND event_type = 'view' AND ts IS NOT NULL)"""

QUAR = f"""(SELECT event_id, CASE WHEN dmg = 0 THEN left(body, length(body) - 1) ELSE body END AS value,
                   CASE WHEN dmg = 0 THEN 'malformed' ELSE 'bad_timestamp' END AS reason
            FROM (SELECT *, {BODY} AS body FROM {MSG})
            WHERE dmg = 0 OR (event_type = 'view' AND (dmg = 1 OR ts IS NULL)))"""

KAFKA = f"""SELECT CAST(user_id AS VARCHAR) AS key,
       '{{' || concat_ws(',',
          CASE WHEN user_id IS NOT NULL THEN '"user_id":' || CAST(user_id AS VARCHAR) END,
          CASE WHEN item_id IS NOT NULL THEN '"song_id":' || CAST(item_id AS VARCHAR) END,
          CASE WHEN ts IS NOT NULL THEN '"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"' END,
          '"event_type":"play"',
          CASE WHEN plays IS NOT NULL THEN '"plays":' || CAST(plays AS VARCHAR) END) || '}}' AS value
FROM {PLAYS}"""

# ---------------------------------------------------------------- drift
SIDES = f"""
  P AS {PLAYS},
  R AS (SELECT * FROM P WHERE ts < TIMESTAMP '2024-01-15'),
  C AS (SELECT * FROM P WHERE ts >= TIMESTAMP '2024-01-15')"""


def counts_cte(col: str, cast: str = "") -> str:
    v = f"CAST({col} AS {cast})" if cast else col
    return f"""
  CNT AS (SELECT v AS value, sum(r) AS r, sum(c) AS c
          FROM (SELECT {v} AS v, 1 AS r, 0 AS c FROM R UNION ALL SELECT {v}, 0, 1 FROM C)
          WHERE v IS NOT NULL GROUP BY v),
  TOT AS (SELECT coalesce(sum(r), 0)::DOUBLE AS nr, coalesce(sum(c), 0)::DOUBLE AS nc FROM CNT)"""


ECDF = f"""WITH {SIDES},{counts_cte('plays', 'DOUBLE')},
  CDF AS (SELECT value,
                 sum(r) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cr,
                 sum(c) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cc,
                 lead(value) OVER (ORDER BY value) AS nv
          FROM CNT),
  ST AS (SELECT max(abs(cr / nr - cc / nc)) AS ks,
                sum(abs(cr / nr - cc / nc) * coalesce(nv - value, 0)) AS w
         FROM CDF, TOT),
  E AS (SELECT CAST(nr AS BIGINT) AS n_ref, CAST(nc AS BIGINT) AS n_cur, ks, w AS wasserstein,
               sqrt(nr * nc / (nr + nc)) * ks AS lam,
               (SELECT stddev_pop(CAST(plays AS DOUBLE)) FROM R) AS std_ref
        FROM ST, TOT),
  E2 AS (SELECT *, CASE WHEN lam <= 0.05 THEN 1.0 /* 1 - Q is below 1e-200 here */ ELSE greatest(least(2 * list_sum(list_transform(range(1, 401),
                   lambda j: power(-1.0, j - 1) * exp(-2.0 * j * j * lam * lam))), 1.0), 0.0) END AS ks_p_value,
                wasserstein / greatest(std_ref, 0.001) AS wasserstein_norm
         FROM E)"""


def js_sql(col: str) -> str:
    return f"""WITH {SIDES},{counts_cte(col)},
  T AS (SELECT (CASE WHEN p > 0 THEN p * ln(p / m) ELSE 0 END) + (CASE WHEN q > 0 THEN q * ln(q / m) ELSE 0 END) AS t
        FROM (SELECT r / nr AS p, c / nc AS q, (r / nr + c / nc) / 2 AS m FROM CNT, TOT))
SELECT count(*) AS n_categories, round(sqrt(greatest(sum(t) / 2, 0)), 6) AS js FROM T"""


def js_value(col: str) -> str:
    return f"""(SELECT sqrt(greatest(sum(t) / 2, 0)) FROM (
   WITH {SIDES},{counts_cte(col)}
   SELECT (CASE WHEN p > 0 THEN p * ln(p / m) ELSE 0 END) + (CASE WHEN q > 0 THEN q * ln(q / m) ELSE 0 END) AS t
   FROM (SELECT r / nr AS p, c / nc AS q, (r / nr + c / nc) / 2 AS m FROM CNT, TOT)))"""


def chi_cte(col: str) -> str:
    return f"""WITH {SIDES},{counts_cte(col)},
  X AS (SELECT count(*) AS n_categories,
               sum(power(r - nr * (r + c) / (nr + nc), 2) / (nr * (r + c) / (nr + nc))
                 + power(c - nc * (r + c) / (nr + nc), 2) / (nc * (r + c) / (nr + nc))) AS chi2
        FROM CNT, TOT),
  X2 AS (SELECT n_categories, chi2, CAST(n_categories - 1 AS BIGINT) AS dof, (n_categories - 1) / 2.0 AS a, chi2 / 2 AS z FROM X),
  X3 AS (SELECT *, CASE WHEN chi2 <= 0 THEN 1.0 ELSE greatest(least(1 - list_sum(list_transform(
                   range(0, CAST(ceil(z + sqrt(z) * 12 + 40) AS BIGINT) + 1),
                   lambda n: exp((a + n) * ln(z) - z - lgamma(a + n + 1)))), 1.0), 0.0) END AS p_value
         FROM X2)"""


def chi_p(col: str) -> str:
    return f"(SELECT p_value FROM ({chi_cte(col)} SELECT * FROM X3))"


W_NORM = f"(SELECT wasserstein_norm FROM ({ECDF} SELECT * FROM E2))"
KS_P = f"(SELECT ks_p_value FROM ({ECDF} SELECT * FROM E2))"

REPORT = f"""SELECT * FROM (VALUES
   ('plays', 'wasserstein', {W_NORM}, 0.1::DOUBLE),
   ('user_id', 'jensenshannon', {js_value('user_id')}, 0.1::DOUBLE),
   ('item_id', 'jensenshannon', {js_value('item_id')}, 0.1::DOUBLE)) t("column", method, score, threshold)"""

REPORT_SMALL = f"""SELECT * FROM (VALUES
   ('plays', 'ks', {KS_P}, 0.05::DOUBLE),
   ('user_id', 'chisquare', {chi_p('user_id')}, 0.05::DOUBLE),
   ('item_id', 'chisquare', {chi_p('item_id')}, 0.05::DOUBLE)) t("column", method, score, threshold)"""


def report_out(sql: str, below: bool) -> str:
    cmp = "score < threshold" if below else "score >= threshold"
    return f"""SELECT "column", method, round(score, 6) AS score, threshold, coalesce({cmp}, false) AS drifted
FROM ({sql})"""


# ---------------------------------------------------------------- embeddings top-k
TOPK = """(SELECT user_id, item_id, score, CAST(rank AS INTEGER) AS rank FROM (
   SELECT u.vec_id AS user_id, i.vec_id AS item_id,
          list_dot_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) AS score,
          row_number() OVER (PARTITION BY u.vec_id
                             ORDER BY list_dot_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) DESC,
                                      i.vec_id) AS rank
   FROM embeddings u, embeddings i WHERE u.vec_id % 10 = 0 AND i.vec_id % 10 <> 0) WHERE rank <= 10)"""


def chunked(rel: str, item_expr: str, key_exprs: str, out: str, distinct: bool) -> str:
    src = f"(SELECT DISTINCT user_idx, item_idx FROM {rel})" if distinct else rel
    return f"""(SELECT user_idx, CAST(h % nch AS INTEGER) AS chunk, list_sort(list({item_expr})) AS {out}
   FROM (SELECT *, {bucket(key_exprs, 4294967296)} AS h,
                CAST(ceil(count(*) OVER (PARTITION BY user_idx) / 10000) AS BIGINT) AS nch
         FROM {src})
   GROUP BY user_idx, chunk)"""


HISTORY = chunked("TRAIN", "item_idx", "CAST(item_idx AS VARCHAR)", "items", True)
TRUTH_LISTS = chunked(
    "(SELECT *, row_number() OVER (PARTITION BY user_idx, item_idx, plays) AS copy FROM VALID)",
    "CAST(item_idx AS DOUBLE)",
    "CAST(CAST(item_idx AS DOUBLE) AS VARCHAR), CAST(plays AS VARCHAR), CAST(copy AS VARCHAR)",
    "true_items",
    False,
)

# ---------------------------------------------------------------- factorisation of rank two
def als_start(name: str, ratings: str, known: str | None = None) -> str:
    """Unit vectors of two numbers drawn by id, or those of ``known``."""

    def draw(j: int) -> str:
        return f"((('0x' || md5('42|' || id || '|{j}')[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)"

    drawn = f"SELECT id, {draw(0)} AS a, {draw(1)} AS b FROM (SELECT DISTINCT u AS id FROM {ratings})"
    join = f"LEFT JOIN {known} k USING (id)" if known else ""
    x, y = ("coalesce(k.x, a / sqrt(a * a + b * b))", "coalesce(k.y, b / sqrt(a * a + b * b))") if known else ("a / sqrt(a * a + b * b)", "b / sqrt(a * a + b * b)")
    return f"{name} AS MATERIALIZED (SELECT id, {x} AS x, {y} AS y FROM ({drawn}) {join})"


def als_half(name: str, ratings: str, key: str, other: str, vectors: str) -> str:
    """One half step: the two by two systems, solved by Cramer's rule."""
    return f"""{name} AS MATERIALIZED (
      SELECT id, (px * yy - py * xy) / (xx * yy - xy * xy) AS x, (py * xx - px * xy) / (xx * yy - xy * xy) AS y FROM (
        SELECT r.{key} AS id, coalesce(sum(40.0 * abs(r) * x * x), 0) + any_value(gxx) + 0.01 * count(*) FILTER (r > 0 AND x IS NOT NULL) AS xx,
               coalesce(sum(40.0 * abs(r) * x * y), 0) + any_value(gxy) AS xy,
               coalesce(sum(40.0 * abs(r) * y * y), 0) + any_value(gyy) + 0.01 * count(*) FILTER (r > 0 AND x IS NOT NULL) AS yy,
               coalesce(sum((1 + 40.0 * r) * x) FILTER (r > 0), 0) AS px, coalesce(sum((1 + 40.0 * r) * y) FILTER (r > 0), 0) AS py
        FROM {ratings} r LEFT JOIN {vectors} v ON v.id = r.{other}, (SELECT sum(x * x) AS gxx, sum(x * y) AS gxy, sum(y * y) AS gyy FROM {vectors})
        GROUP BY r.{key}))"""


def als_rounds(prefix: str, ratings: str, rounds: int, known: str | None = None) -> str:
    """Common table expressions of a fit: ``<prefix>U<n>`` and ``<prefix>I<n>`` of each round."""
    steps = [als_start(f"{prefix}U0", ratings, known)]
    for n in range(1, rounds + 1):
        steps.append(als_half(f"{prefix}I{n}", ratings, "i", "u", f"{prefix}U{n - 1}"))
        steps.append(als_half(f"{prefix}U{n}", ratings, "u", "i", f"{prefix}I{n}"))
    return ", ".join(steps)


def als_pairs(name: str, rows: str) -> str:
    return f"{name} AS MATERIALIZED (SELECT user_idx::BIGINT AS u, item_idx::BIGINT AS i, sum(plays) AS r FROM {rows} GROUP BY 1, 2)"


ALS_FIT = f"{als_pairs('R', 'TRAIN')}, {als_rounds('A', 'R', 3)}"


def als_out(kind: str, name: str) -> str:
    return f"SELECT '{kind}' AS kind, id, round(x, 6) AS f0, round(y, 6) AS f1 FROM {name}"


SQL: dict[str, str] = {
    "scan_interactions": f"SELECT * FROM {INT}",
    "index_users": f"SELECT * FROM {USERS}",
    "index_items": f"SELECT * FROM {ITEMS}",
    "index_interactions": f"""
        SELECT u.user_idx, i.item_idx, t.plays
        FROM {INT} t JOIN {USERS} u USING (user_id) JOIN {ITEMS} i USING (item_id)""",
    "split_train": f"SELECT * FROM {INT} WHERE {SPLIT} < 60",
    "split_validation": f"SELECT * FROM {INT} WHERE {SPLIT} >= 60 AND {SPLIT} < 80",
    "split_test": f"SELECT * FROM {INT} WHERE {SPLIT} >= 80",
    "hash_sample": f"""SELECT * FROM {INT}
        WHERE {bucket('CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR)', 10000)} < 1000""",
    "recent_window": f"SELECT * FROM {INT} WHERE ts >= (SELECT max(ts) FROM {INT}) - INTERVAL 30 DAY",
    "reference_window": f"""WITH {PREP}
        SELECT user_idx, item_idx, plays FROM IDX
        WHERE {bucket('CAST(user_idx AS VARCHAR), CAST(item_idx AS VARCHAR), CAST(plays AS VARCHAR)', 10000)} < 1000""",
    "reference_recent": f"SELECT * FROM {INT} WHERE ts >= TIMESTAMP '1997-01-01' - INTERVAL 30 DAY",
    "reference_all": f"SELECT * FROM {INT}",
    "index_item_mapping": f"""
        SELECT t.item_id, t.track_id, i.item_idx
        FROM (SELECT DISTINCT l_partkey AS item_id, l_suppkey AS track_id FROM lineitem) t
        LEFT JOIN {ITEMS} i USING (item_id)""",
    "index_metadata": f"""
        SELECT p.p_partkey AS item_id, p.p_name, p.p_brand, p.p_type, p.p_size, p.p_retailprice, i.item_idx
        FROM part p LEFT JOIN {ITEMS} i ON p.p_partkey = i.item_id""",
    "filter_plays": f"SELECT * FROM {PLAYS}",
    "parse_events": f"SELECT * FROM {KEPT}",
    "quarantine_events": f"SELECT * FROM {QUAR}",
    "cast_interactions": f"""SELECT event_id, TRY_CAST(user_id AS INTEGER) AS user_id,
        TRY_CAST(item_id AS INTEGER) AS item_id, TRY_CAST(plays AS DOUBLE) AS plays FROM {KEPT}""",
    "to_kafka_records": KAFKA,
    "daily_partition_counts": f"""SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS dt, count(*) AS n_rows
        FROM {PLAYS} GROUP BY 1""",
    "latest_batch": f"""SELECT user_id, item_id, plays, ts FROM {PLAYS}
        WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM {PLAYS})""",
    "latest_model_version": f"""WITH {PREP}, TESTING AS (SELECT user_idx, item_idx, plays FROM IDX WHERE b >= 80),
          {", ".join(pop_metrics_cte(k, f"PER{k}").strip() + ", " + on_test(pop_metrics_cte(k, f"PER{k}").strip()) for k in (5, 10, 20))},
          RUNS AS ({" UNION ALL ".join(f"SELECT {v} AS version, '{t}' AS training, {i} AS run_id, {k} AS k, avg(map) AS map FROM {x}PER{k}"
                                       for v, t, x in ((1, "first", ""), (2, "second", "T")) for i, k in enumerate((5, 10, 20)))}),
          BEST AS (SELECT * FROM RUNS QUALIFY row_number() OVER (PARTITION BY training ORDER BY map DESC, run_id) = 1)
        SELECT CAST(version AS INTEGER) AS version, training, CAST(run_id AS INTEGER) AS run_id, CAST(k AS INTEGER) AS k, round(map, 6) AS map,
               'models/training=' || training || '/run=' || run_id AS path, version = 2 AS is_newest FROM BEST""",
    "daily_plays": f"""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n_events,
        round(sum(plays), 6) AS plays FROM {PLAYS} GROUP BY 1""",
    "distinct_users": f"SELECT DISTINCT user_id FROM {INT} WHERE user_id IS NOT NULL",
    "distinct_items": f"SELECT DISTINCT item_id FROM {INT} WHERE item_id IS NOT NULL",
    "user_item_plays": f"""SELECT user_id, item_id, round(sum(plays), 6) AS plays, count(*) AS n_events
        FROM {INT} GROUP BY 1, 2""",
    "ground_truth_lists": f"WITH {PREP} SELECT * FROM {TRUTH_LISTS}",
    "user_history": f"WITH {PREP} SELECT * FROM {HISTORY}",
    "user_history_all": f"""WITH {PREP}, H AS {HISTORY}
        SELECT u.user_idx, coalesce(h.chunk, 0) AS chunk, coalesce(h.items, []::INTEGER[]) AS items
        FROM U u LEFT JOIN H h USING (user_idx)""",
    "unseen_items": f"""WITH {PREP}, {pop_metrics_cte(10).strip()}
        SELECT p.user_idx, p.rank, p.item_idx FROM PRED10 p
        WHERE NOT EXISTS (SELECT 1 FROM TRAIN t WHERE t.user_idx = p.user_idx AND t.item_idx = p.item_idx)""",
    "user_history_bitmaps": f"""WITH {PREP} SELECT user_idx, CAST(1 + item_idx // 32768 AS BIGINT) AS bucket, count(DISTINCT item_idx) AS n_items
        FROM TRAIN GROUP BY 1, 2""",
    "unseen_by_bitmaps": f"""WITH {PREP}, {pop_metrics_cte(10).strip()}
        SELECT p.user_idx, p.rank, p.item_idx FROM PRED10 p
        WHERE NOT EXISTS (SELECT 1 FROM TRAIN t WHERE t.user_idx = p.user_idx AND t.item_idx = p.item_idx)""",
    "union_history": f"""SELECT user_id, item_id, plays, ts FROM {INT} WHERE {SPLIT} < 60
        UNION ALL SELECT user_id, item_id, plays, ts FROM {PLAYS}""",
    "ranking_metrics_per_user": f"""WITH {PREP}, {pop_metrics_cte(10).strip()}
        SELECT user_idx, n_pred, n_truth, hits_at_k, {R6} FROM PER""",
    "ranking_metrics": f"""WITH {PREP}, {pop_metrics_cte(10).strip()}
        SELECT count(*) AS users_scored, {AVG6} FROM PER""",
    "best_run": f"""WITH {PREP}, {pop_metrics_cte(5, 'PER5').strip()}, {pop_metrics_cte(10, 'PER10').strip()},
          {pop_metrics_cte(20, 'PER20').strip()},
          RUNS AS (SELECT 0 AS run_id, 5 AS k, count(*) AS users_scored, avg(map) AS map, avg(precision_at_k) AS precision_at_k FROM PER5
                   UNION ALL SELECT 1, 10, count(*), avg(map), avg(precision_at_k) FROM PER10
                   UNION ALL SELECT 2, 20, count(*), avg(map), avg(precision_at_k) FROM PER20)
        SELECT CAST(run_id AS INTEGER) AS run_id, CAST(k AS INTEGER) AS k, users_scored,
               round(map, 6) AS map, round(precision_at_k, 6) AS precision_at_k
        FROM RUNS ORDER BY map DESC, run_id LIMIT 1""",
    "topk_for_users": f"SELECT user_id, item_id, round(score, 6) AS score, rank FROM {TOPK}",
    "recommendation_ranks": f"SELECT user_id, rank, item_id, round(score, 6) AS score FROM {TOPK}",
    "recommendation_ids": f"SELECT user_id, list(item_id ORDER BY rank) AS item_ids FROM {TOPK} GROUP BY user_id",
    "drift_ks_plays": f"{ECDF} SELECT n_ref, n_cur, round(ks, 6) AS ks, round(ks_p_value, 6) AS ks_p_value FROM E2",
    "drift_wasserstein_plays": f"""{ECDF} SELECT round(wasserstein, 6) AS wasserstein, round(std_ref, 6) AS std_ref,
        round(wasserstein_norm, 6) AS wasserstein_norm FROM E2""",
    "drift_js_user": js_sql("user_id"),
    "drift_js_item": js_sql("item_id"),
    "drift_chisquare_item": f"""{chi_cte('item_id')}
        SELECT n_categories, round(chi2, 6) AS chi2, dof, round(p_value, 6) AS p_value FROM X3""",
    "drift_report": report_out(REPORT, below=False),
    "drift_report_small": report_out(REPORT_SMALL, below=True),
    "drift_dataset": f"""SELECT count(*) AS n_columns, CAST(sum(CAST(drifted AS INTEGER)) AS BIGINT) AS n_drifted,
        round(sum(CAST(drifted AS INTEGER)) / count(*), 6) AS share, 0.5::DOUBLE AS threshold,
        sum(CAST(drifted AS INTEGER)) / count(*) >= 0.5 AS drifted
        FROM ({report_out(REPORT, below=False)})""",
    "stream_plays": f"SELECT * FROM {KEPT}",
    "stream_daily_plays": f"""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n_events,
        round(sum(plays), 6) AS plays FROM {PLAYS} GROUP BY 1""",
    "stream_daily": f"""SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS dt, count(*) AS n_rows
        FROM {KEPT} GROUP BY 1""",
    "drift_report_merged": report_out(REPORT, below=False),
    "column_profile": f"""SELECT "column", count(v) AS n, count(*) FILTER (v IS NULL) AS n_null, round(min(v), 6) AS low, round(max(v), 6) AS high FROM (
          SELECT unnest([{{'column': 'plays', 'v': plays}}, {{'column': 'user_id', 'v': user_id::DOUBLE}}, {{'column': 'item_id', 'v': item_id::DOUBLE}}], recursive := true)
          FROM {PLAYS}) GROUP BY 1""",
    # nothing tells a message without id from another one: both stay
    "stream_resent": f"SELECT * FROM {KEPT} UNION ALL SELECT * FROM {KEPT} WHERE event_id IS NULL",
    "als_rank_two": f"WITH {PREP}, {ALS_FIT} {als_out('user', 'AU3')} UNION ALL {als_out('item', 'AI3')}",
    "als_fold_in": f"""WITH {PREP}, {ALS_FIT}, {als_pairs('N', 'VALID')}, {als_half('F', 'N', 'u', 'i', 'AI3')} {als_out('new', 'F')}""",
    "als_warm_refit": f"""WITH {PREP}, {ALS_FIT}, {als_pairs('W', "(SELECT * FROM TRAIN UNION ALL SELECT * FROM VALID)")}, {als_rounds('B', 'W', 1, 'AU3')}
          {als_out('user', 'BU1')} UNION ALL {als_out('item', 'BI1')}""",
}
