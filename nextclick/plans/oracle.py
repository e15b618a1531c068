"""DuckDB oracle SQL for the registered queries (views: the driver tables).

The SQL is written independently of the Spark plans: sessions stay flat
(one row per interaction with its normalised position), the truth is found
by explode + join + ``row_number``, neighbour lists by a full pairwise
scoring. Renderings match ``render``: times as
``%Y-%m-%d %H:%M:%S.%f``, lists as comma-joined strings, doubles rounded.
"""

from __future__ import annotations

TF = "'%Y-%m-%d %H:%M:%S.%f'"

F1_FLAT = """
  SELECT CAST(user_id AS BIGINT) AS user_id,
         CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
         CAST(props ->> '$.k' AS BIGINT) AS vacancy_id,
         CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 END AS action_type,
         ts AS action_dt
  FROM events WHERE event_type IN ('purchase', 'view', 'click')"""


def f2_flat(tie_times: bool = False) -> str:
    dt = "l_shipdate" if tie_times else "l_shipdate + to_seconds(pos)"
    return f"""
  SELECT o_custkey AS user_id, CAST(o_orderkey AS VARCHAR) AS session_id, l_partkey AS vacancy_id,
         CASE l_returnflag WHEN 'R' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS action_type,
         {dt} AS action_dt
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
                                     ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos
        FROM lineitem) li
  JOIN orders ON l_orderkey = o_orderkey"""


F1 = (F1_FLAT, ("2024-01-01", "2024-01-16"), ("2024-01-16", "2024-01-31"))
F2 = (f2_flat(), ("1995-01-01", "1998-01-01"), ("1998-01-01", "2002-01-01"))
F1_HOT = (F1_FLAT.replace("SELECT CAST(user_id AS BIGINT) AS user_id", "SELECT CAST(CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS BIGINT) AS user_id", 1),
          F1[1], F1[2])
F2T = (f2_flat(True), ("1995-01-01", "1998-01-01"), ("1998-01-01", "2002-01-01"))


def sessions_ctes(flat: str) -> str:
    """fx: flat rows; fxn: + normalised position; fxs: one row per session."""
    return f"""
fx AS ({flat}),
fxn AS (SELECT *, row_number() OVER (PARTITION BY user_id, session_id
                                     ORDER BY action_dt, vacancy_id, action_type) AS pos FROM fx),
fxs AS (SELECT user_id, session_id, min(action_dt) AS session_dt, count(*) AS n_actions,
               string_agg(CAST(vacancy_id AS VARCHAR), ',' ORDER BY pos) AS items,
               string_agg(CAST(action_type AS VARCHAR), ',' ORDER BY pos) AS actions,
               string_agg(strftime(action_dt, {TF}), ',' ORDER BY pos) AS times
        FROM fxn GROUP BY user_id, session_id)"""


def flow_ctes(fixture) -> str:
    """Sessions, split, truth, train/test interactions, continue-search."""
    flat, (ts, te), (vs, ve) = fixture
    return "WITH " + sessions_ctes(flat) + f""",
train_s AS (SELECT * FROM fxs WHERE session_dt >= TIMESTAMP '{ts}' AND session_dt < TIMESTAMP '{te}'),
val_s AS (SELECT * FROM fxs WHERE session_dt >= TIMESTAMP '{vs}' AND session_dt < TIMESTAMP '{ve}'),
ranked AS (SELECT *, rank() OVER (PARTITION BY user_id ORDER BY session_dt)
                     + (count(*) OVER (PARTITION BY user_id, session_dt) - 1) / 2.0::DOUBLE AS val_session_rank
           FROM val_s),
resp AS (SELECT r.user_id, r.session_id, r.val_session_rank, r.session_dt, x.vacancy_id, x.action_dt
         FROM ranked r JOIN fxn x USING (user_id, session_id)
         WHERE r.val_session_rank > 1 AND x.action_type = 1),
tgt AS (SELECT * FROM resp
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY action_dt, vacancy_id, session_id) = 1),
truth AS (SELECT h.user_id, h.session_id, h.val_session_rank, t.vacancy_id AS target,
                 t.session_dt AS target_dt, h.session_dt, h.items, h.n_actions
          FROM ranked h JOIN tgt t ON h.user_id = t.user_id AND h.val_session_rank = t.val_session_rank - 1
          WHERE h.n_actions BETWEEN 2 AND 29),
train_i AS (SELECT x.* FROM fxn x JOIN train_s USING (user_id, session_id)),
test_i AS (SELECT x.* FROM fxn x JOIN (SELECT user_id, session_id FROM truth) USING (user_id, session_id)),
cs_rows AS (SELECT user_id, vacancy_id, action_dt,
                   CASE action_type WHEN 1 THEN -5.0 WHEN 2 THEN 1.0 WHEN 3 THEN 3.0 END AS w
            FROM train_i WHERE user_id IN (SELECT user_id FROM test_i)
            UNION ALL
            SELECT user_id, vacancy_id, action_dt,
                   CASE action_type WHEN 1 THEN -5.0 WHEN 2 THEN 1.0 WHEN 3 THEN 3.0 END AS w
            FROM test_i),
cs_best AS (SELECT * FROM cs_rows
            QUALIFY row_number() OVER (PARTITION BY user_id, vacancy_id ORDER BY w DESC, action_dt DESC) = 1),
cs AS (SELECT user_id, vacancy_id,
              ln(dense_rank() OVER (PARTITION BY user_id ORDER BY action_dt DESC)) AS score FROM cs_best),
seen AS (SELECT DISTINCT user_id, vacancy_id FROM train_i WHERE action_type = 1),
kept AS (SELECT * FROM cs WHERE NOT EXISTS (
           SELECT 1 FROM seen WHERE seen.user_id = cs.user_id AND seen.vacancy_id = cs.vacancy_id)),
ranked_c AS (SELECT user_id, vacancy_id,
                    row_number() OVER (PARTITION BY user_id ORDER BY score, vacancy_id) AS pos FROM kept),
packed AS (SELECT user_id, string_agg(CAST(vacancy_id AS VARCHAR), ',' ORDER BY pos) AS predictions,
                  count(*) AS n_predictions
           FROM ranked_c WHERE pos <= 100 GROUP BY user_id)"""


def metrics_sql(truth: str, ranked: str, k: str = "100", target: str = "target") -> str:
    cut = f"AND r.pos <= {k}" if k else ""
    return f"""
SELECT round(avg(coalesce(1.0::DOUBLE / h.pos, 0.0)), 6) AS mrr,
       round(avg(CASE WHEN h.pos IS NULL THEN 0.0 ELSE 1.0 END), 6) AS recall,
       count(*) AS n_queries
FROM {truth} t LEFT JOIN (
    SELECT r.user_id, r.vacancy_id, min(r.pos) AS pos FROM {ranked} r WHERE TRUE {cut}
    GROUP BY r.user_id, r.vacancy_id) h
  ON h.user_id = t.user_id AND h.vacancy_id = t.{target}"""


SESSION_VIEW = f"""SELECT user_id, session_id, strftime(session_dt, {TF}) AS session_dt, n_actions,
       items, actions, times FROM fxs"""

TRUTH_VIEW = f"""SELECT user_id, session_id, round(val_session_rank, 1) AS val_session_rank, target,
       strftime(target_dt, {TF}) AS target_dt, strftime(session_dt, {TF}) AS session_dt, items FROM truth"""


def summary(src: str, col: str) -> str:
    return f"""SELECT count({col}) AS count, round(avg({col}), 6) AS mean, round(stddev_samp({col}), 6) AS std,
       round(min({col})::DOUBLE, 6) AS min, round(quantile_cont({col}, 0.25), 6) AS q25,
       round(quantile_cont({col}, 0.5), 6) AS q50, round(quantile_cont({col}, 0.75), 6) AS q75,
       round(max({col})::DOUBLE, 6) AS max FROM ({src})"""


def item_tokens_ctes() -> str:
    """vec: flat token counts (tokens = dense train user ids) of items found
    in ``part``; nrm: norms; i2i: the full top-99 neighbour list."""
    return """,
pos_i AS (SELECT t.user_id, t.vacancy_id FROM train_i t JOIN part ON t.vacancy_id = p_partkey),
tok AS (SELECT user_id, dense_rank() OVER (ORDER BY user_id) - 1 AS token
        FROM (SELECT DISTINCT user_id FROM pos_i)),
vec AS (SELECT p.vacancy_id AS key, k.token, count(*)::DOUBLE AS val
        FROM pos_i p JOIN tok k USING (user_id) GROUP BY 1, 2)""" + pairwise_ctes("vec", 99, False)


def pairwise_ctes(vec: str, keep: int, include_self: bool, name: str = "i2i") -> str:
    self_cond = "" if include_self else "WHERE a.key <> b.key"
    return f""",
{name}_nrm AS (SELECT key, sqrt(sum(val * val)) AS nrm FROM {vec} GROUP BY key HAVING sum(val * val) > 0),
{name}_dot AS (SELECT a.key AS anchor, b.key AS recom, sum(a.val * b.val) AS dot
               FROM {vec} a JOIN {vec} b ON a.token = b.token GROUP BY 1, 2),
{name}_all AS (SELECT a.key AS anchor, b.key AS recom,
                      round(coalesce(d.dot, 0.0) / (a.nrm * b.nrm), 9) AS s
               FROM {name}_nrm a CROSS JOIN {name}_nrm b
               LEFT JOIN {name}_dot d ON d.anchor = a.key AND d.recom = b.key {self_cond}),
{name} AS (SELECT anchor, recom, s AS score, pos FROM (
             SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY s DESC, recom) AS pos FROM {name}_all)
           WHERE pos <= {keep})"""


I2I_VIEW = """SELECT anchor AS anchor_vacancy_id, recom AS recom_vacancy_id, round(score, 9) AS score, pos FROM i2i"""

I2I_TOPK = """,
i2i_c AS (SELECT l.user_id, t.recom AS vacancy_id, max(t.score) AS score
          FROM (SELECT DISTINCT user_id, vacancy_id FROM test_i) l JOIN i2i t ON t.anchor = l.vacancy_id
          GROUP BY 1, 2),
i2i_k AS (SELECT * FROM i2i_c QUALIFY dense_rank() OVER (PARTITION BY user_id ORDER BY score DESC) <= 20),
pop AS (SELECT vacancy_id, count(*)::DOUBLE AS score FROM train_i WHERE action_type = 1
        GROUP BY 1 ORDER BY score DESC, vacancy_id LIMIT 100),
pop_c AS (SELECT u.user_id, p.vacancy_id, p.score FROM (SELECT DISTINCT user_id FROM test_i) u CROSS JOIN pop p),
merged AS (SELECT user_id, vacancy_id, cs.score AS continue_search_score, i2i_k.score AS i2i_score,
                  pop_c.score AS popular_score
           FROM cs FULL JOIN i2i_k USING (user_id, vacancy_id) FULL JOIN pop_c USING (user_id, vacancy_id))"""


def _llo_unbounded() -> str:
    flat, (ts, te), (vs, ve) = F1
    return "WITH " + sessions_ctes(flat) + f""",
train_s AS (SELECT * FROM fxs WHERE session_dt >= TIMESTAMP '{ts}' AND session_dt < TIMESTAMP '{te}'),
val_s AS (SELECT * FROM fxs WHERE session_dt >= TIMESTAMP '{vs}' AND session_dt < TIMESTAMP '{ve}'),
lastrow AS (SELECT x.* FROM fxn x JOIN val_s s USING (user_id, session_id) WHERE x.pos = s.n_actions),
llo AS (SELECT s.user_id, s.session_id, l.vacancy_id AS next_item, s.n_actions
        FROM val_s s JOIN lastrow l USING (user_id, session_id) WHERE s.n_actions > 1 AND l.action_type = 1),
train_i AS (SELECT x.* FROM fxn x JOIN train_s USING (user_id, session_id)),
test_i AS (SELECT x.* FROM fxn x JOIN llo USING (user_id, session_id) WHERE x.pos < llo.n_actions),
cs_rows AS (SELECT user_id, vacancy_id, action_dt,
                   CASE action_type WHEN 1 THEN -5.0 WHEN 2 THEN 1.0 WHEN 3 THEN 3.0 END AS w
            FROM train_i WHERE user_id IN (SELECT user_id FROM test_i)
            UNION ALL
            SELECT user_id, vacancy_id, action_dt,
                   CASE action_type WHEN 1 THEN -5.0 WHEN 2 THEN 1.0 WHEN 3 THEN 3.0 END AS w FROM test_i),
cs_best AS (SELECT * FROM cs_rows
            QUALIFY row_number() OVER (PARTITION BY user_id, vacancy_id ORDER BY w DESC, action_dt DESC) = 1),
cs AS (SELECT user_id, vacancy_id,
              ln(dense_rank() OVER (PARTITION BY user_id ORDER BY action_dt DESC)) AS score FROM cs_best),
seen AS (SELECT DISTINCT user_id, vacancy_id FROM train_i WHERE action_type = 1),
kept AS (SELECT * FROM cs WHERE NOT EXISTS (
           SELECT 1 FROM seen WHERE seen.user_id = cs.user_id AND seen.vacancy_id = cs.vacancy_id)),
ranked_c AS (SELECT user_id, vacancy_id,
                    row_number() OVER (PARTITION BY user_id ORDER BY score, vacancy_id) AS pos FROM kept)
SELECT mrr, n_queries FROM (""" + metrics_sql("llo", "ranked_c", "", "next_item") + ")"


def queries() -> dict[str, str]:
    f1 = flow_ctes(F1)
    f2 = flow_ctes(F2)
    f1s = "WITH " + sessions_ctes(F1_FLAT)
    f2s = "WITH " + sessions_ctes(f2_flat())
    f1_i2i = f1 + item_tokens_ctes()
    f1_hot = flow_ctes(F1_HOT)
    embedded = """
WITH e AS (SELECT vec_id AS key, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT key, label, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS v FROM e
      WHERE list_sum(list_transform(v, lambda y: y * y)) > 0)"""
    merged_kept = I2I_TOPK + """,
m_kept AS (SELECT * FROM merged m WHERE NOT EXISTS (
             SELECT 1 FROM seen WHERE seen.user_id = m.user_id AND seen.vacancy_id = m.vacancy_id))"""
    return {
        "session_normalise_events": f1s + "\n" + SESSION_VIEW,
        "session_normalise_orders_ties": "WITH " + sessions_ctes(f2_flat(True)) + "\n" + SESSION_VIEW,
        "interactions_events": f1s + f"""
SELECT user_id, session_id, pos, vacancy_id, action_type, strftime(action_dt, {TF}) AS action_dt FROM fxn""",
        "id_codec_events": f1s + """
SELECT 'u_' || CAST(user_id AS VARCHAR) AS user_key, session_id,
       string_agg('v_' || CAST(vacancy_id AS VARCHAR), ',' ORDER BY pos) AS item_keys,
       user_id, string_agg(CAST(vacancy_id AS VARCHAR), ',' ORDER BY pos) AS items
FROM fxn GROUP BY user_id, session_id""",
        "time_split_events": f1 + f"""
SELECT user_id, session_id, strftime(session_dt, {TF}) AS session_dt, 'train' AS split FROM train_s
UNION ALL
SELECT user_id, session_id, strftime(session_dt, {TF}) AS session_dt, 'validation' AS split FROM val_s""",
        "truth_events": f1 + "\n" + TRUTH_VIEW,
        "truth_orders": f2 + "\n" + TRUTH_VIEW,
        "truth_orders_ties": flow_ctes(F2T) + "\n" + TRUTH_VIEW,
        "leave_last_out_events": f1s + """,
g AS (SELECT *, count(*) OVER (PARTITION BY user_id, session_id) AS n FROM fxn)
SELECT user_id, session_id, max(vacancy_id) FILTER (WHERE pos = n) AS next_item,
       coalesce(string_agg(CAST(vacancy_id AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE pos < n), '') AS items,
       coalesce(string_agg(CAST(action_type AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE pos < n), '') AS actions,
       max(n) AS n_times
FROM g GROUP BY user_id, session_id
HAVING max(n) > 1 AND max(action_type) FILTER (WHERE pos = n) = 1""",
        "continue_search_events": f1 + "\nSELECT user_id, vacancy_id, round(score, 6) AS score FROM cs",
        "seen_filter_events": f1 + "\nSELECT user_id, vacancy_id, round(score, 6) AS score FROM kept",
        "pack_events": f1 + "\nSELECT user_id, predictions, n_predictions FROM packed",
        "submission_events": f1 + """
SELECT coalesce(t.user_id, p.user_id) AS user_id, t.session_id, coalesce(p.predictions, '') AS predictions
FROM (SELECT user_id, session_id FROM truth) t FULL OUTER JOIN packed p ON t.user_id = p.user_id""",
        "mrr_recall_events": f1 + metrics_sql("truth", "ranked_c"),
        "mrr_recall_orders": f2 + metrics_sql("truth", "ranked_c"),
        "submission_scoring_events": f1 + metrics_sql("truth", "ranked_c"),
        "mrr_unbounded_events": _llo_unbounded(),
        "eda_sessions_per_day": f1s + """
SELECT strftime(CAST(session_dt AS DATE), '%Y-%m-%d') AS day, count(*) AS n_sessions FROM fxs GROUP BY 1""",
        "eda_sessions_per_user": f1s + "\nSELECT user_id, count(*) AS n_sessions FROM fxs GROUP BY 1",
        "eda_sessions_per_user_summary": f1s + "\n" + summary(
            "SELECT user_id, count(*) AS n FROM fxs GROUP BY 1", "n"),
        "eda_item_frequency": f2s + "\nSELECT vacancy_id, count(*) AS n_interactions FROM fx GROUP BY 1",
        "eda_item_frequency_summary": f2s + "\n" + summary(
            "SELECT vacancy_id, count(*) AS n FROM fx GROUP BY 1", "n"),
        "eda_items_per_user": f2s + "\nSELECT user_id, count(*) AS n_items FROM fx GROUP BY 1",
        "eda_items_per_user_summary": f2s + "\n" + summary(
            "SELECT user_id, count(*) AS n FROM fx GROUP BY 1", "n"),
        "popular_candidates_events": f1 + """,
pop AS (SELECT vacancy_id, count(*)::DOUBLE AS score FROM train_i WHERE action_type = 1
        GROUP BY 1 ORDER BY score DESC, vacancy_id LIMIT 100)
SELECT u.user_id, p.vacancy_id, round(p.score, 6) AS score
FROM (SELECT DISTINCT user_id FROM test_i) u CROSS JOIN pop p""",
        "item_tokens_events": f1_i2i + "\nSELECT key, token, val FROM vec",
        "dictionary_items_orders": """
SELECT vacancy_id, dense_rank() OVER (ORDER BY vacancy_id) - 1 AS idx
FROM (SELECT DISTINCT l_partkey AS vacancy_id FROM lineitem)""",
        "i2i_cooccurrence_events": f1_i2i + "\n" + I2I_VIEW,
        "i2i_cooccurrence_orders": f2 + item_tokens_ctes() + "\n" + I2I_VIEW,
        "i2i_candidates_events": f1_i2i + I2I_TOPK + "\nSELECT user_id, vacancy_id, round(score, 9) AS score FROM i2i_c",
        "i2i_topk_events": f1_i2i + I2I_TOPK + "\nSELECT user_id, vacancy_id, round(score, 9) AS score FROM i2i_k",
        "round_robin_events": f1_i2i + pairwise_ctes("vec", 20, True, "near") + """,
latest AS (SELECT user_id, vacancy_id, max(action_dt) AS last_dt FROM test_i GROUP BY 1, 2),
lists AS (SELECT user_id, vacancy_id AS anchor,
                 row_number() OVER (PARTITION BY user_id ORDER BY last_dt DESC, vacancy_id) AS list_idx
          FROM latest),
cand AS (SELECT l.user_id, t.recom AS vacancy_id, t.pos AS npos, l.list_idx
         FROM lists l JOIN near t ON t.anchor = l.anchor),
firsts AS (SELECT * FROM cand
           QUALIFY row_number() OVER (PARTITION BY user_id, vacancy_id ORDER BY npos, list_idx) = 1)
SELECT user_id, vacancy_id, row_number() OVER (PARTITION BY user_id ORDER BY npos, list_idx) AS pos
FROM firsts""",
        "unique_neighbours_events": f1_i2i + """
SELECT DISTINCT l.user_id, t.recom AS vacancy_id
FROM (SELECT DISTINCT user_id, vacancy_id FROM test_i) l JOIN i2i t ON t.anchor = l.vacancy_id""",
        "candidate_join_events": f1_i2i + I2I_TOPK + """
SELECT user_id, vacancy_id, round(continue_search_score, 6) AS continue_search_score,
       round(i2i_score, 9) AS i2i_score, round(popular_score, 6) AS popular_score FROM merged""",
        "three_generator_mrr_events": f1_i2i + I2I_TOPK + """,
m_kept AS (SELECT * FROM merged m WHERE NOT EXISTS (
             SELECT 1 FROM seen WHERE seen.user_id = m.user_id AND seen.vacancy_id = m.vacancy_id)),
m_ranked AS (SELECT user_id, vacancy_id, row_number() OVER (
               PARTITION BY user_id ORDER BY continue_search_score ASC NULLS LAST, i2i_score DESC NULLS LAST,
                                             popular_score DESC NULLS LAST, vacancy_id) AS pos FROM m_kept)
""" + metrics_sql("truth", "m_ranked"),
        "knn_embeddings": """
WITH e AS (SELECT vec_id AS key, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT key, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nr FROM e),
sc AS (SELECT a.key AS anchor, b.key AS recom,
              round(list_inner_product(a.v, b.v) / (a.nr * b.nr), 9) AS s
       FROM n a JOIN n b ON a.key <> b.key WHERE a.nr > 0 AND b.nr > 0),
top AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY s DESC, recom) AS pos FROM sc)
SELECT anchor AS anchor_vacancy_id, recom AS recom_vacancy_id, round(s, 9) AS score, pos
FROM top WHERE pos <= 99""",
        "text_knn_part_names": f2 + """,
words AS (SELECT p_partkey AS key, unnest(regexp_extract_all(lower(p_name), '\\b\\w\\w+\\b')) AS word FROM part),
wvec AS (SELECT key, hash(word) AS token, count(*)::DOUBLE AS val FROM words GROUP BY key, word)"""
        + pairwise_ctes("wvec", 20, True, "tnn") + """
SELECT DISTINCT l.user_id, t.recom AS vacancy_id
FROM (SELECT DISTINCT user_id, vacancy_id FROM test_i) l JOIN tnn t ON t.anchor = l.vacancy_id""",
        "text_knn_documents": """
WITH words AS (SELECT doc_id AS key, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{Nd}\\p{Pc}]{2,}')) AS word FROM documents),
wvec AS (SELECT key, hash(word) AS token, count(*)::DOUBLE AS val FROM words GROUP BY key, word)"""
        + pairwise_ctes("wvec", 19, False) + "\n" + I2I_VIEW,
        "cold_user_items_orders": "WITH " + sessions_ctes(f2_flat()) + f""",
train_s AS (SELECT * FROM fxs WHERE session_dt >= TIMESTAMP '{F2[1][0]}' AND session_dt < TIMESTAMP '{F2[1][1]}'),
val_s AS (SELECT * FROM fxs WHERE session_dt >= TIMESTAMP '{F2[2][0]}' AND session_dt < TIMESTAMP '{F2[2][1]}')
SELECT x.user_id, x.session_id, x.vacancy_id, x.pos, 0.0 AS score
FROM fxn x JOIN val_s USING (user_id, session_id)
WHERE x.user_id NOT IN (SELECT user_id FROM train_s)""",
        "truth_hot_user_events": f1_hot + "\n" + TRUTH_VIEW,
        "continue_search_hot_user_events": f1_hot + "\nSELECT user_id, vacancy_id, round(score, 6) AS score FROM cs",
        "seen_filter_counts_events": f1 + """
SELECT 'before' AS at, count(*) AS n_rows FROM cs UNION ALL SELECT 'after' AS at, count(*) AS n_rows FROM kept""",
        "submission_scoring_limit_events": f1 + """,
some_truth AS (SELECT * FROM truth ORDER BY user_id, session_id LIMIT 30)""" + metrics_sql("some_truth", "ranked_c"),
        "dataset_round_trip_events": f1_i2i + I2I_TOPK + "\nSELECT user_id, vacancy_id, round(score, 9) AS score FROM i2i_k",
        "eda_sessions_per_day_sample": f1s + f"""
SELECT strftime(CAST(session_dt AS DATE), '%Y-%m-%d') AS day, count(*) AS n_sessions FROM fxs
WHERE substr(md5('42:' || CAST(user_id AS VARCHAR) || ':' || session_id), 1, 8) < '{int(0.1 * 0xFFFFFFFF):08x}' GROUP BY 1""",
        "item_tokens_geo_events": f1 + """,
geo AS (SELECT t.vacancy_id, CAST(t.user_id AS VARCHAR) || '|' || p_brand || '|' || p_type AS tok
        FROM train_i t JOIN part ON t.vacancy_id = p_partkey),
ids AS (SELECT tok, dense_rank() OVER (ORDER BY tok) - 1 AS token FROM (SELECT DISTINCT tok FROM geo))
SELECT g.vacancy_id AS key, i.token, count(*)::DOUBLE AS val FROM geo g JOIN ids i USING (tok) GROUP BY 1, 2""",
        "user_item_matrix_events": f1 + """
SELECT user_id, vacancy_id, round(sum(CASE action_type WHEN 1 THEN 4.0 WHEN 2 THEN 1.0 WHEN 3 THEN 2.0 END)::DOUBLE, 6) AS weight
FROM train_i GROUP BY 1, 2""",
        "random_rank_events": f1 + """,
rnd AS (SELECT user_id, vacancy_id, row_number() OVER (PARTITION BY user_id ORDER BY
          substr(md5('42:' || CAST(user_id AS VARCHAR) || ':' || CAST(vacancy_id AS VARCHAR)), 1, 13) DESC, vacancy_id) AS pos FROM kept)
SELECT user_id, string_agg(CAST(vacancy_id AS VARCHAR), ',' ORDER BY pos) AS predictions FROM rnd WHERE pos <= 100 GROUP BY user_id""",
        "feature_rank_events": f1_i2i + merged_kept + """,
scored AS (SELECT user_id, vacancy_id, round(0.25 + -0.5 * coalesce(continue_search_score, 0.0) + 2.0 * coalesce(i2i_score, 0.0)
                                             + 0.01 * coalesce(popular_score, 0.0), 9)::DOUBLE AS model_score FROM m_kept)
SELECT * FROM (SELECT user_id, vacancy_id, model_score,
                      row_number() OVER (PARTITION BY user_id ORDER BY model_score DESC, vacancy_id) AS pos FROM scored) WHERE pos <= 100""",
        "ivf_full_probe_embeddings": embedded + """,
sc AS (SELECT a.key AS anchor, b.key AS recom, round(list_inner_product(a.v, b.v), 9) AS s FROM u a JOIN u b ON a.key <> b.key),
top AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY s DESC, recom) AS pos FROM sc)
SELECT anchor AS anchor_vacancy_id, recom AS recom_vacancy_id, round(s, 9) AS score, pos FROM top WHERE pos <= 99""",
        "svd_full_rank_i2i_events": f1_i2i + """,
six AS (SELECT anchor, recom, round(s, 6) AS s FROM i2i_all)
SELECT anchor AS anchor_vacancy_id, recom AS recom_vacancy_id, s AS score, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY s DESC, recom) AS pos FROM six) WHERE pos <= 99""",
        "cluster_knn_labels": embedded + """,
dims AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM u),
m AS (SELECT label, list(x ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS x FROM dims GROUP BY 1, 2) GROUP BY 1),
c AS (SELECT label, list_transform(c, lambda x: x / sqrt(list_sum(list_transform(c, lambda y: y * y)))) AS c FROM m),
near AS (SELECT u.key, c.label, round(list_inner_product(u.v, c.c), 9) AS s FROM u CROSS JOIN c),
home AS (SELECT key, label FROM near QUALIFY row_number() OVER (PARTITION BY key ORDER BY s DESC, label) = 1),
lists AS (SELECT label, key, s, row_number() OVER (PARTITION BY label ORDER BY s DESC, key) AS pos FROM near)
SELECT h.key AS anchor_vacancy_id, l.key AS recom_vacancy_id, l.s AS score, l.pos AS pos
FROM home h JOIN lists l USING (label) WHERE l.pos <= 50""",
        "continue_search_state_events": f1 + "\nSELECT user_id, vacancy_id, round(score, 6) AS score FROM cs",
        "time_split_by_day_events": f1 + f"""
SELECT user_id, session_id, strftime(session_dt, {TF}) AS session_dt, 'train' AS split FROM train_s
UNION ALL
SELECT user_id, session_id, strftime(session_dt, {TF}) AS session_dt, 'validation' AS split FROM val_s""",
        "i2i_topk_bucketed_events": f1_i2i + I2I_TOPK + "\nSELECT user_id, vacancy_id, round(score, 9) AS score FROM i2i_k",
        "text_knn_benchmark": """
WITH dwords AS (SELECT doc_id AS key, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{Nd}\\p{Pc}]{2,}')) AS word FROM documents),
qwords AS (SELECT item_id AS key, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{Nd}\\p{Pc}]{2,}')) AS word FROM benchmark),
dvec AS (SELECT key, word, count(*)::DOUBLE AS val FROM dwords GROUP BY 1, 2),
qvec AS (SELECT key, word, count(*)::DOUBLE AS val FROM qwords WHERE word IN (SELECT word FROM dvec) GROUP BY 1, 2),
dn AS (SELECT key, sqrt(sum(val * val)) AS nrm FROM dvec GROUP BY 1), qn AS (SELECT key, sqrt(sum(val * val)) AS nrm FROM qvec GROUP BY 1),
dot AS (SELECT q.key AS anchor, v.key AS recom, sum(q.val * v.val) AS dot FROM qvec q JOIN dvec v USING (word) GROUP BY 1, 2),
every AS (SELECT i.item_id AS anchor, dn.key AS recom, coalesce(round(dot.dot / (qn.nrm * dn.nrm), 9), 0.0) AS s
          FROM benchmark i CROSS JOIN dn LEFT JOIN qn ON qn.key = i.item_id LEFT JOIN dot ON dot.anchor = i.item_id AND dot.recom = dn.key)
SELECT anchor AS anchor_vacancy_id, recom AS recom_vacancy_id, s AS score, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY s DESC, recom) AS pos FROM every) WHERE pos <= 20""",
        "ranker_training_events": f1_i2i + I2I_TOPK + """,
labelled AS (SELECT m.*, CASE WHEN EXISTS (SELECT 1 FROM truth t WHERE t.user_id = m.user_id AND t.target = m.vacancy_id) THEN 1 ELSE 0 END AS label FROM merged m),
placed AS (SELECT *, row_number() OVER (PARTITION BY user_id, label ORDER BY
             md5('42:' || CAST(user_id AS VARCHAR) || ':' || CAST(vacancy_id AS VARCHAR)), vacancy_id) AS place FROM labelled
           WHERE user_id IN (SELECT user_id FROM labelled WHERE label = 1))
SELECT user_id, vacancy_id, CAST(label AS BIGINT) AS label, round(continue_search_score, 6) AS continue_search_score,
       round(i2i_score, 9) AS i2i_score, round(popular_score, 6) AS popular_score
FROM placed WHERE label = 1 OR place <= 10""",
    }
