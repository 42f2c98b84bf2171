"""The same results in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

from tideline.plans.tree_sql import grow

TYPE_INDEX = ("CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 "
              "WHEN 'signup' THEN 3 WHEN 'view' THEN 4 END")
FLAG_INDEX = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END"
STATUS_INDEX = "CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END"
STAMP = "'%Y-%m-%d %H:%M:%S'"
LINE_KEY = "concat(l_orderkey, '-', l_linenumber)"


def _bucket(key: str, salt: int = 0) -> str:
    return f"((((({key}) + {salt}) % 2147483648) * 2654435761) // 65536) % 1000"


def _money(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(18,2)) AS VARCHAR)"


def _window(start: str, length: str) -> str:
    return (f"strftime({start}, {STAMP}) AS window_start, "
            f"strftime({start} + INTERVAL '{length}', {STAMP}) AS window_end")


# --- text -------------------------------------------------------------------------

NB_BASE = f"""SELECT l_orderkey, l_linenumber, CAST({FLAG_INDEX} AS DOUBLE) AS label, l_quantity AS f0,
  round(l_extendedprice / 1000, 6) AS f1, round(l_discount * 100, 6) AS f2, round(l_tax * 100, 6) AS f3
  FROM lineitem"""

SVM_LINES = f"""SELECT concat_ws(' ', {_money('l_extendedprice')},
    CASE WHEN l_quantity <> 0 THEN '1:' || {_money('l_quantity')} END,
    CASE WHEN l_discount <> 0 THEN '2:' || {_money('l_discount')} END,
    CASE WHEN l_tax <> 0 THEN '3:' || {_money('l_tax')} END) AS value FROM lineitem"""

# Two of the four untidy variants of a line survive the cleaning.
SVM_ROWS = """SELECT l_extendedprice AS label, l_quantity AS q, l_discount AS d, l_tax AS t
  FROM lineitem, range(2)"""

EVENT_WORDS = """SELECT event_id, ts, unnest(string_split(concat(event_type, ' ', props), ' ')) AS word
  FROM events"""


# --- ratings ------------------------------------------------------------------------

RATINGS = f"""r AS (SELECT user_id, item_id, round(avg(value), 6) AS pref FROM
  (SELECT user_id, ({TYPE_INDEX}) * 24 + hour(ts) AS item_id, value FROM events) GROUP BY ALL)"""

PEARSON = """sims AS (SELECT a.user_id AS u, b.user_id AS v, count(*) AS n, corr(a.pref, b.pref) AS sim
  FROM r a JOIN r b ON a.item_id = b.item_id AND a.user_id <> b.user_id GROUP BY ALL
  HAVING min(a.pref) <> max(a.pref) AND min(b.pref) <> max(b.pref))"""

EUCLIDEAN = """sims AS (SELECT a.user_id AS u, b.user_id AS v, count(*) AS n,
  1 / (1 + sqrt(sum((a.pref - b.pref) * (a.pref - b.pref))) / sqrt(count(*))) AS sim
  FROM r a JOIN r b ON a.item_id = b.item_id AND a.user_id <> b.user_id GROUP BY ALL)"""

NEAREST = """near AS (SELECT * FROM (SELECT *, row_number() OVER
  (PARTITION BY u ORDER BY round(sim, 9) DESC, v) AS rnk FROM sims) WHERE rnk <= 2)"""

ESTIMATES = """est AS (SELECT c.*, least(greatest(raw, lo), hi) AS score FROM (
    SELECT near.u, r.item_id, sum(sim * pref) / sum(sim) AS raw, count(*) AS cnt
    FROM near JOIN r ON r.user_id = near.v GROUP BY ALL HAVING count(*) >= 2) c,
  (SELECT min(pref) AS lo, max(pref) AS hi FROM r)
  WHERE NOT EXISTS (SELECT 1 FROM r s WHERE s.user_id = c.u AND s.item_id = c.item_id))"""

ITEM_SIMS = """sizes AS (SELECT item_id, count(*) AS c FROM r GROUP BY ALL),
  co AS (SELECT a.item_id AS i, b.item_id AS j, count(*) AS n FROM r a JOIN r b
    ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY ALL),
  isims AS (SELECT * FROM (SELECT i, j, n, sim, row_number() OVER
      (PARTITION BY i ORDER BY round(sim, 9) DESC, j) AS rnk
    FROM (SELECT co.*, 1 / (1 + sqrt(x.c + y.c - 2 * co.n)) AS sim FROM co
      JOIN sizes x ON x.item_id = i JOIN sizes y ON y.item_id = j)) WHERE rnk <= 100)"""

ITEM_RECS = """recs AS (SELECT * FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rnk FROM (
      SELECT r.user_id, isims.j AS item_id, sum(sim) AS score FROM r JOIN isims ON isims.i = r.item_id
      WHERE NOT EXISTS (SELECT 1 FROM r s WHERE s.user_id = r.user_id AND s.item_id = isims.j)
      GROUP BY ALL)) WHERE rnk <= 10)"""


def _profile(sims: str, where: str = "") -> str:
    return f"""WITH {RATINGS}, {sims} SELECT u AS user_id, count(*) AS n_similar,
      round(avg(sim), 6) AS mean_sim, round(min(sim), 6) AS min_sim, round(max(sim), 6) AS max_sim
      FROM sims {where} GROUP BY u"""


def _user_top(where: str = "") -> str:
    return f"""SELECT u AS user_id, item_id, round(score, 5) AS score, CAST(rnk AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY u ORDER BY round(score, 9) DESC, item_id) AS rnk
      FROM est {where}) WHERE rnk <= 3"""


# --- models ---------------------------------------------------------------------------

def _nb(train: str = "TRUE") -> str:
    return f"""base AS (SELECT *, row_number() OVER () AS id FROM ({NB_BASE})),
    sums AS (SELECT label, count(*) AS n, [sum(f0), sum(f1), sum(f2), sum(f3)] AS s FROM base
      WHERE {train} GROUP BY label),
    model AS (SELECT label, ln(n + 1) - ln((SELECT sum(n) FROM sums) + (SELECT count(*) FROM sums)) AS pi,
      ln(s[1] + 1) - ln(list_sum(s) + 4) AS t0, ln(s[2] + 1) - ln(list_sum(s) + 4) AS t1,
      ln(s[3] + 1) - ln(list_sum(s) + 4) AS t2, ln(s[4] + 1) - ln(list_sum(s) + 4) AS t3 FROM sums),
    scored AS (SELECT * FROM (SELECT b.*, m.label AS prediction, row_number() OVER
      (PARTITION BY id ORDER BY pi + f0 * t0 + f1 * t1 + f2 * t2 + f3 * t3 DESC, m.label) AS pick
      FROM base b, model m) WHERE pick = 1)"""


def _tree(y: str, depth: int = 5, train: str = "TRUE") -> str:
    base = (f"SELECT ({train}) AS train, CAST({y} AS DOUBLE) AS y, l_quantity AS x0, l_discount AS x1, "
            f"l_tax AS x2 FROM lineitem")
    return grow(base, 3, depth)


# Halfway between a cut value and the next value of its slot.
DISTINCT = """vals AS (SELECT DISTINCT 0 AS slot, l_quantity AS x FROM lineitem UNION ALL
  SELECT DISTINCT 1, l_discount FROM lineitem UNION ALL SELECT DISTINCT 2, l_tax FROM lineitem),
  cuts AS (SELECT nodes.*, (cut + (SELECT min(x) FROM vals v WHERE v.slot = nodes.slot AND v.x > cut)) / 2
  AS threshold FROM nodes)"""

FLIGHT_BASE = f"""SELECT TRUE AS train, l_extendedprice AS y, {LINE_KEY} AS id, l_quantity AS x0,
  l_discount AS x1, l_tax AS x2, l_linenumber AS x3, p_size AS x4, year(l_shipdate) AS x5,
  {FLAG_INDEX} AS x6, s_nationkey AS x7, CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) AS x8
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""


def _root(y: str) -> str:
    return f"""WITH {_tree(y, depth=1)}, {DISTINCT}
      SELECT slot AS feature, round(threshold, 6) AS threshold, n FROM cuts WHERE node = 1"""


def _leaf_counts(copies: int = 1) -> str:
    return f"""SELECT round(mean, 4) AS prediction, CAST(count(*) * {copies} AS BIGINT) AS n
      FROM leafed JOIN nodes USING (node) GROUP BY 1"""


MAJORITY = "CASE WHEN mean > 0.5 THEN 1.0 ELSE 0.0 END"

# --- windows -----------------------------------------------------------------------------

AVERAGES = """n, total, CASE WHEN n > 0 THEN CAST(trunc(total / n) AS BIGINT) END AS avg_int,
  CASE WHEN n > 0 THEN round(total / n, 6) END AS avg"""


def _gridded(bucket: str, aggregates: str, final: str) -> str:
    return f"""WITH c AS (SELECT time_bucket(INTERVAL '{bucket}', ts) AS ws, {aggregates} FROM events GROUP BY 1),
      g AS (SELECT unnest(generate_series((SELECT min(ws) FROM c), (SELECT max(ws) FROM c),
        INTERVAL '{bucket}')) AS ws)
      SELECT {_window('g.ws', bucket)}, {final} FROM (SELECT g.ws AS ws, coalesce(n, 0) AS n, c.* EXCLUDE (ws, n)
        FROM g LEFT JOIN c ON c.ws = g.ws) g"""


SPANS = """spans AS (SELECT word, unnest(generate_series(min(ws), (SELECT max(ws) FROM counts), INTERVAL '1 hour')) AS ws
  FROM counts GROUP BY word)"""


def _sliding(length: str, slide: str, copies: int) -> str:
    return f"""counts AS (SELECT time_bucket(INTERVAL '{slide}', ts) - k * INTERVAL '{slide}' AS ws, word,
      count(*) AS cnt FROM ({EVENT_WORDS}), range({copies}) t(k) GROUP BY ALL)"""


SUM_INT = "count(*) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS total"
REPORT = "n, concat('Received ', n, ' flume events.') AS message"


def _pca(k: int, squarings: int = 16) -> str:
    """Principal components by repeated squaring of the covariance, then deflation, ``k`` times."""
    steps = ["""e AS MATERIALIZED (SELECT vec_id, unnest(embedding)::DOUBLE AS v,
      generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)""",
             "centred AS MATERIALIZED (SELECT vec_id, i, v - avg(v) OVER (PARTITION BY i) AS v FROM e)",
             """m0 AS MATERIALIZED (SELECT x.i, y.i AS j, sum(x.v * y.v) / (count(*) - 1) AS v
      FROM centred x JOIN centred y USING (vec_id) GROUP BY ALL)"""]
    for c in range(k):
        steps.append(f"""q{c}_0 AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FROM m{c} WHERE i = j) AS v FROM m{c})""")
        for n in range(squarings):
            steps.append(f"""r{c}_{n} AS MATERIALIZED (SELECT x.i, y.j, sum(x.v * y.v) AS v
      FROM q{c}_{n} x JOIN q{c}_{n} y ON x.j = y.i GROUP BY ALL)""")
            steps.append(f"""q{c}_{n + 1} AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FROM r{c}_{n} WHERE i = j) AS v
      FROM r{c}_{n})""")
        last = f"q{c}_{squarings}"
        steps.append(f"""u{c} AS MATERIALIZED (SELECT i, v / sqrt(sum(v * v) OVER ()) AS v FROM {last}
      WHERE j = (SELECT i FROM {last} WHERE i = j ORDER BY v DESC, i LIMIT 1))""")
        steps.append(f"""v{c} AS MATERIALIZED (SELECT i, v * (SELECT sign(v) FROM u{c} ORDER BY abs(v) DESC, i LIMIT 1) AS v
      FROM u{c})""")
        steps.append(f"""l{c} AS MATERIALIZED (SELECT sum(m.v * a.v * b.v) AS l
      FROM m{c} m JOIN v{c} a ON a.i = m.i JOIN v{c} b ON b.i = m.j)""")
        steps.append(f"""m{c + 1} AS MATERIALIZED (SELECT m.i, m.j, m.v - l * a.v * b.v AS v
      FROM m{c} m JOIN v{c} a ON a.i = m.i JOIN v{c} b ON b.i = m.j, l{c})""")
    rows = " UNION ALL ".join(
        f"""SELECT {c}::INTEGER AS component, i::INTEGER AS feature, round(v, 6) + 0.0::DOUBLE AS loading,
      round(l / (SELECT sum(v) FROM m0 WHERE i = j), 6) AS explained FROM v{c}, l{c}""" for c in range(k))
    return f"WITH {', '.join(steps)} {rows}"


ORACLES: dict[str, str] = {
    "s01_text_scan": f"""SELECT concat(label, ',', concat_ws(' ', f0, f1, f2, f3)) AS value FROM ({NB_BASE})""",
    "s02_libsvm_scan": "SELECT l_extendedprice AS label, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem",
    "s03_ratings_scan": f"""WITH {RATINGS} SELECT user_id, item_id,
      round(CAST(CAST(pref AS FLOAT) AS DOUBLE), 3) AS pref FROM r""",
    "s04_stream_lines": "SELECT concat(event_type, ' ', props) AS value FROM events",
    "k01_tuple_text": f"SELECT concat('(0,', {LINE_KEY}, ',', l_quantity, ',0)') AS value FROM lineitem",
    "k05_recs_text": f"""WITH {RATINGS}, {ITEM_SIMS}, {ITEM_RECS} SELECT user_id, CAST(rnk AS INTEGER) AS rank,
      item_id, round(CAST(CAST(score AS FLOAT) AS DOUBLE), 4) AS score FROM recs""",
    "p01_parse_label_csv": """SELECT l_extendedprice AS label, l_quantity AS f0, l_discount AS f1, l_tax AS f2
      FROM lineitem""",
    "p02_parse_label_space": f"SELECT label, f0, f1, f2, f3 FROM ({NB_BASE})",
    "p03_parse_keyed_csv": f"""SELECT {LINE_KEY} AS id, l_quantity AS f0, l_discount AS f1, l_tax AS f2
      FROM lineitem""",
    "p04_parse_libsvm": f"""SELECT label, concat_ws(' ', CASE WHEN q <> 0 THEN '0' END, CASE WHEN d <> 0 THEN '1' END,
      CASE WHEN t <> 0 THEN '2' END) AS indices, concat_ws(' ', CASE WHEN q <> 0 THEN CAST(q AS VARCHAR) END,
      CASE WHEN d <> 0 THEN CAST(d AS VARCHAR) END, CASE WHEN t <> 0 THEN CAST(t AS VARCHAR) END) AS feature_values,
      CAST(q <> 0 AS INTEGER) + CAST(d <> 0 AS INTEGER) + CAST(t <> 0 AS INTEGER) AS n_values FROM ({SVM_ROWS})""",
    "p05_clean_lines": f"""SELECT value FROM ({SVM_LINES}) UNION ALL
      SELECT replace(value, ' 2:', '  2:') FROM ({SVM_LINES})""",
    "p06_infer_width": f"""SELECT max(CASE WHEN t <> 0 THEN 3 WHEN d <> 0 THEN 2 ELSE 1 END) AS width
      FROM ({SVM_ROWS})""",
    "p07_sparse_assemble": f"""SELECT label, q AS f0, d AS f1, t AS f2, 0.0::DOUBLE AS f3, 0.0::DOUBLE AS f4
      FROM ({SVM_ROWS})""",
    "p07_sparse_assemble_wide": f"""SELECT label, q AS f0, d AS f1, t AS f2,
      {', '.join(f'0.0::DOUBLE AS f{i}' for i in range(3, 40))} FROM ({SVM_ROWS})""",
    "p08_parse_int": "SELECT event_id, CAST(floor(value) AS INTEGER) AS number FROM events",
    "p09_tokenize": """SELECT event_id, unnest(string_split(concat(event_type, '  ', props), ' ')) AS word
      FROM events""",
    "p14_hash_split": f"""SELECT o_orderkey, CASE WHEN b < 600 THEN 0 WHEN b < 900 THEN 1 ELSE 2 END AS part
      FROM (SELECT o_orderkey, {_bucket('o_orderkey', 11)} AS b FROM orders)""",
    "a01_int_average": f"SELECT {AVERAGES} FROM (SELECT {SUM_INT} FROM events)",
    "a06_word_count": f"SELECT word, count(*) AS cnt FROM ({EVENT_WORDS}) GROUP BY word",
    "a07_batch_counts": _gridded("10 minutes", "count(*) AS n", REPORT),
    "a07s_counts_stream": f"""SELECT {_window('ws', '10 minutes')}, {REPORT} FROM (
      SELECT time_bucket(INTERVAL '10 minutes', ts) AS ws, count(*) AS n FROM events GROUP BY 1)""",
    "w01_batch_average": _gridded("10 minutes", SUM_INT, AVERAGES),
    "w01s_intervals_stream": _gridded("10 minutes", SUM_INT, AVERAGES),
    "w01s_average_stream": f"""SELECT {_window('ws', '1 hour')}, {AVERAGES} FROM (
      SELECT time_bucket(INTERVAL '1 hour', ts) AS ws, {SUM_INT} FROM events GROUP BY 1)""",
    "w02_sliding_words": f"""WITH {_sliding('2 minutes', '10 seconds', 12)}
      SELECT {_window('ws', '2 minutes')}, word, cnt FROM counts""",
    "w02s_panes_stream": f"""WITH {_sliding('2 minutes', '10 seconds', 12)}
      SELECT {_window('ws', '2 minutes')}, word, cnt FROM counts""",
    "w02_zero_retained": f"""WITH {_sliding('12 hours', '1 hour', 12)},
      {SPANS} SELECT {_window('s.ws', '12 hours')}, s.word, coalesce(c.cnt, 0) AS cnt
      FROM spans s LEFT JOIN counts c ON c.word = s.word AND c.ws = s.ws""",
    "w02z_retained_stream": f"""WITH {_sliding('12 hours', '1 hour', 12)}, {SPANS}
      SELECT {_window('s.ws', '12 hours')}, s.word, coalesce(c.cnt, 0) AS cnt
      FROM spans s LEFT JOIN counts c ON c.word = s.word AND c.ws = s.ws""",
    "w02s_words_stream": f"""WITH {_sliding('12 hours', '1 hour', 12)}
      SELECT {_window('ws', '12 hours')}, word, cnt FROM counts""",
    "m01_nb_model": f"""WITH {_nb()} SELECT label, CAST(f AS INTEGER) AS feature, round(pi, 6) AS log_prior,
      round([t0, t1, t2, t3][f + 1], 6) AS log_prob FROM model, range(4) t(f)""",
    "m06_nb_score": f"WITH {_nb()} SELECT l_orderkey, l_linenumber, label, prediction FROM scored",
    "m08_nb_stream": f"WITH {_nb()} SELECT label, prediction, count(*) AS n FROM scored GROUP BY ALL",
    "m08_stored_model": f"""WITH {_nb()} SELECT label, prediction, 1 AS model_version, count(*) AS n
      FROM scored GROUP BY ALL""",
    "m02_tree_classifier": f"""WITH {_tree(STATUS_INDEX)} SELECT y AS label,
      CAST({MAJORITY} AS DOUBLE) AS prediction, count(*) AS n FROM leafed JOIN nodes USING (node) GROUP BY ALL""",
    "m02_root_split": _root(STATUS_INDEX),
    "m03_tree_regressor": f"WITH {_tree('l_extendedprice')} {_leaf_counts()}",
    "m03_root_split": _root("l_extendedprice"),
    "m04_tree_categorical": f"""WITH {grow(FLIGHT_BASE, 9, 5, (6, 7, 8))}
      SELECT slot AS feature, n, round(mean, 4) AS prediction FROM nodes""",
    "m05_tree_nodes": f"""WITH {_tree('l_extendedprice')}, {DISTINCT} SELECT slot AS feature,
      round(threshold, 6) AS threshold, n, round(mean, 4) AS prediction FROM cuts""",
    "m07_keyed_score": f"""WITH {grow(FLIGHT_BASE, 9, 5, (6, 7, 8))}
      SELECT id, round(mean, 4) AS prediction FROM leafed JOIN nodes USING (node)""",
    "m09_tree_stream": f"WITH {_tree('l_extendedprice')} {_leaf_counts(copies=2)}",
    "m09_classifier_stream": f"""WITH {_tree(STATUS_INDEX)} SELECT y AS label,
      CAST({MAJORITY} AS DOUBLE) AS prediction, CAST(2 * count(*) AS BIGINT) AS n
      FROM leafed JOIN nodes USING (node) GROUP BY ALL""",
    "m09_keyed_stream": f"""WITH {grow(FLIGHT_BASE, 9, 5, (6, 7, 8))}
      SELECT id, round(mean, 4) AS prediction FROM leafed JOIN nodes USING (node)""",
    "m10_pca": _pca(10),
    "m11_covariance": """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i
        FROM embeddings)
      SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(covar_samp(a.x, b.x), 6) AS cov
      FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i""",
    "e01_accuracy": f"""WITH {_nb(_bucket('l_orderkey') + ' < 600')} SELECT count(*) AS n,
      round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM scored
      WHERE {_bucket('l_orderkey')} >= 600""",
    "e02_error_rate": f"""WITH {_tree(STATUS_INDEX, train=_bucket('l_orderkey') + ' < 700')} SELECT count(*) AS n,
      round(avg(CASE WHEN y <> {MAJORITY} THEN 1.0 ELSE 0.0 END), 6) AS error_rate
      FROM leafed JOIN nodes USING (node) WHERE NOT train""",
    "e03_mse": f"""WITH {_tree('l_extendedprice', train=_bucket('l_orderkey') + ' < 800')} SELECT count(*) AS n,
      round(avg((mean - y) * (mean - y)), 2) AS mse FROM leafed JOIN nodes USING (node) WHERE NOT train""",
    "c01_pearson": f"""WITH {RATINGS}, {PEARSON} SELECT u AS user_id, v AS other_user_id, round(sim, 6) AS sim, n,
      count(*) OVER w AS n_similar, round(avg(sim) OVER w, 6) AS mean_sim, round(min(sim) OVER w, 6) AS min_sim,
      round(max(sim) OVER w, 6) AS max_sim FROM sims WINDOW w AS (PARTITION BY u)""",
    "c02_euclidean": _profile(EUCLIDEAN),
    "c03_threshold": f"""WITH {RATINGS}, {PEARSON} SELECT u AS user_id, v AS other_user_id, round(sim, 6) AS sim, n
      FROM sims WHERE sim >= 0.1""",
    "c03_threshold_profile": _profile(PEARSON, "WHERE sim >= 0.1"),
    "c04_nearest_n": f"""WITH {RATINGS}, {EUCLIDEAN}, {NEAREST} SELECT u AS user_id, v AS other_user_id,
      round(sim, 6) AS sim, n, CAST(rnk AS INTEGER) AS rank FROM near""",
    "c05_estimate": f"""WITH {RATINGS}, {EUCLIDEAN}, {NEAREST}, {ESTIMATES}
      SELECT u AS user_id, item_id, round(score, 5) AS score, cnt AS n FROM est""",
    "c06_user_recs": f"WITH {RATINGS}, {EUCLIDEAN}, {NEAREST}, {ESTIMATES} {_user_top()}",
    "c06_one_user": f"""WITH {RATINGS}, {PEARSON}, near AS (SELECT * FROM sims WHERE u = 2 AND sim >= 0.1),
      {ESTIMATES} {_user_top()}""",
    "c07_item_similarity": f"""WITH {RATINGS}, {ITEM_SIMS} SELECT i AS item_id, j AS other_item_id,
      round(sim, 6) AS sim, n, CAST(rnk AS INTEGER) AS rank FROM isims""",
    "c08_item_recs": f"""WITH {RATINGS}, {ITEM_SIMS}, {ITEM_RECS} SELECT user_id, item_id, round(score, 5) AS score,
      CAST(rnk AS INTEGER) AS rank FROM recs""",
    "c09_users": "SELECT DISTINCT user_id FROM events",
}
