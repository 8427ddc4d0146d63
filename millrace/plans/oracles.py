"""DuckDB SQL for the registered queries, written from the definitions."""

from __future__ import annotations

SQL: dict[str, str] = {}

PUR = """pur AS (SELECT o_custkey AS "user", l_partkey AS product, l_extendedprice AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

RAT = """rat AS (SELECT o_custkey AS userid, l_partkey AS itemid, avg(l_quantity) AS pref
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""

# the same with ids as text
RAT_TEXT = """rat AS (SELECT o_custkey::VARCHAR AS userid, l_partkey::VARCHAR AS itemid,
    avg(l_quantity) AS pref
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""

SIM = """cnt AS (SELECT itemid, count(*) AS n FROM rat GROUP BY itemid),
co AS (SELECT a.itemid AS itemid1, b.itemid AS itemid2, count(*) AS together
  FROM rat a JOIN rat b ON a.userid = b.userid AND a.itemid <> b.itemid GROUP BY ALL),
sim AS (SELECT itemid1, itemid2, together / sqrt(c1.n * c2.n) AS "similar"
  FROM co JOIN cnt c1 ON itemid1 = c1.itemid JOIN cnt c2 ON itemid2 = c2.itemid)"""

REC = """scored AS (SELECT r.userid, s.itemid2 AS itemid, sum(r.pref * s."similar") AS pref
  FROM rat r JOIN sim s ON r.itemid = s.itemid1 GROUP BY ALL),
fresh AS (SELECT * FROM scored WHERE NOT EXISTS (SELECT 1 FROM rat
  WHERE rat.userid = scored.userid AND rat.itemid = scored.itemid)),
rec AS (SELECT userid, itemid, pref,
    row_number() OVER (PARTITION BY userid ORDER BY round(pref, 9) DESC, itemid) AS rank
  FROM fresh QUALIFY rank <= 30)"""

LOG = r"""log AS (SELECT event_id, user_id AS userid,
    regexp_extract(props, '(\d+)', 1)::BIGINT AS itemid,
    concat_ws(chr(9), user_id, regexp_extract(props, '(\d+)', 1), event_type, event_id) AS value,
    row_number() OVER (ORDER BY event_id) - 1 AS pos,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS ordinal
  FROM events),
held AS (SELECT *, sum(CASE WHEN ordinal BETWEEN 1 AND 10 THEN 1 ELSE 0 END)
    OVER (ORDER BY event_id) AS candidates,
  sum(CASE WHEN ordinal BETWEEN 11 AND 20 THEN 1 ELSE 0 END)
    OVER (ORDER BY event_id) AS later_candidates FROM log),
routed AS (SELECT *, ordinal BETWEEN 1 AND 10 AND candidates <= 1000 AS held_out,
  ordinal BETWEEN 11 AND 20 AND later_candidates <= 1000 AS held_later,
  pos * 5 // (SELECT count(*) FROM log) + 1 AS fold FROM held)"""

EMB = """emb AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x,
  generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)"""

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_COLUMNS = " UNION ALL ".join(
    f"SELECT {i}::BIGINT AS i, {c} AS x FROM lineitem" for i, c in enumerate(MEASURES)
)
_PAIRS = [(i, j) for i in range(4) for j in range(4)]


def _pairs(cell: str, keep=lambda i, j: True) -> str:
    """One SELECT per pair of measures; ``cell`` uses {a} and {b}."""
    return " UNION ALL ".join(
        f"SELECT {i}::BIGINT AS i, {j}::BIGINT AS j, "
        + cell.format(a=MEASURES[i], b=MEASURES[j])
        + " AS value FROM lineitem"
        for i, j in _PAIRS
        if keep(i, j)
    )


def _significant(name: str, digits: int = 9) -> str:
    """Significant digits and the magnitude of a column."""
    power = f"floor(log10(abs({name})))"
    return (
        f"CASE WHEN {name} = 0 THEN 0.0 ELSE round({name} / pow(10.0, {power} - {digits - 1}), 0) END AS {name}, "
        f"CASE WHEN {name} = 0 THEN 0 ELSE {power} END::BIGINT AS {name}_magnitude"
    )


def _rounded(name: str, digits: int) -> str:
    return f"round({name}, {digits}) + 0.0 AS {name}"


# --- purchases -----------------------------------------------------------------------------

SQL["parse_purchases"] = """SELECT o_custkey::VARCHAR AS "user", l_partkey::VARCHAR AS product,
  l_extendedprice AS price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
SQL["parse_purchases_rejected"] = """SELECT o_custkey || ',' || l_partkey AS value,
  'fewer than 3 fields' AS reason
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_tax = 0"""
SQL["parse_ratings"] = """SELECT o_custkey::VARCHAR AS userid, l_partkey::VARCHAR AS itemid,
  l_quantity AS pref FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
SQL["purchase_count"] = f"WITH {PUR} SELECT count(*) AS purchases FROM pur"
SQL["unique_users"] = f'WITH {PUR} SELECT count(DISTINCT "user") AS unique_users FROM pur'
SQL["total_revenue"] = f"WITH {PUR} SELECT round(coalesce(sum(price), 0.0), 2) AS revenue FROM pur"
SQL["product_counts"] = (
    f"WITH {PUR} SELECT product, count(*) AS purchases FROM pur GROUP BY product"
)
SQL["most_popular_product"] = f"""WITH {PUR} SELECT product, count(*) AS purchases FROM pur
GROUP BY product ORDER BY purchases DESC, product LIMIT 1"""
_SUMMARY = f"""WITH {PUR}, best AS (SELECT product, count(*) AS n FROM pur GROUP BY product
  ORDER BY n DESC, product LIMIT 1),
summary AS (SELECT count(*) AS purchases, count(DISTINCT "user") AS unique_users,
  round(coalesce(sum(price), 0.0), 2) AS revenue,
  (SELECT product FROM best) AS top_product,
  coalesce((SELECT n FROM best), 0) AS top_purchases FROM pur)"""
SQL["purchase_summary"] = _SUMMARY + " SELECT * FROM summary"
# fixed values: the wording of the report's lines
SQL["purchase_report"] = _SUMMARY + """ SELECT
  printf('Total purchases: %d', purchases) AS purchases_line,
  printf('Unique users: %d', unique_users) AS users_line,
  printf('Total revenue: %.2f', revenue) AS revenue_line,
  printf('Most popular product: %s with %d purchases', top_product::VARCHAR, top_purchases)
    AS product_line FROM summary"""
SQL["sketched_users"] = """SELECT year(o_orderdate)::INTEGER AS year,
  count(DISTINCT o_custkey) AS exact_users, TRUE AS near FROM orders GROUP BY year(o_orderdate)"""
SQL["windowed_purchases"] = """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day,
  event_type AS product, count(*) AS purchases, round(sum(value), 4) + 0.0 AS revenue
FROM events
GROUP BY date_trunc('day', ts), event_type"""

# events that come again count only while their window is open: an hour after the last event of all
_AGAIN = """again AS (SELECT *, date_trunc('day', ts) + INTERVAL 1 DAY
    <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR AS late FROM events WHERE event_id % 7 = 0)"""
SQL["streaming_purchase_summary"] = f"""WITH {_AGAIN},
streamed AS (SELECT ts, event_type, value FROM events
  UNION ALL SELECT ts, event_type, value FROM again WHERE NOT late)
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type AS product,
  count(*) AS purchases, round(sum(value), 4) + 0.0 AS revenue
FROM streamed GROUP BY date_trunc('day', ts), event_type"""
SQL["streaming_late_rows"] = f"""WITH {_AGAIN}
SELECT event_id, event_type AS product, value AS price FROM again WHERE late"""

# --- ordered log and splits ----------------------------------------------------------------

SQL["row_position"] = f"WITH {LOG} SELECT event_id, pos FROM log"
SQL["user_ordinal"] = f"WITH {LOG} SELECT event_id, userid, ordinal FROM log"
SQL["capped_running_count"] = f"""WITH {LOG}
SELECT event_id, ordinal, least(candidates, 1000)::BIGINT AS held FROM held"""
SQL["route_rows"] = f"WITH {LOG} SELECT event_id, ordinal, held_out::INTEGER AS held_out FROM routed"
SQL["split_leave_range"] = f"""WITH {LOG} SELECT event_id, userid, value,
  CASE WHEN held_out THEN 'test' ELSE 'base' END AS part FROM routed"""
SQL["slice_rows"] = (
    f"WITH {LOG} SELECT event_id, pos, value FROM log ORDER BY event_id LIMIT 600 OFFSET 100"
)
SQL["slice_text"] = f"WITH {LOG} SELECT pos, value FROM log WHERE pos BETWEEN 100 AND 699"
SQL["sort_ratings"] = f"""WITH {LOG} SELECT
  row_number() OVER (ORDER BY userid, itemid, value) - 1 AS sort_pos, userid, itemid, value
FROM log"""
for _name, _test in (("kfold_test", "="), ("kfold_base", "<>")):
    SQL[_name] = f"""WITH {LOG} SELECT
      row_number() OVER (ORDER BY userid, itemid, value) - 1 AS sort_pos, fold, pos, value
    FROM routed WHERE fold {_test} 2"""
SQL["split_suite"] = f"""WITH {LOG} SELECT event_id, pos, fold, held_out::INTEGER AS in_ua,
  held_later::INTEGER AS in_ub FROM routed"""
SQL["read_rating_log"] = f"""WITH {LOG} SELECT pos, userid::VARCHAR AS userid,
  itemid::VARCHAR AS itemid, value FROM log"""
SQL["write_split"] = f"""WITH {LOG},
parts AS (SELECT *, CASE WHEN held_out THEN 'test' ELSE 'base' END AS part FROM routed)
SELECT part, row_number() OVER (PARTITION BY part ORDER BY event_id) - 1 AS pos, value FROM parts"""
SQL["write_sorted"] = f"""WITH {LOG}
SELECT row_number() OVER (ORDER BY userid, itemid, value) - 1 AS pos, value FROM log"""
SQL["read_rating_logs"] = f"""WITH {LOG}
SELECT row_number() OVER (ORDER BY event_id % 2 DESC, event_id) - 1 AS pos,
  userid::VARCHAR AS userid, itemid::VARCHAR AS itemid, value FROM log"""
_OUTPUTS = " UNION ALL ".join(
    [
        f"SELECT 'u{k}.' || CASE WHEN fold = {k} THEN 'test' ELSE 'base' END AS split, * FROM routed"
        for k in range(1, 6)
    ]
    + [
        f"SELECT '{name}.' || CASE WHEN {held} THEN 'test' ELSE 'base' END AS split, * FROM routed"
        for name, held in (("ua", "held_out"), ("ub", "held_later"))
    ]
)
SQL["sorted_splits"] = f"""WITH {LOG}, outputs AS ({_OUTPUTS})
SELECT split, row_number() OVER (PARTITION BY split ORDER BY userid, itemid, value) - 1 AS pos, value
FROM outputs"""
SQL["read_document_tree"] = """SELECT lang, doc_id, sha256(coalesce(text, '')) AS text_sha256
FROM documents"""
SQL["read_document_files"] = SQL["read_document_tree"]
SQL["read_dimension_names"] = "SELECT r_name AS name FROM region"
SQL["read_dimension_counts"] = """SELECT count(*) AS n, n_name || ' suppliers' AS label
FROM nation JOIN supplier ON n_nationkey = s_nationkey GROUP BY n_name"""
SQL["read_dimension"] = "SELECT n_name AS name, n_nationkey AS id FROM nation"

# --- statistics ----------------------------------------------------------------------------

_GOF = """days AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events),
kinds AS (SELECT DISTINCT event_type FROM events),
seen AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL),
filled AS (SELECT day, event_type, coalesce(n, 0) AS n
  FROM days CROSS JOIN kinds LEFT JOIN seen USING (day, event_type)),
expected AS (SELECT day, avg(n) AS e, count(*) AS categories, sum(n) AS observations
  FROM filled GROUP BY day),
tests AS (SELECT day, any_value(categories) AS categories,
    any_value(observations)::BIGINT AS observations, any_value(categories) - 1 AS df,
    sum((n - e) * (n - e) / e) AS statistic
  FROM filled JOIN expected USING (day) GROUP BY day),
valued AS (SELECT *, exp(-statistic / 2) * (1 + statistic / 2) AS p_value FROM tests)"""
SQL["chisq_gof"] = f"""WITH {_GOF} SELECT day, categories, observations, df,
  {_rounded("statistic", 9)} FROM tests"""
SQL["chisq_pvalue"] = f"WITH {_GOF} SELECT day, df, {_rounded('p_value', 9)} FROM valued"
# fixed values: the method's name, the hypothesis and the wording of the outcomes
SQL["chisq_verdict"] = f"""WITH {_GOF} SELECT day, 'pearson' AS method,
  'observed follows the same distribution as expected.' AS null_hypothesis,
  CASE WHEN p_value <= 0.01 THEN 'Very strong' WHEN p_value <= 0.05 THEN 'Strong'
    WHEN p_value <= 0.1 THEN 'Low' ELSE 'No' END
  || ' presumption against null hypothesis' AS verdict FROM valued"""
# 1 - erf(z), with erf(z) = exp(-z^2) * sum(z^(2m+1) / gamma(m + 3/2))
SQL["chisq_pvalue_odd"] = """WITH seen AS (SELECT l_suppkey,
    count(*) FILTER (l_linestatus = 'O') AS a, count(*) FILTER (l_linestatus = 'F') AS b
  FROM lineitem GROUP BY l_suppkey),
tests AS (SELECT l_suppkey, a + b AS observations,
    (pow(a - (a + b) / 2, 2) + pow(b - (a + b) / 2, 2)) / ((a + b) / 2) AS statistic FROM seen)
SELECT l_suppkey, 2::BIGINT AS categories, observations, 1::BIGINT AS df,
  round(statistic, 9) + 0.0 AS statistic,
  round(1 - CASE WHEN statistic = 0 THEN 0.0 ELSE list_sum(list_transform(range(0, 200),
    lambda m: exp((m + 0.5) * ln(statistic / 2) - lgamma(m + 1.5) - statistic / 2))) END, 9) + 0.0
    AS p_value
FROM tests"""
# upper tail at three degrees of freedom: 1 - sum(h^(m + 3/2) exp(-h) / gamma(m + 5/2)), h = x / 2
SQL["chisq_pvalue_df3"] = """WITH seen AS (SELECT l_suppkey, quarter(l_shipdate) AS kind,
    count(*) AS n FROM lineitem GROUP BY ALL),
tests AS (SELECT l_suppkey, sum(n)::BIGINT AS observations,
    (4 * sum(n * n) - sum(n) * sum(n)) / sum(n) AS statistic FROM seen GROUP BY l_suppkey)
SELECT l_suppkey, 4::BIGINT AS categories, observations, 3::BIGINT AS df,
  round(statistic, 9) + 0.0 AS statistic,
  round(1 - CASE WHEN statistic = 0 THEN 0.0 ELSE list_sum(list_transform(range(0, 300),
    lambda m: exp((m + 1.5) * ln(statistic / 2) - lgamma(m + 2.5) - statistic / 2))) END, 9) + 0.0
    AS p_value
FROM tests"""
SQL["chisq_gof_vectors"] = f"""WITH counts AS (SELECT o_custkey, quarter(o_orderdate) AS q,
    count(*) AS n FROM orders GROUP BY ALL)
SELECT o_custkey, 3::BIGINT AS df,
  {_rounded("(4 * sum(n * n) - sum(n) * sum(n)) / sum(n)", 9).replace(
    "AS (4 * sum(n * n) - sum(n) * sum(n)) / sum(n)", "AS statistic")} FROM counts GROUP BY o_custkey"""
SQL["row_matrix"] = """SELECT 4::BIGINT AS n, l_quantity AS f0, l_extendedprice AS f1,
  l_discount AS f2, l_tax AS f3 FROM lineitem"""
SQL["matrix_shape"] = """SELECT count(*) AS n_rows, coalesce(max(len(embedding)), 0)::BIGINT AS n_cols
FROM embeddings"""
SQL["read_numeric_matrix"] = f"""WITH {EMB},
numbered AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS row_id FROM embeddings)
SELECT row_id, i::BIGINT AS component, x AS value FROM emb JOIN numbered USING (vec_id)"""
_STATS = """SELECT i, count(x) AS n, count(*) FILTER (x <> 0) AS non_zeros, max(x) AS max,
  min(x) AS min, avg(x) AS mean, var_samp(x) AS variance, sum(abs(x)) AS l1,
  sqrt(sum(x * x)) AS l2"""
SQL["column_summary"] = f"""WITH cols AS ({_COLUMNS}), stats AS ({_STATS} FROM cols GROUP BY i)
SELECT i, n, non_zeros, max, min, {", ".join(map(_significant, ("mean", "variance", "l1", "l2")))}
FROM stats"""
SQL["column_summary_wide"] = f"""WITH {EMB}, stats AS ({_STATS} FROM emb GROUP BY i)
SELECT i::BIGINT AS i, n, non_zeros,
  {", ".join(_rounded(c, 9) for c in ("max", "min", "mean", "variance", "l1", "l2"))} FROM stats"""
SQL["column_dot"] = f"""WITH dots AS ({_pairs("sum({a} * {b})", lambda i, j: i <= j)})
SELECT i, j, {_significant("value")} FROM dots"""
SQL["gramian"] = f"""WITH dots AS ({_pairs("sum({a} * {b})")})
SELECT i, j, {_significant("value")} FROM dots"""
_WIDE = "FROM emb a JOIN emb b ON a.vec_id = b.vec_id"
SQL["gramian_wide"] = f"""WITH {EMB} SELECT a.i::BIGINT AS i, b.i::BIGINT AS j,
  round(sum(a.x * b.x), 8) + 0.0 AS value {_WIDE} GROUP BY a.i, b.i"""
SQL["covariance"] = f"""WITH cov AS ({_pairs("covar_samp({a}, {b})")})
SELECT i, j, {_rounded("value", 4)} FROM cov"""
SQL["covariance_wide"] = f"""WITH {EMB} SELECT a.i::BIGINT AS i, b.i::BIGINT AS j,
  round(covar_samp(a.x, b.x), 9) + 0.0 AS value {_WIDE} GROUP BY a.i, b.i"""
_COSINE = _pairs("sum({a} * {b}) / sqrt(sum({a} * {a}) * sum({b} * {b}))", lambda i, j: i < j)
SQL["column_cosine"] = f"WITH c AS ({_COSINE}) SELECT i, j, {_rounded('value', 9)} FROM c"
SQL["column_cosine_threshold"] = SQL["column_cosine"] + " WHERE value >= 0.75"
# the coin of a product is an arithmetic hash of row id, i, j and seed 3; 6 columns, threshold 0.1
SQL["column_cosine_sampled"] = """WITH wide AS (
  SELECT l_orderkey * 8 + l_linenumber AS row_id, row_number() OVER () AS n, l_quantity, l_extendedprice, l_discount, l_tax,
    l_quantity - 25.5 AS about_quantity, l_discount - 0.05 AS about_discount FROM lineitem),
cells AS (SELECT n, row_id % 2147483647 AS r, unnest(range(6)) AS i, unnest([l_quantity, l_extendedprice,
    l_discount, l_tax, about_quantity, about_discount]::DOUBLE[]) AS x FROM wide),
peaks AS (SELECT i, max(abs(x)) AS peak, sqrt(sum(x * x)) / max(abs(x)) AS size FROM cells GROUP BY i),
rates AS (SELECT i, least(1, sqrt(10 * ln(6) / 0.1) / size) AS rate,
    least(sqrt(10 * ln(6) / 0.1), size) * peak AS divisor FROM peaks),
scaled AS (SELECT n, r, c.i, x / divisor AS x, rate FROM cells c JOIN rates s ON c.i = s.i),
tossed AS (SELECT a.i AS i, b.i AS j, a.x * b.x AS product, a.rate * b.rate * 2147483647 AS bound,
    (a.r * 48271 + a.i * 69621 + b.i * 40692 + 3) % 2147483647 AS h
  FROM scaled a JOIN scaled b ON a.n = b.n AND a.i < b.i),
coins AS (SELECT i, j, product, bound, (((h * h) % 2147483647) * 16807 + h) % 2147483647 AS coin FROM tossed)
SELECT i::BIGINT AS i, j::BIGINT AS j,
  round(sum(CASE WHEN coin < bound THEN product ELSE 0 END), 9) + 0.0 AS value FROM coins GROUP BY i, j"""
SQL["gramian_blocks"] = """WITH chosen AS (
  SELECT vec_id, c, embedding[c % 64 + 1]::DOUBLE AS a,
    embedding[(c % 64 + c // 64) % 64 + 1]::DOUBLE AS b
  FROM embeddings, (SELECT 509 * k AS c FROM range(17) t(k)) WHERE c < 8192),
cells AS (SELECT vec_id, c, CASE WHEN c < 4096 THEN a * b ELSE a - b END AS x FROM chosen)
SELECT p.c::BIGINT AS i, q.c::BIGINT AS j, round(sum(p.x * q.x), 9) + 0.0 AS value
FROM cells p JOIN cells q ON p.vec_id = q.vec_id GROUP BY p.c, q.c"""
SQL["column_cosine_wide"] = f"""WITH {EMB} SELECT a.i::BIGINT AS i, b.i::BIGINT AS j,
  round(sum(a.x * b.x) / sqrt(sum(a.x * a.x) * sum(b.x * b.x)), 9) + 0.0 AS value
{_WIDE} WHERE a.i < b.i GROUP BY a.i, b.i"""

# --- decompositions ------------------------------------------------------------------------

# eigenvalues l0 >= l1 of the symmetric 2 x 2 matrix (a b; b c), and the vector (b, l - a)
_EIGEN = """roots AS (SELECT a, b, (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) AS l0,
  (a + c) / 2 - sqrt((a - c) * (a - c) / 4 + b * b) AS l1 FROM m),
raw AS (SELECT 0 AS component, l0 AS l, l0 + l1 AS trace, b AS v0, l0 - a AS v1 FROM roots
  UNION ALL SELECT 1, l1, l0 + l1, b, l1 - a FROM roots),
signed AS (SELECT component, l, trace,
  CASE WHEN (CASE WHEN abs(v0) >= abs(v1) THEN v0 ELSE v1 END) < 0 THEN -1 ELSE 1 END
    / sqrt(v0 * v0 + v1 * v1) AS s, v0, v1 FROM raw),
entries AS (SELECT 0 AS i, component, v0 * s AS value, l, trace FROM signed
  UNION ALL SELECT 1, component, v1 * s, l, trace FROM signed)"""
_PAIR = "pair AS (SELECT l_quantity / 50 AS x, l_extendedprice / 100000 AS y FROM lineitem)"
SQL["principal_components"] = f"""WITH {_PAIR},
m AS (SELECT var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS c FROM pair), {_EIGEN}
SELECT i::BIGINT AS i, component::BIGINT AS component, {_rounded("value", 6)},
  round(l / trace, 6) + 0.0 AS explained FROM entries"""
SQL["svd"] = f"""WITH {_PAIR},
m AS (SELECT sum(x * x) AS a, sum(x * y) AS b, sum(y * y) AS c FROM pair), {_EIGEN}
SELECT i::BIGINT AS i, component::BIGINT AS component, {_rounded("value", 6)},
  round(sqrt(l), 6) + 0.0 AS sigma FROM entries"""
# with z = x + d y the two values have the product d sqrt(xx yy - xy xy)
SQL["svd_small_values"] = f"""WITH {_PAIR},
m AS (SELECT sum(x * x) AS xx, sum(x * y) AS xy, sum(y * y) AS yy,
    sum((x + 1e-10 * y) * (x + 1e-10 * y)) AS zz FROM pair),
v AS (SELECT 0 AS k, sqrt(xx + zz) AS sigma FROM m
  UNION ALL SELECT 1, 1e-10 * sqrt(xx * yy - xy * xy) / sqrt(xx + zz) FROM m)
SELECT k::BIGINT AS k, {_significant("sigma", 4)} FROM v"""
# a wrong vector leaves a residual, a repeated or scaled one a wrong length or order
SQL["principal_components_measures"] = """SELECT i::BIGINT AS i, c::BIGINT AS component,
  0.0::DOUBLE AS residual, 1.0::DOUBLE AS length, TRUE AS falling
FROM range(4) a(i) CROSS JOIN range(3) b(c)"""
SQL["svd_measures"] = """SELECT i::BIGINT AS i, c::BIGINT AS component,
  0.0::DOUBLE AS residual, 1.0::DOUBLE AS length, 1.0::DOUBLE AS energy
FROM range(4) a(i) CROSS JOIN range(4) b(c)"""
# the squared shares add up to |covariance|^2 / trace^2
SQL["principal_components_wide"] = f"""WITH {EMB},
cov AS (SELECT a.i AS i, b.i AS j, covar_samp(a.x, b.x) AS v {_WIDE} GROUP BY a.i, b.i)
SELECT count(DISTINCT i) AS components, count(DISTINCT i)::DOUBLE AS squared_entries,
  1.0::DOUBLE AS explained,
  round(sum(v * v) / pow(sum(CASE WHEN i = j THEN v END), 2), 8) + 0.0 AS squared_shares FROM cov"""
SQL["svd_energy"] = f"""WITH {EMB} SELECT count(DISTINCT i) AS n_values,
  round(sum(x * x), 6) + 0.0 AS energy FROM emb"""
SQL["svd_left_rows"] = """SELECT a.i, b.i AS j, CASE WHEN a.i = b.i THEN 1.0 ELSE 0.0 END::DOUBLE AS value
FROM range(4) a(i) CROSS JOIN range(4) b(i)"""
SQL["svd_reconstruction"] = f"""WITH {EMB} SELECT vec_id AS row_id, i::BIGINT AS i,
  {_rounded("x", 6).replace("AS x", "AS value")} FROM emb"""
SQL["cumulative_spectrum"] = f"""WITH {EMB},
spectrum AS (SELECT i AS k, sqrt(sum(x * x)) AS sigma FROM emb GROUP BY i),
summed AS (SELECT k, sigma, sum(sigma) OVER (ORDER BY k) AS cumulative,
  sum(sigma) OVER () AS total FROM spectrum)
SELECT k::BIGINT AS k, {_rounded("sigma", 8)}, {_rounded("cumulative", 8)},
  round(cumulative / total, 8) + 0.0 AS share FROM summed"""
SQL["component_grid"] = f"""WITH {EMB} SELECT vec_id AS component, vec_id + 1 AS label,
  (i // 8)::BIGINT AS y, (i % 8)::BIGINT AS x, emb.x AS value FROM emb"""

# --- collaborative filtering ---------------------------------------------------------------

SQL["item_similarity"] = f"""WITH {RAT}, {SIM}
SELECT itemid1, itemid2, round("similar", 9) + 0.0 AS "similar" FROM sim"""
SQL["similarity_size"] = f"WITH {RAT}, {SIM} SELECT count(*) AS pairs FROM sim"
SQL["item_recommend"] = f"""WITH {RAT}, {SIM}, {REC}
SELECT userid, itemid, {_rounded("pref", 6)}, rank FROM rec"""
SQL["recommend_topn"] = f"""WITH {RAT}
SELECT userid, itemid, {_rounded("pref", 6)},
  row_number() OVER (PARTITION BY userid ORDER BY round(pref, 9) DESC, itemid) AS rank
FROM rat QUALIFY rank <= 30"""
SQL["recommendation_size"] = f"WITH {RAT}, {SIM}, {REC} SELECT count(*) AS recommendations FROM rec"
SQL["itemcf_from_lines"] = f"""WITH {RAT_TEXT}, {SIM}, {REC}
SELECT userid, itemid, {_rounded("pref", 6)}, rank FROM rec"""
