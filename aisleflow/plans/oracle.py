"""DuckDB statements that re-state the tier-S queries over the driver's
tables (views region .. conversations).  Column names equal the Spark
results'; doubles are rounded the same way on both sides."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ITEMS = """(SELECT p_partkey AS i_item_id,
        CAST(p_partkey % 20 AS INTEGER) AS i_category_id,
        'cat#' || lpad(CAST(CAST(p_partkey % 20 AS INTEGER) AS VARCHAR), 2, '0') AS i_category_name,
        CAST((p_size - 1) % 20 + 1 AS INTEGER) AS i_class_id,
        p_brand AS i_brand
   FROM part)"""

STORE_SALES = """(SELECT l_orderkey AS ss_transaction_id, o_custkey AS ss_customer_id,
        l_partkey AS ss_item_id
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

CLICKS = """(SELECT event_id AS wl_id, user_id AS wl_customer_id,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS wl_item_id,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS wl_timestamp
   FROM events)"""

ORACLE_SQL["items_dim"] = f"SELECT * FROM {ITEMS}"
ORACLE_SQL["store_sales_view"] = f"SELECT * FROM {STORE_SALES}"
ORACLE_SQL["clicks_extract"] = f"SELECT * FROM {CLICKS} WHERE wl_customer_id IS NOT NULL"


def _class_pivot(categories: list[str]) -> str:
    cols = ",\n       ".join(
        f"count(CASE WHEN i.i_class_id = {c} THEN 1 END) AS id{c}" for c in range(1, 17))
    cats = ", ".join(f"'{c}'" for c in categories)
    return f"""SELECT ss.ss_customer_id AS cid,
       {cols}
  FROM {STORE_SALES} ss JOIN {ITEMS} i ON ss.ss_item_id = i.i_item_id
 WHERE i.i_category_name IN ({cats}) AND ss.ss_customer_id IS NOT NULL
 GROUP BY ss.ss_customer_id
HAVING count(ss.ss_item_id) > 3"""


# The category lists of the class pivot, corrected and as first written.
CATEGORIES = ["cat#01", "cat#02", "cat#03", "cat#04", "cat#05", "cat#06", "cat#07", "cat#08",
              "cat#09", "cat#10", "cat#11", "cat#12", "cat#13", "cat#14", "cat#15"]
ORIGINAL_CATEGORIES = ["cat#01", "cat#02", "cat#03", "cat#04", "cat#05", "cat#06", "cat#07", "cat#08",
                       "cat#09", "cat#10", "cat#11", "cat#12", "cat#013", "cat#14", "cat#15"]
ORACLE_SQL["customer_class_pivot"] = _class_pivot(CATEGORIES)
ORACLE_SQL["customer_class_pivot_original"] = _class_pivot(ORIGINAL_CATEGORIES)

CATEGORY_CLICKS = "(SELECT c.wl_customer_id,\n       " + ",\n       ".join(
    f"CAST(sum(CASE WHEN i.i_category_id = {n} THEN 1 ELSE 0 END) AS BIGINT) AS clicks_in_{n}"
    for n in range(20)) + f"""
  FROM {CLICKS} c JOIN {ITEMS} i ON c.wl_item_id = i.i_item_id
 WHERE c.wl_customer_id IS NOT NULL AND i.i_category_id IS NOT NULL
 GROUP BY c.wl_customer_id)"""

ORACLE_SQL["category_clicks"] = f"SELECT * FROM {CATEGORY_CLICKS}"
ORACLE_SQL["category_clicks_stream"] = ORACLE_SQL["category_clicks"]
# Fixed value: the click threshold of the interest label.
CLICK_THRESHOLD = 3.871510156577754
_CLICK_FEATS = ", ".join(f"clicks_in_{n}" for n in range(1, 20))
ORACLE_SQL["click_label"] = f"""SELECT wl_customer_id,
       CASE WHEN clicks_in_0 > {CLICK_THRESHOLD} THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
       {_CLICK_FEATS}
  FROM {CATEGORY_CLICKS}"""
ORACLE_SQL["click_label_by_mean"] = f"""WITH cc AS {CATEGORY_CLICKS}
SELECT wl_customer_id,
       CASE WHEN clicks_in_0 > (SELECT avg(clicks_in_0) FROM cc) THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
       {_CLICK_FEATS}
  FROM cc"""

# --- readers ----------------------------------------------------------------
ORACLE_SQL["delimited_roundtrip"] = ORACLE_SQL["items_dim"]
ORACLE_SQL["delimited_swapped_headers"] = ORACLE_SQL["store_sales_view"]
ORACLE_SQL["json_roundtrip"] = f"SELECT wl_customer_id, wl_item_id FROM {CLICKS}"

# --- reviews ----------------------------------------------------------------
REVIEWS = """(SELECT d.doc_id AS pr_review_id,
        CAST(CASE WHEN l.quality = 0 AND l.toxic = 1 THEN 1
                  WHEN l.quality = 0 THEN 2
                  WHEN l.toxic = 1 THEN 3
                  ELSE 4 + d.doc_id % 2 END AS INTEGER) AS pr_rating,
        d.text AS pr_content
   FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

REVIEW_TEXTS = "(SELECT doc_id AS pr_review_id, text AS pr_content FROM documents)"

# The label encodings of a rating.
BAYES_LABEL = ("CASE pr_rating WHEN 1 THEN 0.0 WHEN 2 THEN 0.0 WHEN 3 THEN 1.0 "
               "WHEN 4 THEN 2.0 WHEN 5 THEN 2.0 END::DOUBLE")
LOGISTIC_LABEL = ("CASE pr_rating WHEN 1 THEN 0.0 WHEN 2 THEN 0.0 WHEN 3 THEN 1.0 "
                  "WHEN 4 THEN 3.0 WHEN 5 THEN 3.0 END::DOUBLE")
BINARY_LABEL = ("CASE pr_rating WHEN 1 THEN 0.0 WHEN 2 THEN 0.0 WHEN 3 THEN 0.0 "
                "WHEN 4 THEN 1.0 WHEN 5 THEN 1.0 END::DOUBLE")
SENTIMENT = ("CASE pr_rating WHEN 1 THEN 'NEG' WHEN 2 THEN 'NEG' WHEN 3 THEN 'NEU' "
             "WHEN 4 THEN 'POS' WHEN 5 THEN 'POS' END")

REVIEW_LABELS = f"""(SELECT pr_review_id, pr_rating,
        {BAYES_LABEL} AS label, {SENTIMENT} AS sentiment, pr_content AS sentence
   FROM {REVIEWS})"""

# The bucket filter of the review jobs.
ORACLE_SQL["review_labels"] = f"""SELECT * FROM {REVIEW_LABELS}
 WHERE label IS NOT NULL AND ((pr_review_id % 5) + 5) % 5 IN (1, 2, 3)"""
ORACLE_SQL["review_label_encodings"] = f"""SELECT pr_review_id, pr_rating, {BAYES_LABEL} AS bayes,
       {LOGISTIC_LABEL} AS logistic, {BINARY_LABEL} AS binary, {SENTIMENT} AS sentiment FROM {REVIEWS}"""
HASH_BUCKET = "(CAST('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 4) AS INTEGER) % 10)"
ORACLE_SQL["hash_split"] = f"""SELECT pr_review_id, {HASH_BUCKET.format(k='pr_review_id')} AS bucket,
       CASE WHEN {HASH_BUCKET.format(k='pr_review_id')} < 6 THEN 'train' ELSE 'test' END AS split
  FROM {REVIEW_TEXTS}"""
ORACLE_SQL["random_split_check"] = "SELECT doc_id AS pr_review_id, count(*) AS sides FROM documents GROUP BY doc_id"
ORACLE_SQL["sample_head"] = f"""SELECT pr_review_id, label, sentence FROM {REVIEW_LABELS}
 WHERE label IS NOT NULL ORDER BY pr_review_id LIMIT 5"""
ORACLE_SQL["label_index"] = f"""SELECT sentiment AS label,
       CAST(row_number() OVER (ORDER BY count(*) DESC, sentiment) - 1 AS DOUBLE) AS label_index,
       count(*) AS n
  FROM {REVIEW_LABELS} WHERE label IS NOT NULL AND sentiment IS NOT NULL GROUP BY sentiment"""
ORACLE_SQL["categorical_features"] = f"""WITH cl AS (SELECT * FROM {CATEGORY_CLICKS}),
long AS (UNPIVOT (SELECT {_CLICK_FEATS} FROM cl) ON {_CLICK_FEATS} INTO NAME feature VALUE value)
SELECT feature, count(DISTINCT value) AS n_distinct, count(DISTINCT value) <= 20 AS is_categorical
  FROM long GROUP BY feature"""



def _categorical_map(source: str, features: str, max_categories: int) -> str:
    return f"""WITH long AS (UNPIVOT (SELECT {features} FROM {source}) ON {features} INTO NAME feature VALUE value),
v AS (SELECT DISTINCT feature, value FROM long),
few AS (SELECT feature FROM v GROUP BY feature HAVING count(*) <= {max_categories})
SELECT feature, value::DOUBLE AS value,
       CAST(row_number() OVER (PARTITION BY feature ORDER BY value <> 0, value) - 1 AS INTEGER) AS category_index
  FROM v JOIN few USING (feature)"""


ORACLE_SQL["categorical_map_20"] = _categorical_map(CATEGORY_CLICKS, _CLICK_FEATS, 20)
ORACLE_SQL["categorical_map_4"] = _categorical_map(
    f"(SELECT pr_rating::DOUBLE AS pr_rating, bayes, logistic, \"binary\" FROM ({ORACLE_SQL['review_label_encodings']}))",
    'pr_rating, bayes, logistic, "binary"', 4)

# --- text -------------------------------------------------------------------
WS = "'[ \\t\\n\\x0B\\f\\r]'"


def _tokens(source: str) -> str:
    return f"""(SELECT pr_review_id, CAST(pos AS INTEGER) AS pos, token FROM (
    SELECT pr_review_id,
           unnest(generate_series(0, len(t) - 1)) AS pos,
           unnest(t) AS token
      FROM (SELECT pr_review_id, CASE WHEN low <> '' AND cut = '' THEN CAST([] AS VARCHAR[]) ELSE regexp_split_to_array(cut, {WS}) END AS t
              FROM (SELECT pr_review_id, lower(pr_content) AS low, regexp_replace(lower(pr_content), '[ \\t\\n\\x0B\\f\\r]+$', '') AS cut
                      FROM {source}))))"""


TOKENS = _tokens(REVIEW_TEXTS)


def _stop_list() -> str:
    from aisleflow.functions.text import STOP_WORDS
    return ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)


TOKENS_NS = f"(SELECT * FROM {TOKENS} WHERE token NOT IN ({_stop_list()}))"
ORACLE_SQL["tokens"] = f"SELECT * FROM {TOKENS}"
ORACLE_SQL["tokens_no_stopwords"] = f"SELECT * FROM {TOKENS_NS}"
VOCAB = f"""(SELECT term, row_number() OVER (ORDER BY freq DESC, term) - 1 AS term_index,
        freq, doc_freq
   FROM (SELECT term, sum(tf) AS freq, count(*) AS doc_freq
           FROM (SELECT pr_review_id, token AS term, count(*) AS tf
                   FROM {TOKENS_NS} GROUP BY pr_review_id, token)
          GROUP BY term)
)"""
ORACLE_SQL["term_vocabulary"] = f"SELECT term, term_index, CAST(freq AS BIGINT) AS freq, doc_freq FROM {VOCAB}"
ORACLE_SQL["vocab_size"] = f"SELECT count(*) AS vocab_size FROM {VOCAB}"
TF = f"(SELECT pr_review_id, token AS term, count(*) AS tf FROM {TOKENS} GROUP BY pr_review_id, token)"
IDF = f"""(SELECT term, count(*) AS doc_freq,
        ln(((SELECT count(*) FROM {REVIEW_TEXTS}) + 1) / (count(*) + 1)) AS idf
   FROM {TF} GROUP BY term)"""
ORACLE_SQL["term_idf"] = f"SELECT term, doc_freq, round(idf, 9) AS idf FROM {IDF}"
ORACLE_SQL["doc_tfidf"] = f"""SELECT t.pr_review_id, t.term, t.tf, round(t.tf * i.idf, 9) AS tfidf
  FROM {TF} t JOIN {IDF} i ON t.term = i.term"""

# --- baskets ------------------------------------------------------------------
SALES_ITEMS = f"(SELECT ss.*, i.* FROM {STORE_SALES} ss JOIN {ITEMS} i ON ss.ss_item_id = i.i_item_id)"
ORACLE_SQL["baskets"] = f"""SELECT ss_transaction_id, list_sort(list(DISTINCT ss_item_id)) AS items
  FROM {SALES_ITEMS} GROUP BY ss_transaction_id"""
ORACLE_SQL["brand_baskets"] = f"""SELECT ss_transaction_id, list_sort(list(DISTINCT i_brand)) AS items
  FROM {SALES_ITEMS} GROUP BY ss_transaction_id"""
ORACLE_SQL["customers_per_category"] = f"""SELECT DISTINCT i.i_category_id, c.wl_customer_id
  FROM {CLICKS} c JOIN {ITEMS} i ON c.wl_item_id = i.i_item_id
 WHERE c.wl_customer_id IS NOT NULL AND i.i_category_id IS NOT NULL"""


BRAND_ROWS = f"SELECT DISTINCT ss_transaction_id AS t, i_brand AS item FROM {SALES_ITEMS}"


def _itemsets(min_support: float, baskets: str = "") -> str:
    """Frequent itemsets of every size over brand baskets: a recursive CTE
    lists each subset of each basket's frequent items once (items in
    increasing order), then subsets are counted."""
    return f"""WITH RECURSIVE b AS ({baskets or BRAND_ROWS}),
mc AS (SELECT ceil({min_support}::DOUBLE * count(DISTINCT t)) AS m FROM b),
s1 AS (SELECT item, count(*) AS freq FROM b GROUP BY item HAVING count(*) >= (SELECT m FROM mc)),
bf AS (SELECT * FROM b WHERE item IN (SELECT item FROM s1)),
occ(t, items) AS (SELECT t, [item] FROM bf
                  UNION ALL
                  SELECT o.t, list_append(o.items, x.item)
                    FROM occ o JOIN bf x ON o.t = x.t AND x.item > o.items[-1]),
sets AS (SELECT items, count(*) AS freq FROM occ GROUP BY items
         HAVING count(*) >= (SELECT m FROM mc))"""


ORACLE_SQL["frequent_itemsets"] = _itemsets(0.01) + "\nSELECT items, CAST(len(items) AS INTEGER) AS size, freq FROM sets"
ORACLE_SQL["frequent_itemsets_rdd_variant"] = _itemsets(0.004) + "\nSELECT items, CAST(len(items) AS INTEGER) AS size, freq FROM sets"


ORACLE_SQL["frequent_itemsets_no_join"] = _itemsets(
    0.004, "SELECT DISTINCT l_orderkey AS t, l_suppkey AS item FROM lineitem") + """
SELECT items, CAST(len(items) AS INTEGER) AS size, freq FROM sets"""


def _rules(min_support: float, min_conf: float) -> str:
    return _itemsets(min_support) + f""",
n AS (SELECT count(DISTINCT t) AS n FROM b),
cand AS (SELECT s.items, s.freq, u.c AS consequent,
                list_filter(s.items, lambda x: x <> u.c) AS antecedent
           FROM sets s, (SELECT unnest(items) AS c, items AS k FROM sets WHERE len(items) > 1) u
          WHERE u.k = s.items),
rules AS (SELECT c.antecedent, c.consequent,
                 c.freq::DOUBLE / a.freq AS confidence,
                 (c.freq::DOUBLE / a.freq) / (one.freq::DOUBLE / (SELECT n FROM n)) AS lift,
                 c.freq::DOUBLE / (SELECT n FROM n) AS support
            FROM cand c JOIN sets a ON a.items = c.antecedent
                        JOIN sets one ON one.items = [c.consequent]
           WHERE c.freq::DOUBLE / a.freq >= {min_conf})"""


ORACLE_SQL["association_rules"] = _rules(0.01, 0.9) + """
SELECT antecedent, consequent, round(confidence, 9) AS confidence, round(lift, 9) AS lift,
       round(support, 9) AS support FROM rules"""
ORACLE_SQL["association_rules_conf10"] = _rules(0.01, 0.1) + """
SELECT antecedent, consequent, round(confidence, 9) AS confidence, round(lift, 9) AS lift,
       round(support, 9) AS support FROM rules"""
ORACLE_SQL["association_rules_pairs"] = _rules(0.004, 0.15) + """
SELECT antecedent, consequent, round(confidence, 9) AS confidence, round(lift, 9) AS lift,
       round(support, 9) AS support FROM rules"""
ORACLE_SQL["rules_view"] = ORACLE_SQL["association_rules_pairs"]
ORACLE_SQL["basket_recommendations"] = _rules(0.004, 0.15) + """,
bl AS (SELECT t, list(item) AS basket FROM b GROUP BY t)
SELECT bl.t AS ss_transaction_id, list_sort(list(DISTINCT r.consequent)) AS prediction
  FROM bl JOIN rules r ON list_has_all(bl.basket, r.antecedent)
 WHERE NOT list_contains(bl.basket, r.consequent)
 GROUP BY bl.t"""

# --- profiles -----------------------------------------------------------------
ORACLE_SQL["column_profile"] = """SELECT 'o_totalprice' AS column_name, count(o_totalprice) AS count,
       round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS stddev,
       min(o_totalprice)::DOUBLE AS min, max(o_totalprice)::DOUBLE AS max FROM orders
UNION ALL
SELECT 'o_custkey', count(o_custkey), round(avg(o_custkey::DOUBLE), 4), round(stddev_samp(o_custkey::DOUBLE), 4),
       min(o_custkey)::DOUBLE, max(o_custkey)::DOUBLE FROM orders"""

# --- naive Bayes twin ---------------------------------------------------------
NB_CTE = f"""WITH r AS (SELECT pr_review_id,
        {BAYES_LABEL} AS label,
        {HASH_BUCKET.format(k='pr_review_id')} AS bucket
   FROM {REVIEWS}),
train AS (SELECT pr_review_id, label FROM r WHERE label IS NOT NULL AND bucket < 6),
test AS (SELECT pr_review_id, label FROM r WHERE label IS NOT NULL AND bucket >= 6),
tf AS (SELECT pr_review_id, token AS term, count(*) AS tf FROM {_tokens(REVIEWS)} GROUP BY pr_review_id, token),
tft AS (SELECT * FROM tf WHERE pr_review_id IN (SELECT pr_review_id FROM train)),
idf AS (SELECT term, ln(((SELECT count(*) FROM train) + 1) / (count(*) + 1)) AS idf
          FROM tft GROUP BY term),
xt AS (SELECT t.pr_review_id, t.term, t.tf * i.idf AS x FROM tft t JOIN idf i ON t.term = i.term),
k AS (SELECT (SELECT count(*) FROM train) AS n, (SELECT count(DISTINCT label) FROM train) AS c,
             (SELECT count(*) FROM idf) AS v),
nc AS (SELECT label, count(*) AS n_docs FROM train GROUP BY label),
scj AS (SELECT tr.label, xt.term, sum(xt.x) AS s_cj
          FROM xt JOIN train tr ON xt.pr_review_id = tr.pr_review_id GROUP BY 1, 2),
sc AS (SELECT label, sum(s_cj) AS s_c FROM scj GROUP BY label),
priors AS (SELECT nc.label, nc.n_docs,
                  ln(nc.n_docs + 1.0) - ln(k.n + 1.0 * k.c) AS pi,
                  ln(1.0) - ln(coalesce(sc.s_c, 0.0) + 1.0 * k.v) AS theta_unseen,
                  coalesce(sc.s_c, 0.0) AS s_c
             FROM nc LEFT JOIN sc ON nc.label = sc.label, k),
lik AS (SELECT scj.label, scj.term, ln(scj.s_cj + 1.0) - ln(p.s_c + 1.0 * k.v) AS theta,
               ln(scj.s_cj + 1.0) - ln(p.s_c + 1.0 * k.v) - p.theta_unseen AS delta
          FROM scj JOIN priors p ON scj.label = p.label, k),
xtest AS (SELECT t.pr_review_id, t.term, t.tf * i.idf AS x
            FROM tf t JOIN idf i ON t.term = i.term
           WHERE t.pr_review_id IN (SELECT pr_review_id FROM test)),
xs AS (SELECT pr_review_id, sum(x) AS xsum FROM xtest GROUP BY 1),
contrib AS (SELECT x.pr_review_id, l.label, sum(x.x * l.delta) AS s
              FROM xtest x JOIN lik l ON x.term = l.term GROUP BY 1, 2),
scores AS (SELECT t.pr_review_id, t.label, p.label AS cls,
                  p.pi + p.theta_unseen * coalesce(xs.xsum, 0.0) + coalesce(c.s, 0.0) AS score
             FROM test t CROSS JOIN priors p
             LEFT JOIN xs ON xs.pr_review_id = t.pr_review_id
             LEFT JOIN contrib c ON c.pr_review_id = t.pr_review_id AND c.label = p.label),
pred AS (SELECT pr_review_id, label, min(cls) FILTER (WHERE score = best) AS prediction
           FROM (SELECT *, max(score) OVER (PARTITION BY pr_review_id) AS best FROM scores)
          GROUP BY pr_review_id, label)"""

ORACLE_SQL["nb_priors"] = NB_CTE + """
SELECT label, n_docs, round(pi, 9) AS pi, round(theta_unseen, 9) AS theta_unseen FROM priors"""
ORACLE_SQL["nb_likelihoods"] = NB_CTE + "\nSELECT label, term, round(theta, 6) AS theta FROM lik"
ORACLE_SQL["nb_predictions"] = NB_CTE + "\nSELECT pr_review_id, label, prediction FROM pred"
ORACLE_SQL["nb_scores"] = NB_CTE + """
SELECT pr_review_id, cls AS class, round(score, 6) AS score,
       round(exp(score - best) / sum(exp(score - best)) OVER (PARTITION BY pr_review_id), 9) AS probability
  FROM (SELECT *, max(score) OVER (PARTITION BY pr_review_id) AS best FROM scores)"""
ORACLE_SQL["prediction_histogram"] = NB_CTE + "\nSELECT prediction AS value, count(*) AS n FROM pred GROUP BY 1"
ORACLE_SQL["confusion_matrix"] = NB_CTE + "\nSELECT label, prediction, count(*) AS n FROM pred GROUP BY 1, 2"
ORACLE_SQL["accuracy"] = NB_CTE + """
SELECT count(*) AS n, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END::DOUBLE), 9) AS accuracy FROM pred"""
ORACLE_SQL["test_error"] = NB_CTE + """
SELECT round(1.0 - avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END::DOUBLE), 9) AS test_error FROM pred"""
ORACLE_SQL["rmse"] = NB_CTE + """
SELECT round(sqrt(avg((prediction - label) * (prediction - label))), 9) AS rmse FROM pred"""
PER_LABEL = """,
cm AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY 1, 2),
tot AS (SELECT sum(n) AS total FROM cm),
bl AS (SELECT label, sum(n) AS n, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM cm GROUP BY label),
bp AS (SELECT prediction AS label, sum(n) AS n_pred FROM cm GROUP BY prediction),
m AS (SELECT bl.label, bl.n, bl.tp, coalesce(bp.n_pred, 0) AS n_pred FROM bl LEFT JOIN bp ON bl.label = bp.label),
per AS (SELECT label, CAST(n AS BIGINT) AS n, CAST(tp AS BIGINT) AS tp, CAST(n_pred - tp AS BIGINT) AS fp,
               CAST(n - tp AS BIGINT) AS fn,
               CASE WHEN n_pred = 0 THEN 0.0 ELSE tp::DOUBLE / n_pred END AS precision,
               CASE WHEN n = 0 THEN 0.0 ELSE tp::DOUBLE / n END AS recall,
               CASE WHEN (SELECT total FROM tot) - n = 0 THEN 0.0
                    ELSE (n_pred - tp)::DOUBLE / ((SELECT total FROM tot) - n) END AS fpr
          FROM m),
per2 AS (SELECT *, recall AS tpr,
                CASE WHEN precision + recall = 0 THEN 0.0
                     ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM per)"""
ORACLE_SQL["per_label_metrics"] = NB_CTE + PER_LABEL + """
SELECT label, n, tp, fp, fn, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(tpr, 9) AS tpr, round(fpr, 9) AS fpr, round(f1, 9) AS f1 FROM per2"""
ORACLE_SQL["weighted_metrics"] = NB_CTE + PER_LABEL + """,
w AS (SELECT *, n::DOUBLE / sum(n) OVER () AS wt FROM per2)
SELECT round(sum(tp)::DOUBLE / sum(n), 9) AS accuracy,
       round(sum(wt * precision), 9) AS weighted_precision,
       round(sum(wt * recall), 9) AS weighted_recall,
       round(sum(wt * recall), 9) AS weighted_tpr,
       round(sum(wt * fpr), 9) AS weighted_fpr,
       round(sum(wt * f1), 9) AS weighted_f1 FROM w"""


# --- Lloyd twin and silhouette -------------------------------------------------
def _lloyd_sql(k: int = 4, steps: int = 5) -> str:
    feats = [f"id{c}" for c in range(1, 17)]
    fl = ", ".join(feats)
    parts = [f"p AS ({ORACLE_SQL['customer_class_pivot']})",
             f"c0 AS (SELECT CAST(row_number() OVER (ORDER BY cid) - 1 AS INTEGER) AS cluster, "
             + ", ".join(f"{f}::DOUBLE AS {f}" for f in feats)
             + f" FROM (SELECT * FROM p ORDER BY cid LIMIT {k}))"]

    def assign(s):
        dist = " + ".join(f"(p.{f} - c.{f}) * (p.{f} - c.{f})" for f in feats)
        return (f"a{s} AS (SELECT cid, {fl}, cluster FROM ("
                f"SELECT p.*, c.cluster, row_number() OVER (PARTITION BY p.cid ORDER BY "
                f"round({dist}, 9), c.cluster) AS rk FROM p CROSS JOIN c{s} c) WHERE rk = 1)")

    for s in range(steps):
        parts.append(assign(s))
        parts.append(
            f"c{s + 1} AS (SELECT c.cluster, "
            + ", ".join(f"coalesce(n.{f}, c.{f}) AS {f}" for f in feats)
            + f" FROM c{s} c LEFT JOIN (SELECT cluster, "
            + ", ".join(f"avg({f}) AS {f}" for f in feats)
            + f" FROM a{s} GROUP BY cluster) n ON c.cluster = n.cluster)")
    parts.append(assign(steps))
    return "WITH " + ",\n".join(parts)


def _silhouette_sql(k: int = 4, steps: int = 5) -> str:
    feats = [f"id{c}" for c in range(1, 17)]
    a = f"a{steps}"
    sq = " + ".join(f"{f}::DOUBLE * {f}::DOUBLE" for f in feats)
    dot = " + ".join(f"x.{f}::DOUBLE * st.s_{f}" for f in feats)
    return _lloyd_sql(k, steps) + f""",
pts AS (SELECT *, {sq} AS sq FROM {a}),
st AS (SELECT cluster, count(*) AS n, sum(sq) AS q, {", ".join(f"sum({f}::DOUBLE) AS s_{f}" for f in feats)}
         FROM pts GROUP BY cluster),
d AS (SELECT x.cid, x.cluster AS own, st.cluster AS other, st.n AS n,
             (x.sq + (st.q / st.n)) - ((2.0 * ({dot})) / st.n) AS md
        FROM pts x CROSS JOIN st),
s AS (SELECT cid,
             max(CASE WHEN other = own THEN n END) AS own_n,
             max(CASE WHEN other = own THEN md END) AS own_md,
             min(CASE WHEN other <> own THEN md END) AS nb
        FROM d GROUP BY cid),
v AS (SELECT CASE WHEN own_n <= 1 THEN 0.0
                  WHEN (own_md * own_n) / (own_n - 1.0) < nb THEN 1.0 - ((own_md * own_n) / (own_n - 1.0)) / nb
                  WHEN (own_md * own_n) / (own_n - 1.0) > nb THEN nb / ((own_md * own_n) / (own_n - 1.0)) - 1.0
                  ELSE 0.0 END AS sil FROM s)
SELECT round(avg(sil), 6) AS silhouette FROM v"""


ORACLE_SQL["lloyd_centers"] = _lloyd_sql() + """
SELECT cluster, feature, round(value, 6) AS value FROM (UNPIVOT c5 ON """ + ", ".join(
    f"id{c}" for c in range(1, 17)) + " INTO NAME feature VALUE value)"
ORACLE_SQL["lloyd_assignment"] = _lloyd_sql() + "\nSELECT cid, cluster FROM a5"
ORACLE_SQL["silhouette_fixed"] = _silhouette_sql()


# --- gini split table ------------------------------------------------------------
def _gini(n, c0, c1):
    return f"(CASE WHEN {n} = 0 THEN 0.0 ELSE 1.0 - (({c0} / {n}) * ({c0} / {n}) + ({c1} / {n}) * ({c1} / {n})) END)"


GINI = f"""WITH cl AS ({ORACLE_SQL['click_label']}),
long AS (UNPIVOT (SELECT label, {_CLICK_FEATS} FROM cl) ON {_CLICK_FEATS} INTO NAME feature VALUE value),
per AS (SELECT feature, value, count(*) AS n,
               sum(CASE WHEN label = 0.0 THEN 1 ELSE 0 END) AS c0,
               sum(CASE WHEN label = 1.0 THEN 1 ELSE 0 END) AS c1
          FROM long GROUP BY feature, value),
cum AS (SELECT feature, value, lead(value) OVER (PARTITION BY feature ORDER BY value) AS next_value,
               sum(n) OVER w AS nl, sum(n) OVER (PARTITION BY feature) AS nt,
               sum(c0) OVER w AS l0, sum(c1) OVER w AS l1,
               sum(c0) OVER (PARTITION BY feature) AS t0, sum(c1) OVER (PARTITION BY feature) AS t1
          FROM per
        WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT feature, CAST(substr(feature, 11) AS INTEGER) - 1 AS feature_index,
             (value::DOUBLE + next_value::DOUBLE) / 2 AS threshold,
             CAST(nl AS BIGINT) AS n_left, CAST(nt - nl AS BIGINT) AS n_right,
             round({_gini('nt::DOUBLE', 't0::DOUBLE', 't1::DOUBLE')}
                   - (nl::DOUBLE / nt::DOUBLE) * {_gini('nl::DOUBLE', 'l0::DOUBLE', 'l1::DOUBLE')}
                   - ((nt - nl)::DOUBLE / nt::DOUBLE) * {_gini('(nt - nl)::DOUBLE', '(t0 - l0)::DOUBLE', '(t1 - l1)::DOUBLE')}, 9) AS gain
        FROM cum WHERE next_value IS NOT NULL)"""
ORACLE_SQL["gini_splits"] = GINI + "\nSELECT * FROM g"
ORACLE_SQL["gini_best"] = GINI + "\nSELECT * FROM g ORDER BY gain DESC, feature_index, threshold LIMIT 1"


# --- facts of the fits, for every row -----------------------------------------------
PIVOT = f"({ORACLE_SQL['customer_class_pivot']})"
ORACLE_SQL["kmeans_check"] = f"SELECT cid, true AS nearest FROM {PIVOT}"
ORACLE_SQL["gmm_row_check"] = f"SELECT cid, true AS sums_to_one, true AS is_argmax FROM {PIVOT}"
ORACLE_SQL["gmm_component_check"] = """SELECT CAST(c AS INTEGER) AS component, 16 AS dims, true AS symmetric,
       1.0::DOUBLE AS total_weight FROM range(2) r(c)"""
ORACLE_SQL["lda_doc_check"] = "SELECT doc_id AS pr_review_id, 4::BIGINT AS topics, true AS sums_to_one FROM documents WHERE text IS NOT NULL"
ORACLE_SQL["lda_hashed_doc_check"] = ORACLE_SQL["lda_doc_check"].replace("4::BIGINT", "3::BIGINT")
ORACLE_SQL["lda_topics_check"] = """SELECT CAST(t AS INTEGER) AS topic, CAST(r AS INTEGER) AS rank, true AS falling, true AS in_corpus
  FROM range(4) a(t), range(10) b(r)"""
ORACLE_SQL["lda_quality_check"] = f"""SELECT (SELECT count(*) FROM {TOKENS_NS}) AS n_words, (SELECT count(*) FROM {VOCAB}) AS vocab_size, 0::BIGINT AS terms_left_out"""
ORACLE_SQL["topic_model_roundtrip"] = """SELECT doc_id AS pr_review_id, CAST(t AS INTEGER) AS topic, true AS same
  FROM documents, range(4) a(t) WHERE text IS NOT NULL"""
ORACLE_SQL["text_pipeline_roundtrip"] = """SELECT classifier, doc_id AS pr_review_id, true AS same_prediction, true AS same_scores
  FROM documents, (VALUES ('bayes'), ('logistic')) c(classifier)"""
REVIEW_TEST = f"""(SELECT pr_review_id, {BAYES_LABEL} AS label FROM {REVIEWS}
  WHERE {HASH_BUCKET.format(k='pr_review_id')} >= 6)"""
ORACLE_SQL["nb_fit_check"] = f"""SELECT pr_review_id, 3::BIGINT AS classes, true AS sums_to_one, true AS is_argmax
  FROM {REVIEW_TEST} WHERE label IS NOT NULL"""
ORACLE_SQL["text_pipeline_predictions"] = f"SELECT pr_review_id, true AS same FROM {REVIEW_TEST} WHERE label IS NOT NULL"
ORACLE_SQL["logreg_check"] = ORACLE_SQL["nb_fit_check"]
ORACLE_SQL["logreg_binary_check"] = ORACLE_SQL["nb_fit_check"].replace("3::BIGINT", "2::BIGINT")
ORACLE_SQL["logreg_history_check"] = "SELECT true AS never_rises"
ORACLE_SQL["logreg_families"] = """SELECT * FROM (VALUES ('auto', 'num_classes', 3.0::DOUBLE), ('auto', 'num_features', 262144.0),
       ('auto', 'coefficient_rows', 3.0), ('binary', 'num_classes', 2.0), ('binary', 'num_features', 262144.0),
       ('binary', 'coefficient_rows', 1.0)) v(model, name, value)"""


def _click_test(train_buckets: int) -> str:
    return f"(SELECT wl_customer_id FROM {CATEGORY_CLICKS} WHERE {HASH_BUCKET.format(k='wl_customer_id')} >= {train_buckets})"


ORACLE_SQL["tree_check"] = f"SELECT wl_customer_id, 2::BIGINT AS classes, true AS sums_to_one, true AS is_argmax FROM {_click_test(7)}"
ORACLE_SQL["mlp_check"] = f"SELECT wl_customer_id, 2::BIGINT AS classes, true AS sums_to_one, true AS is_argmax FROM {_click_test(6)}"
ORACLE_SQL["svc_check"] = f"SELECT wl_customer_id, true AS sign_is_prediction, true AS margin_is_linear FROM {_click_test(6)}"
ORACLE_SQL["tree_importance_check"] = "SELECT 19::BIGINT AS n, true AS none_negative, true AS sum_to_one"
ORACLE_SQL["tree_root_check"] = GINI + """
SELECT feature_index AS feature, threshold, gain FROM g ORDER BY gain DESC, feature_index, threshold LIMIT 1"""
ORACLE_SQL["model_roundtrip_check"] = """SELECT CAST(c AS INTEGER) AS cluster, 'id' || CAST(f AS VARCHAR) AS feature, true AS equal
  FROM range(4) a(c), range(1, 17) b(f)"""
ORACLE_SQL["run_log_check"] = """SELECT 'customer_segmentation' AS job, * FROM (VALUES ('k', 4.0::DOUBLE), ('initSteps', 5.0),
       ('maxIter', 20.0), ('tol', 0.01), ('seed', 1234138471039.0)) v(name, value)"""
ORACLE_SQL["silhouette_sweep"] = " UNION ALL ".join(f"SELECT {k} AS k, silhouette FROM ({_silhouette_sql(k)})" for k in range(2, 15))
ORACLE_SQL["silhouette_best_k"] = f"SELECT k, silhouette FROM ({ORACLE_SQL['silhouette_sweep']}) ORDER BY silhouette DESC, k LIMIT 1"
ORACLE_SQL["gmm_density_check"] = f"SELECT cid, true AS same FROM {PIVOT}"
ORACLE_SQL["gmm_likelihood_check"] = f"SELECT count(*) AS n, true AS equal FROM {PIVOT}"
REVIEW_TRAIN = REVIEW_TEST.replace(">= 6", "< 6")
ORACLE_SQL["logreg_objective_check"] = f"""SELECT model, count(*) AS n, true AS equal
  FROM {REVIEW_TRAIN}, (VALUES ('multinomial'), ('binary')) m(model) WHERE label IS NOT NULL GROUP BY model"""
ORACLE_SQL["tree_nodes_check"] = f"""SELECT count(*) AS at_root, count(*) AS at_leaves, 0::BIGINT AS differing
  FROM {_click_test(7).replace(">= 7", "< 7")}"""
