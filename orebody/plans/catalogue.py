"""Registered queries of the feature-mining operators over the driver's tables, with DuckDB SQL for each that SQL expresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.config import AutoFeatureConfig, EntityConfig
from orebody.functions.expr import as_double, clip, numeric_columns
from orebody.operators import advanced, composite, decision, filters, profile, stability, synthesis, themes, univariate
from orebody.operators.entity import build_graph, semi_join
from orebody.plans.frames import FRAMES_SQL, MATRIX_SQL, NUMERIC, frames, matrix, table, with_signal

KEY, TARGET = "SK_ID_CURR", "TARGET"
QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Sums of floats depend on their order in the last digits: both engines compare rounded ones."""
    return df.withColumns({c: F.round(F.col(c), digits) for c, t in df.dtypes if t == "double"})


def theme_sql(columns: str, joins: str) -> str:
    return f'WITH {FRAMES_SQL} SELECT a."SK_ID_CURR", {columns} FROM application a {joins}'


def _theme(name, columns):
    def build(spark, sf_dir):
        f = frames(spark, sf_dir)
        return rounded(themes.get_theme(name).build(f, f["application"]).select(KEY, *columns))

    return build


def _register(name, f, sql):
    f.__name__ = name
    query(sql)(f)


_J = lambda t: f'LEFT JOIN {t} USING ("SK_ID_CURR")'
for _name, _theme_name, _columns, _select, _join in (
    ("velocity_counts", "velocity", ["velocity_prev_count_7d", "velocity_prev_count_30d"], "velocity_prev_count_7d, velocity_prev_count_30d", _J("velocity_prev")),
    ("velocity_gap_std", "velocity", ["velocity_prev_decision_gap_std"], "round(velocity_prev_decision_gap_std, 6) AS velocity_prev_decision_gap_std", _J("velocity_gap")),
    ("velocity_event_recent", "velocity", ["velocity_bureau_recent_credit_count_30d"], "velocity_bureau_recent_credit_count_30d", _J("velocity_bureau")),
    ("consistency_gap_ratio", "consistency", ["consistency_prev_credit_gap_ratio_mean"], "round(consistency_prev_credit_gap_ratio_mean, 6) AS consistency_prev_credit_gap_ratio_mean", _J("consistency_prev")),
    ("consistency_status_rate", "consistency", ["consistency_prev_status_change_rate"], "round(consistency_prev_status_change_rate, 6) AS consistency_prev_status_change_rate", _J("consistency_prev")),
    ("consistency_row_ratio", "consistency", ["consistency_employed_birth_ratio"], 'round(abs("DAYS_EMPLOYED") / (nullif(abs("DAYS_BIRTH")::DOUBLE, 0) + 1), 6) AS consistency_employed_birth_ratio', ""),
    ("consistency_flag_sum", "consistency", ["consistency_contact_flag_sum"], '"FLAG_MOBIL" + "FLAG_EMP_PHONE" + "FLAG_WORK_PHONE" AS consistency_contact_flag_sum', ""),
    ("cashout_ratio_mean", "cashout", ["cashout_atm_ratio_mean"], "round(cashout_atm_ratio_mean, 6) AS cashout_atm_ratio_mean", _J("cash")),
    ("cashout_first_late_max", "cashout", ["cashout_first_payment_delinquency_days_max"], "cashout_first_payment_delinquency_days_max", _J("late")),
    ("cashout_severe_flag", "cashout", ["cashout_fpd_severe_flag"], "CASE WHEN firsts > 0 THEN coalesce(cashout_first_payment_delinquency_days_max > 30, false)::INT END AS cashout_fpd_severe_flag", _J("late")),
    ("cashout_late_ratio", "cashout", ["cashout_installments_late_ratio"], "round(cashout_installments_late_ratio, 6) AS cashout_installments_late_ratio", _J("late")),
):
    _register(_name, _theme(_theme_name, _columns), theme_sql(_select, _join))


# profiling and keys


@query(
    "WITH c AS (SELECT * FROM orders) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) - count({c}) AS null_count, round((count(*) - count({c}))::DOUBLE / count(*), 4) AS null_rate, count(DISTINCT {c}) AS unique_count, "
        f"round(count(DISTINCT {c})::DOUBLE / count(*), 4) AS unique_rate, {f'min({c})::DOUBLE' if n else 'NULL::DOUBLE'} AS min, {f'max({c})::DOUBLE' if n else 'NULL::DOUBLE'} AS max, {f'round(avg({c}), 6)' if n else 'NULL::DOUBLE'} AS mean FROM c"
        for c, t, n in (("o_orderkey", "bigint", 1), ("o_custkey", "bigint", 1), ("o_orderstatus", "string", 0), ("o_totalprice", "double", 1), ("o_orderdate", "timestamp_ntz", 0), ("o_orderpriority", "string", 0))
    )
)
def profile_columns_orders(spark, sf_dir):
    return rounded(profile.column_quality(table(spark, sf_dir, "orders")).drop("sample_values"))


@query(
    "SELECT 'doc_id' AS \"column\", count(*) - count(doc_id) AS null_count, 0.0::DOUBLE AS null_rate, count(DISTINCT doc_id) AS unique_count, count(*) AS total_count, "
    "count(DISTINCT doc_id) = count(*) AS is_unique, count(DISTINCT doc_id) = count(*) AND count(doc_id) = count(*) AS is_valid_pk FROM documents"
)
def pk_candidates(spark, sf_dir):
    return profile.primary_key_candidates(table(spark, sf_dir, "documents"))


@query(
    "WITH v AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey IS NOT NULL) SELECT count(*) AS child_values, count(*) FILTER (k NOT IN (SELECT c_custkey FROM customer)) AS orphan_values, "
    "count(*) FILTER (k NOT IN (SELECT c_custkey FROM customer))::DOUBLE / count(*) AS orphan_rate FROM v"
)
def fk_orphan_rate(spark, sf_dir):
    return profile.orphan_rate(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), "o_custkey", "c_custkey")


@query(
    """WITH d AS (SELECT count(*) AS n FROM documents), l AS (SELECT count(*) AS n FROM labels), m AS (SELECT count(*) AS n FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)),
    back AS (SELECT count(*) AS n, count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM labels)) AS o FROM (SELECT DISTINCT doc_id FROM documents))
    SELECT 'documents' AS parent_table, 'doc_id' AS parent_pk, 'labels' AS child_table, 'doc_id' AS foreign_key, d.n AS parent_count, l.n AS child_count, m.n AS matched_child_count,
    CASE WHEN m.n > d.n THEN 'one_to_many' ELSE 'one_to_one' END AS relationship_type FROM d, l, m"""
)
def relationships(spark, sf_dir):
    return profile.relationships({t: table(spark, sf_dir, t) for t in ("documents", "labels")})


# entities and synthesis


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def entity_child_semijoin(spark, sf_dir):
    root = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    return semi_join(table(spark, sf_dir, "orders"), "o_custkey", root, "c_custkey").select("o_orderkey", "o_custkey")


def tree(spark, sf_dir, root: DataFrame | None = None):
    configs = [
        EntityConfig("customer", "customer.parquet", "c_custkey", columns=["c_custkey", "c_nationkey", "c_mktsegment"]),
        EntityConfig("orders", "orders.parquet", "o_orderkey", "customer", "o_custkey", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]),
        EntityConfig("lineitem", "lineitem.parquet", "line_id", "orders", "l_orderkey", ["l_orderkey", "l_quantity"]),
    ]
    return build_graph(spark, configs, sf_dir, frames={"customer": root} if root is not None else None)


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')) GROUP BY 1")
def entity_grandchild_semijoin(spark, sf_dir):
    graph = tree(spark, sf_dir, table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'"))
    return graph.get_frame("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query(
    """SELECT c_custkey, coalesce(n, 0) AS count_orders, round(coalesce(s, 0), 2) AS sum_orders_o_totalprice, round(m, 6) AS mean_orders_o_totalprice, mx AS max_orders_o_totalprice,
    mn AS min_orders_o_totalprice, round(sd, 4) AS std_orders_o_totalprice, u AS num_unique_orders_o_orderstatus FROM customer LEFT JOIN
    (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS s, avg(o_totalprice) AS m, max(o_totalprice) AS mx, min(o_totalprice) AS mn, stddev_samp(o_totalprice) AS sd, count(DISTINCT o_orderstatus) AS u
     FROM orders GROUP BY 1) ON o_custkey = c_custkey"""
)
def dfs_depth1_orders(spark, sf_dir):
    made = synthesis.synthesise(tree(spark, sf_dir), "customer", AutoFeatureConfig(max_depth=1, trans_primitives=())).matrix
    r = {"sum_orders_o_totalprice": 2, "mean_orders_o_totalprice": 6, "std_orders_o_totalprice": 4}
    cols = ["count_orders", "sum_orders_o_totalprice", "mean_orders_o_totalprice", "max_orders_o_totalprice", "min_orders_o_totalprice", "std_orders_o_totalprice", "num_unique_orders_o_orderstatus"]
    return made.select("c_custkey", *[F.round(c, r[c]).alias(c) if c in r else c for c in cols])


@query(
    """WITH l AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS s FROM lineitem GROUP BY 1),
    o AS (SELECT o_custkey, coalesce(n, 0) AS n, coalesce(s, 0) AS s FROM orders LEFT JOIN l ON l_orderkey = o_orderkey),
    c AS (SELECT o_custkey, sum(n)::DOUBLE AS a, max(n)::DOUBLE AS b, avg(s) AS m, sum(s) AS t FROM o GROUP BY 1)
    SELECT c_custkey, coalesce(a, 0) AS sum_orders_count_lineitem, b AS max_orders_count_lineitem, round(m, 4) AS mean_orders_sum_lineitem_l_quantity, coalesce(t, 0) AS sum_orders_sum_lineitem_l_quantity
    FROM customer LEFT JOIN c ON o_custkey = c_custkey"""
)
def dfs_depth2_lineitem(spark, sf_dir):
    made = synthesis.synthesise(tree(spark, sf_dir), "customer", AutoFeatureConfig(max_depth=2)).matrix
    return made.select("c_custkey", "sum_orders_count_lineitem", "max_orders_count_lineitem", F.round("mean_orders_sum_lineitem_l_quantity", 4).alias("mean_orders_sum_lineitem_l_quantity"), "sum_orders_sum_lineitem_l_quantity")


@query("SELECT c_custkey, abs(c_nationkey)::DOUBLE AS absolute_c_nationkey FROM customer")
def dfs_transform_abs(spark, sf_dir):
    return synthesis.synthesise(tree(spark, sf_dir), "customer", AutoFeatureConfig(max_depth=0)).matrix.select("c_custkey", "absolute_c_nationkey")


@query(
    f"""WITH {FRAMES_SQL}, n AS (SELECT "SK_ID_CURR", count(*) AS count_previous FROM previous_application GROUP BY 1)
    SELECT a."SK_ID_CURR", a."TARGET", coalesce(count_previous, 0) AS count_previous, velocity_prev_count_7d, velocity_prev_count_30d FROM application a
    LEFT JOIN n USING ("SK_ID_CURR") LEFT JOIN velocity_prev USING ("SK_ID_CURR")"""
)
def candidate_pool(spark, sf_dir):
    f = frames(spark, sf_dir)
    configs = [EntityConfig("application", "", KEY, columns=[KEY, TARGET]), EntityConfig("previous", "", "SK_ID_PREV", "application", KEY, ["SK_ID_PREV", KEY])]
    graph = build_graph(spark, configs, frames={"application": f["application"], "previous": f["previous_application"]})
    auto = synthesis.synthesise(graph, "application", AutoFeatureConfig(max_depth=1, trans_primitives=()), TARGET).matrix
    semantic = themes.semantic_features(f, f["application"].select(KEY), ["velocity"], KEY).matrix
    pool = synthesis.merge_pools(f["application"], KEY, TARGET, auto, semantic).matrix
    return pool.select(KEY, TARGET, "count_previous", "velocity_prev_count_7d", "velocity_prev_count_30d")


# composites

_PART = "SELECT p_partkey, round(({}), 6) AS v FROM part"


def _part(name, column, sql):
    _register(name, lambda spark, sf_dir: (lambda df: df.select("p_partkey", F.round(column(df).cast("double"), 6).alias("v")))(table(spark, sf_dir, "part").withColumn("n", F.nullif(F.col("p_size") % 7, F.lit(3)))), _PART.format(sql))


_N = "nullif(p_size % 7, 3)"
_part("composite_cross_add", lambda df: composite.cross("p_retailprice", "n", "+"), f"p_retailprice + coalesce({_N}, 0)")
_part("composite_cross_sub", lambda df: composite.cross("p_retailprice", "n", "-"), f"p_retailprice - coalesce({_N}, 0)")
_part("composite_cross_mul", lambda df: composite.cross("p_retailprice", "n", "*"), f"p_retailprice * coalesce({_N}, 0)")
_part("composite_cross_div", lambda df: composite.cross("p_retailprice", "n", "/"), f"p_retailprice / nullif(coalesce({_N}, 0), 0)")
_part("composite_flag", lambda df: composite.flag("(n > 2) & (p_retailprice < 1500)", df.columns), f"coalesce({_N} > 2 AND p_retailprice < 1500, false)::INT::DOUBLE")
_part("composite_ratio", lambda df: composite.ratio_feature("p_retailprice", "n"), f"coalesce(p_retailprice / nullif({_N}, 0), 0)")
_part("composite_clip", lambda df: clip(as_double(df, "n") / 4, 0.0, 1.0), f"CASE WHEN {_N} IS NOT NULL THEN least(greatest({_N} / 4.0::DOUBLE, 0), 1) END")
_part("composite_formula", lambda df: composite.compile_formula("np.where(n >= 2, p_retailprice / (n - 2), fillna(n, -1))", df.columns), f"CASE WHEN coalesce({_N} >= 2, false) THEN p_retailprice / nullif({_N} - 2, 0) ELSE coalesce({_N}, -1) END")


# filters

_FEATURES = ["FLAG_MOBIL", "segment", *NUMERIC[1:], "order_total_twice", "constant", "mostly_null"]
_Q = lambda c: f'"{c}"'


@query(f"WITH {MATRIX_SQL} " + " UNION ALL ".join(f"SELECT '{c}' AS feature_name, round(avg(({_Q(c)} IS NULL)::INT), 6) AS missing_rate FROM matrix" for c in _FEATURES))
def filter_missing(spark, sf_dir):
    return rounded(filters.missing_rates(matrix(spark, sf_dir), _FEATURES))


@query(f"WITH {MATRIX_SQL} " + " UNION ALL ".join(f"SELECT '{c}' AS feature_name, count(DISTINCT {_Q(c)}) <= 1 AS is_constant FROM matrix" for c in _FEATURES))
def filter_constant(spark, sf_dir):
    return filters.constants(matrix(spark, sf_dir), _FEATURES)


_WHOLE = ["order_count", "order_total", "order_total_twice", "last_day", "velocity_bureau_recent_credit_count_30d"]
_PAIRS = [(a, b) for i, a in enumerate(_WHOLE) for b in _WHOLE[i + 1 :]]
_RANKED = (
    "SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(CASE WHEN isnan(corr(x, y)) THEN NULL ELSE corr(x, y) END, 6) AS correlation FROM (SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS x, "
    "rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS y FROM matrix WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
)


@query(f"WITH {MATRIX_SQL} " + " UNION ALL ".join(_RANKED.format(a=a, b=b) for a, b in _PAIRS))
def filter_spearman(spark, sf_dir):
    return rounded(filters.spearman_pairs(matrix(spark, sf_dir), KEY, _WHOLE))


@query()
def filter_drops(spark, sf_dir):
    return filters.basic_filters(matrix(spark, sf_dir), KEY, TARGET).drops


@query()
def correlation_groups(spark, sf_dir):
    return filters.correlation_groups(filters.basic_filters(matrix(spark, sf_dir), KEY, TARGET).drops)


# univariate scores

_SCORED = ["velocity_prev_decision_gap_std", "velocity_bureau_recent_credit_count_30d", "cashout_installments_late_ratio", "order_count", "order_total", "last_day"]
_LONG = MATRIX_SQL + ", raw AS (" + " UNION ALL ".join(f'SELECT "SK_ID_CURR" AS id, "TARGET" AS y, \'{c}\' AS f, {c}::DOUBLE AS x FROM matrix' for c in _SCORED) + "),\nlong AS (SELECT id, y, f, coalesce(x, median(x) OVER (PARTITION BY f)) AS x FROM raw)"
_RANKING = (
    _LONG
    + """, g AS (SELECT f, x, sum(y) AS p, count(*) AS n FROM long GROUP BY f, x),
run AS (SELECT *, sum(p) OVER a AS pa, sum(n) OVER a AS na, sum(p) OVER d AS pd, sum(n) OVER d AS nd, sum(p) OVER (PARTITION BY f) AS tp, sum(n) OVER (PARTITION BY f) AS tn
  FROM g WINDOW a AS (PARTITION BY f ORDER BY x ROWS UNBOUNDED PRECEDING), d AS (PARTITION BY f ORDER BY x DESC ROWS UNBOUNDED PRECEDING)),
ranked AS (SELECT f, any_value(tn)::BIGINT AS n, any_value(tp)::BIGINT AS pos, sum(p * ((na - n) - (pa - p) + (n - p) / 2.0::DOUBLE)) / (any_value(tp) * (any_value(tn) - any_value(tp))) AS auc,
  sum(p * pd::DOUBLE / nd) / any_value(tp) AS ap_up, sum(p * pa::DOUBLE / na) / any_value(tp) AS ap_down FROM run GROUP BY f)"""
)


def _rows(spark, sf_dir):
    return univariate.scores(matrix(spark, sf_dir), KEY, TARGET, _SCORED)


@query(f"WITH {_RANKING} SELECT f AS feature, n, pos, round(auc, 6) AS auc FROM ranked")
def uni_auc(spark, sf_dir):
    return rounded(univariate.ranking(_rows(spark, sf_dir)).select("feature", "n", "pos", "auc"))


@query(f"WITH {_RANKING} SELECT f AS feature, round(ap_up, 6) AS ap_up, round(ap_down, 6) AS ap_down FROM ranked")
def uni_ap(spark, sf_dir):
    return rounded(univariate.ranking(_rows(spark, sf_dir)).select("feature", "ap_up", "ap_down"))


_TOP = _RANKING + """, placed AS (SELECT l.f, y, r.n, pos, row_number() OVER (PARTITION BY l.f ORDER BY CASE WHEN ap_up >= ap_down THEN -x ELSE x END, id) AS k FROM long l JOIN ranked r ON l.f = r.f),
tops AS (SELECT f, any_value(greatest(1, floor(n * {share}::DOUBLE)))::BIGINT AS top, coalesce(sum(y) FILTER (k <= greatest(1, floor(n * {share}::DOUBLE))), 0)::BIGINT AS hits, any_value(pos) AS pos, any_value(n) AS n FROM placed GROUP BY f)"""


@query(f"WITH {_TOP.format(share='0.2')} SELECT f AS feature, top, hits, round(hits::DOUBLE / pos, 6) AS recall FROM tops")
def uni_topk(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    ranked = univariate.ranking(rows)
    found = univariate.top_share(rows, ranked, 0.2).join(ranked.select("feature", "pos"), "feature")
    return rounded(found.select("feature", "top", "hits", (F.col("hits").cast("double") / F.col("pos")).alias("recall")))


@query(f"WITH {_TOP.format(share='0.1')} SELECT f AS feature, round((hits::DOUBLE / top) / (pos::DOUBLE / n), 6) AS lift FROM tops")
def uni_lift(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    ranked = univariate.ranking(rows)
    found = univariate.top_share(rows, ranked, 0.1).join(ranked.select("feature", "pos", "n"), "feature")
    return rounded(found.select("feature", (F.col("hits").cast("double") / F.col("top") / (F.col("pos").cast("double") / F.col("n"))).alias("lift")))


_IV = _LONG + """, e AS (SELECT f, list_filter(list_sort(list_distinct(quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))), lambda v: v > min(x) AND v < max(x)) AS edges FROM long GROUP BY f),
b AS (SELECT long.f, len(list_filter(edges, lambda v: v <= x)) AS bin, sum(y) AS bad, sum(1 - y) AS good FROM long JOIN e ON long.f = e.f GROUP BY 1, 2),
s AS (SELECT f, greatest(good::DOUBLE / sum(good) OVER (PARTITION BY f), 1e-10) AS g, greatest(bad::DOUBLE / sum(bad) OVER (PARTITION BY f), 1e-10) AS d FROM b),
iv AS (SELECT f, CASE WHEN count(*) < 2 THEN 0 ELSE sum((g - d) * ln(g / d)) END AS iv FROM s GROUP BY f)"""
_IV = _IV.replace("lambda v: v > min(x) AND v < max(x)", "lambda v: v > lo AND v < hi").replace("FROM long GROUP BY f),\nb AS", "FROM (SELECT *, min(x) OVER (PARTITION BY f) AS lo, max(x) OVER (PARTITION BY f) AS hi FROM long) GROUP BY f, lo, hi),\nb AS")


@query(f"WITH {_IV} SELECT f AS feature, round(iv, 6) AS iv FROM iv")
def uni_iv(spark, sf_dir):
    return rounded(univariate.information_value(_rows(spark, sf_dir)))


@query("WITH v AS (SELECT DISTINCT coalesce(c_mktsegment, 'MISSING') AS value FROM customer) SELECT value, (row_number() OVER (ORDER BY value) - 1)::DOUBLE AS code FROM v")
def uni_categorical(spark, sf_dir):
    return univariate.coded(table(spark, sf_dir, "customer"), "c_mktsegment")


_CARD = (
    "WITH "
    + _IV
    + _TOP.replace(_LONG, "").format(share="0.1")
    + """, card AS (SELECT tops.f AS feature_name, CASE WHEN ap_up >= ap_down THEN auc ELSE 1 - auc END AS univariate_roc_auc, greatest(ap_up, ap_down) AS univariate_pr_auc, hits::DOUBLE / tops.pos AS recall_at_topk,
  (hits::DOUBLE / top) / (tops.pos::DOUBLE / tops.n) AS lift_top_decile, iv FROM tops JOIN ranked ON tops.f = ranked.f JOIN iv ON tops.f = iv.f)"""
)
_MEASURES = "feature_name, round(univariate_roc_auc, 6) AS univariate_roc_auc, round(univariate_pr_auc, 6) AS univariate_pr_auc, round(recall_at_topk, 6) AS recall_at_topk, round(lift_top_decile, 6) AS lift_top_decile, round(iv, 6) AS iv"
_LEVEL = "CASE WHEN iv <= 0.02 THEN 'none' WHEN iv <= 0.1 THEN 'weak' WHEN iv <= 0.3 THEN 'medium' ELSE 'strong' END AS iv_level"


def _card(spark, sf_dir):
    return univariate.evaluate(matrix(spark, sf_dir), KEY, TARGET, _SCORED)


@query(f"{_CARD} SELECT {_MEASURES} FROM card")
def scorecard(spark, sf_dir):
    return rounded(_card(spark, sf_dir))


@query(
    f"""{_CARD} SELECT feature_name, {_LEVEL}, iv >= 0.02 AND (univariate_roc_auc >= 0.55 OR lift_top_decile >= 1.5) AS selected_flag,
    CASE WHEN iv < 0.02 THEN 'rejected' WHEN iv < 0.1 AND univariate_roc_auc < 0.55 THEN 'needs_optimization' ELSE 'selected' END AS decision,
    CASE WHEN iv < 0.02 THEN format('low_iv({{:.4f}})', iv) WHEN iv < 0.1 AND univariate_roc_auc < 0.55 THEN format('weak_signal(iv={{:.4f}}, auc={{:.4f}})', iv, univariate_roc_auc) ELSE '' END AS drop_reason FROM card"""
)
def selection_decision(spark, sf_dir):
    return decision.decide(_card(spark, sf_dir)).select("feature_name", "iv_level", "selected_flag", "decision", "drop_reason")


@query(f"{_CARD} SELECT iv_level, count(*) AS n FROM (SELECT {_LEVEL} FROM card) GROUP BY 1")
def iv_levels(spark, sf_dir):
    return decision.decide(_card(spark, sf_dir)).groupBy("iv_level").agg(F.count("*").alias("n"))


@query(f"{_CARD} SELECT feature_name, round(iv, 6) AS iv FROM card ORDER BY card.iv DESC, feature_name LIMIT 3")
def top_features(spark, sf_dir):
    return rounded(decision.top_features(_card(spark, sf_dir), 3).select("feature_name", "iv"))


@query(
    f"""{_CARD} SELECT feature_name, univariate_roc_auc >= 0.52 OR univariate_pr_auc >= 0.08 * 1.02::DOUBLE AS selected_flag,
    CASE WHEN univariate_roc_auc >= 0.52 OR univariate_pr_auc >= 0.08 * 1.02::DOUBLE THEN '' ELSE 'weak_univariate_signal' END AS drop_reason FROM card"""
)
def selection_legacy(spark, sf_dir):
    return decision.legacy_decide(_card(spark, sf_dir), 0.08).select("feature_name", "selected_flag", "drop_reason")


# stability

_STABLE = ["l_quantity", "l_extendedprice", "l_discount"]


def _psi_sql(base: str, others: str, by: str) -> str:
    """PSI of ``others`` (columns g, f, x) against ``base`` (f, x)."""
    return f""", base AS ({base}), other AS ({others}),
lim AS (SELECT *, min(x) OVER (PARTITION BY f) AS lo, max(x) OVER (PARTITION BY f) AS hi FROM base WHERE x IS NOT NULL),
e AS (SELECT f, list_filter(list_sort(list_distinct(quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))), lambda v: v > lo AND v < hi) AS edges FROM lim GROUP BY f, lo, hi),
eb AS (SELECT e.f, len(list_filter(edges, lambda v: v <= x)) AS bin, count(*) AS n FROM base JOIN e ON base.f = e.f WHERE x IS NOT NULL GROUP BY 1, 2),
ab AS (SELECT g, e.f, len(list_filter(edges, lambda v: v <= x)) AS bin, count(*) AS n FROM other JOIN e ON other.f = e.f WHERE x IS NOT NULL GROUP BY 1, 2, 3),
grid AS (SELECT g, e.f, bin, edges, (SELECT sum(n) FROM eb WHERE eb.f = e.f) AS te, ta FROM (SELECT g, f, sum(n) AS ta FROM ab GROUP BY 1, 2) t JOIN e ON t.f = e.f, unnest(range(len(edges) + 1)) AS u(bin)),
sh AS (SELECT grid.*, greatest(coalesce(eb.n, 0)::DOUBLE / te, 0.01) AS pe, greatest(coalesce(ab.n, 0)::DOUBLE / ta, 0.01) AS pa FROM grid LEFT JOIN eb ON eb.f = grid.f AND eb.bin = grid.bin
  LEFT JOIN ab ON ab.f = grid.f AND ab.bin = grid.bin AND ab.g = grid.g),
psi AS (SELECT g AS {by}, f AS feature_name, sum(CASE WHEN len(edges) > 0 THEN (pa - pe) * ln(pa / pe) ELSE 0 END) AS psi FROM sh GROUP BY 1, 2)"""


_LEVELS = "CASE WHEN {0} < 0.1 THEN 'stable' WHEN {0} < 0.25 THEN 'moderate' ELSE 'unstable' END AS stability_level"
_LINES = "WITH li AS (" + " UNION ALL ".join(f"SELECT l_orderkey, l_returnflag AS flag, '{c}' AS f, {c} AS x FROM lineitem" for c in _STABLE) + ")"
_PAIR = _LINES + _psi_sql("SELECT f, x FROM li WHERE l_orderkey % 2 = 0", "SELECT 'odd' AS g, f, x FROM li WHERE l_orderkey % 2 = 1", "g")


@query(f"{_PAIR} SELECT feature_name, round(psi, 6) AS psi, psi < 0.25 AS is_stable, {_LEVELS.format('psi')} FROM psi")
def psi_pair(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return rounded(stability.feature_psi(li.filter("l_orderkey % 2 = 0"), li.filter("l_orderkey % 2 = 1"), _STABLE).select("feature_name", "psi", "is_stable", "stability_level"))


_ORDERS = """WITH q AS (SELECT quantile_cont(t, [1/3::DOUBLE, 2/3::DOUBLE]) AS q FROM (SELECT epoch(o_orderdate)::DOUBLE AS t FROM orders)),
li AS (SELECT o_totalprice AS x, 'o_totalprice' AS f, (epoch(o_orderdate)::DOUBLE > q[1])::INT + (epoch(o_orderdate)::DOUBLE > q[2])::INT AS s FROM orders, q)"""
_TIME = _ORDERS + _psi_sql("SELECT f, x FROM li WHERE s = 0", "SELECT s AS g, f, x FROM li WHERE s > 0", "split_index")


def _time(spark, sf_dir):
    return stability.time_stability(table(spark, sf_dir, "orders"), "o_orderdate", 3, ["o_totalprice"])


@query(f"{_TIME} SELECT feature_name, split_index, round(psi, 6) AS psi, psi < 0.25 AS is_stable, {_LEVELS.format('psi')} FROM psi")
def time_stability(spark, sf_dir):
    return rounded(_time(spark, sf_dir)[0].select("feature_name", "split_index", "psi", "is_stable", "stability_level"))


_SLICE = (
    _LINES
    + ", sizes AS (SELECT l_returnflag AS flag, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 100), first AS (SELECT flag FROM sizes ORDER BY n DESC, flag LIMIT 1)"
    + _psi_sql("SELECT f, x FROM li WHERE flag = (SELECT flag FROM first)", "SELECT flag AS g, f, x FROM li WHERE flag IN (SELECT flag FROM sizes) AND flag <> (SELECT flag FROM first)", "slice_name")
)


@query(f"{_SLICE} SELECT feature_name, slice_name, round(psi, 6) AS psi, psi < 0.25 AS is_stable, {_LEVELS.format('psi')} FROM psi")
def slice_consistency(spark, sf_dir):
    detail, _ = stability.slice_consistency(table(spark, sf_dir, "lineitem"), "l_returnflag", 100, _STABLE)
    return rounded(detail.select("feature_name", "slice_name", "psi", "is_stable", "stability_level"))


@query(f"{_TIME} SELECT feature_name, round(max(psi), 6) AS max_psi, bool_and(psi < 0.25) AS is_stable, {_LEVELS.format('max(psi)')} FROM psi GROUP BY 1")
def stability_summary(spark, sf_dir):
    return rounded(_time(spark, sf_dir)[1])


# advanced

_DUP = ["order_count", "order_total", "order_total_twice", "order_mean"]
_PEARSON = f"WITH {MATRIX_SQL}, pairs AS (" + " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, abs(corr({a}, {b})) AS r FROM matrix" for i, a in enumerate(_DUP) for b in _DUP[i + 1 :]) + ")"


@query(f"{_PEARSON} SELECT feature_a, feature_b, round(r, 6) AS correlation, true AS is_duplicate FROM pairs WHERE r >= 1 - 1e-9")
def dup_pairs(spark, sf_dir):
    return rounded(advanced.duplicates(matrix(spark, sf_dir), _DUP))


@query(f"{_PEARSON} SELECT feature_a, feature_b, round(r, 6) AS correlation, r >= 0.9999 AS is_duplicate FROM pairs WHERE r >= 0.5")
def near_dup_pairs(spark, sf_dir):
    return rounded(advanced.near_duplicates(matrix(spark, sf_dir), _DUP, 0.5))


def offered(df: DataFrame) -> list[str]:
    """All numeric features of the matrix."""
    return [c for c in numeric_columns(df) if c not in (KEY, TARGET)]


@query()
def model_gain(spark, sf_dir):
    df, base = with_signal(matrix(spark, sf_dir)), ["order_count", "order_total"]
    return advanced.model_gain(df, KEY, TARGET, base, [c for c in offered(df) if c not in base])


@query()
def forward_selection(spark, sf_dir):
    df = with_signal(matrix(spark, sf_dir))
    return advanced.forward_selection(df, KEY, TARGET, offered(df))


def flagship(spark, sf_dir) -> DataFrame:
    """The scorecard of the customer anchor with orders', lineitems' and events' features."""
    return scorecard(spark, sf_dir)
