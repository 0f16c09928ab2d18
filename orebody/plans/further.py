"""More registered queries: scans, keys, the entity graph, whole theme and candidate runs, composites, selection and its reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from orebody.config import AutoFeatureConfig, EntityConfig
from orebody.functions.expr import long_form
from orebody.operators import candidates, composite, decision, filters, profile, stability, synthesis, themes, univariate, variants
from orebody.operators.entity import build_graph
from orebody.plans import catalogue
from orebody.plans.catalogue import _LEVELS, _ORDERS, _PAIR, _RANKED, _STABLE, KEY, TARGET, _psi_sql, query, rounded, tree, with_signal
from orebody.plans.frames import FRAMES_SQL, MATRIX_SQL, NUMERIC, SIGNAL, frames, matrix, table
from orebody.sources import io

# scans, keys and profiles


@query("SELECT n_nationkey, n_name FROM nation")
def scan_projection(spark, sf_dir):
    return io.read(spark, f"{sf_dir}/nation.parquet", ["n_name", "n_nationkey", "absent"])


@query(
    "SELECT 'o_orderkey' AS \"column\", count(*) = count(o_orderkey) AND count(*) = count(DISTINCT o_orderkey) AS is_valid FROM orders "
    "UNION ALL SELECT 'o_custkey', count(*) = count(o_custkey) AND count(*) = count(DISTINCT o_custkey) FROM orders"
)
def pk_validity(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return spark.createDataFrame([(c, profile.is_valid_primary_key(orders, c)) for c in ("o_orderkey", "o_custkey")], "column string, is_valid boolean")


_KEYED = {"documents": "doc_id", "labels": "doc_id", "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id"}


@query(" UNION ALL ".join(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\" FROM {t} HAVING count(*) = count({c}) AND count(*) = count(DISTINCT {c})" for t, c in _KEYED.items()))
def pk_detection(spark, sf_dir):
    found = [(t, c) for t in _KEYED for c in profile.detect_primary_key(table(spark, sf_dir, t))]
    return spark.createDataFrame(found, "table string, column string")


@query("SELECT 'labels' AS child, 'doc_id' AS \"column\" WHERE (SELECT count(DISTINCT doc_id) FILTER (doc_id NOT IN (SELECT doc_id FROM documents))::DOUBLE / count(DISTINCT doc_id) FROM labels) < 0.01")
def fk_detection(spark, sf_dir):
    found = profile.detect_foreign_keys(table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"), "doc_id")
    return spark.createDataFrame([("labels", c) for c in found], "child string, column string")


_SAMPLED = ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", (SELECT string_agg(v, '|') FROM (SELECT {c}::VARCHAR AS v FROM orders WHERE {c} IS NOT NULL LIMIT 3)) AS samples" for c in _SAMPLED))
def profile_samples_orders(spark, sf_dir):
    quality = profile.column_quality(table(spark, sf_dir, "orders").select(*_SAMPLED))
    return quality.select("column", F.array_join("sample_values", "|").alias("samples"))


@query(
    f"""WITH {MATRIX_SQL}, q AS (SELECT count(*) AS n, {', '.join(f'count("{c}") AS c{i}, count(DISTINCT "{c}") AS d{i}' for i, c in enumerate([*NUMERIC, "constant", "mostly_null"]))} FROM matrix)
    SELECT n AS row_count, {len(NUMERIC) + 5}::BIGINT AS column_count,
    array_to_string(list_sort(list_filter([{', '.join(f"CASE WHEN 1 - c{i}::DOUBLE / n > 0.5 THEN '{c}' END" for i, c in enumerate([*NUMERIC, "constant", "mostly_null"]))}], lambda x: x IS NOT NULL)), ',') AS high_null_columns,
    array_to_string(list_sort(list_filter([{', '.join(f"CASE WHEN d{i} <= 1 THEN '{c}' END" for i, c in enumerate([*NUMERIC, "constant", "mostly_null"]))}], lambda x: x IS NOT NULL)), ',') AS constant_columns FROM q"""
)
def table_summary(spark, sf_dir):
    found = profile.table_summary(matrix(spark, sf_dir).drop("order_total_twice"))
    row = (found["row_count"], found["column_count"], ",".join(sorted(found["high_null_columns"])), ",".join(sorted(found["constant_columns"])))
    return spark.createDataFrame([row], "row_count bigint, column_count bigint, high_null_columns string, constant_columns string")


@query(
    """WITH r AS (SELECT 'customer' AS p FROM orders HAVING count(DISTINCT custkey_id) FILTER (custkey_id NOT IN (SELECT c_custkey FROM customer)) = 0 UNION ALL SELECT 'orders' FROM (SELECT 1) UNION ALL SELECT 'customer' FROM (SELECT 1))
    SELECT p AS main_table FROM r GROUP BY p ORDER BY count(*) DESC, p LIMIT 1""".replace("custkey_id", "o_custkey")
)
def main_table(spark, sf_dir):
    """customer has the children orders and complaints, orders has lineitem."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cust_id"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("cust_id"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"))
    records = profile.relationships({"customer": customer, "orders": orders, "lineitem": lines, "complaints": orders.select("cust_id")})
    return spark.createDataFrame([(profile.main_table(records),)], "main_table string")


# the entity graph


@query("SELECT 'customer' AS entity, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)")
def entity_counts(spark, sf_dir):
    return spark.createDataFrame(list(tree(spark, sf_dir).verify()["row_counts"].items()), "entity string, n bigint")


@query("SELECT 'customer' AS parent, 'c_custkey' AS key, 'orders' AS child, 'o_custkey' AS foreign_key UNION ALL SELECT 'orders', 'o_orderkey', 'lineitem', 'l_orderkey'")
def entity_relationships(spark, sf_dir):
    return spark.createDataFrame(tree(spark, sf_dir).edges, "parent string, key string, child string, foreign_key string")


@query("SELECT count(*) AS n, count(*) AS distinct_keys, 0::BIGINT AS least, count(*) - 1 AS most FROM lineitem")
def entity_surrogate_key(spark, sf_dir):
    lines = build_graph(spark, [EntityConfig("lineitem", "lineitem.parquet", "line_id", columns=["l_orderkey"])], sf_dir).get_frame("lineitem")
    return lines.agg(F.count("*").alias("n"), F.count_distinct("line_id").alias("distinct_keys"), F.min("line_id").alias("least"), F.max("line_id").alias("most"))


# whole runs of feature generation

_ALL = {
    "velocity_prev_count_7d": "velocity_prev_count_7d",
    "velocity_prev_count_30d": "velocity_prev_count_30d",
    "velocity_prev_decision_gap_std": "round(velocity_prev_decision_gap_std, 6)",
    "velocity_bureau_recent_credit_count_30d": "velocity_bureau_recent_credit_count_30d",
    "consistency_employed_birth_ratio": 'round(abs("DAYS_EMPLOYED") / (nullif(abs("DAYS_BIRTH")::DOUBLE, 0) + 1), 6)',
    "consistency_contact_flag_sum": '"FLAG_MOBIL" + "FLAG_EMP_PHONE" + "FLAG_WORK_PHONE"',
    "consistency_prev_credit_gap_ratio_mean": "round(consistency_prev_credit_gap_ratio_mean, 6)",
    "consistency_prev_status_change_rate": "round(consistency_prev_status_change_rate, 6)",
    "cashout_atm_ratio_mean": "round(cashout_atm_ratio_mean, 6)",
    "cashout_first_payment_delinquency_days_max": "cashout_first_payment_delinquency_days_max",
    "cashout_fpd_severe_flag": "CASE WHEN firsts > 0 THEN coalesce(cashout_first_payment_delinquency_days_max > 30, false)::INT END",
    "cashout_installments_late_ratio": "round(cashout_installments_late_ratio, 6)",
}
_EVERY = " ".join(f'LEFT JOIN {t} USING ("SK_ID_CURR")' for t in ("velocity_prev", "velocity_gap", "velocity_bureau", "consistency_prev", "cash", "late"))


@query(f'WITH {FRAMES_SQL} SELECT a."SK_ID_CURR", {", ".join(f"{x} AS {c}" for c, x in _ALL.items())} FROM application a {_EVERY}')
def semantic_matrix(spark, sf_dir):
    f = frames(spark, sf_dir)
    return rounded(candidates.run_semantic(f, f["application"].select(KEY)).matrix.select(KEY, *_ALL))


@query("SELECT theme, count(*) AS features FROM (VALUES " + ", ".join(f"('{c.split('_')[0]}')" for c in _ALL) + ") t(theme) GROUP BY 1")
def theme_registry(spark, sf_dir):
    return themes.registry_frame(spark, themes.get_registry().specs()).groupBy("theme").agg(F.count("*").alias("features"))


def _application_graph(spark, f):
    configs = [EntityConfig("application", "", KEY, columns=[KEY, TARGET]), EntityConfig("previous", "", "SK_ID_PREV", "application", KEY, ["SK_ID_PREV", KEY, "AMT_CREDIT"])]
    return build_graph(spark, configs, frames={"application": f["application"], "previous": f["previous_application"]})


@query(
    f"""WITH {FRAMES_SQL}, n AS (SELECT "SK_ID_CURR", count(*) AS n, sum("AMT_CREDIT") AS s, max("AMT_CREDIT") AS m FROM previous_application GROUP BY 1)
    SELECT a."SK_ID_CURR", a."TARGET", coalesce(n, 0) AS count_previous, round(coalesce(s, 0), 2) AS sum_previous_amt_credit, m AS max_previous_amt_credit, {", ".join(f"{x} AS {c}" for c, x in _ALL.items())}
    FROM application a LEFT JOIN n USING ("SK_ID_CURR") {_EVERY}"""
)
def candidate_run(spark, sf_dir):
    f = frames(spark, sf_dir)
    config = AutoFeatureConfig(agg_primitives=("count", "sum", "max"), trans_primitives=(), max_depth=1)
    made = candidates.run_candidates(_application_graph(spark, f), f, "application", KEY, TARGET, config).matrix
    return rounded(made.withColumn("sum_previous_amt_credit", F.round("sum_previous_amt_credit", 2)).select(KEY, TARGET, "count_previous", "sum_previous_amt_credit", "max_previous_amt_credit", *_ALL))


@query("SELECT 3::BIGINT AS auto_feature_count, 12::BIGINT AS semantic_feature_count, 15::BIGINT AS total_feature_count")
def candidate_summary(spark, sf_dir):
    f = frames(spark, sf_dir)
    config = AutoFeatureConfig(agg_primitives=("count", "sum", "max"), trans_primitives=(), max_depth=1)
    found = candidates.run_candidates(_application_graph(spark, f), f, "application", KEY, TARGET, config).summary
    names = ("auto_feature_count", "semantic_feature_count", "total_feature_count")
    return spark.createDataFrame([tuple(found[c] for c in names)], ", ".join(f"{c} bigint" for c in names))


@query("SELECT * FROM (VALUES ('count_previous', 'COUNT(previous)'), ('max_previous_amt_credit', 'MAX(previous.AMT_CREDIT)')) t(feature_name, definition)")
def auto_definitions(spark, sf_dir):
    f = frames(spark, sf_dir)
    return synthesis.synthesise(_application_graph(spark, f), "application", AutoFeatureConfig(("count", "max"), (), 1), TARGET).definitions


@query("SELECT 'absolute_c_nationkey' AS feature_name")
def leakage_guard(spark, sf_dir):
    """Of the columns made for customer, the one whose name holds the target's goes."""
    root = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey", F.col("c_acctbal").alias("old_c_acctbal"))
    graph = build_graph(spark, [EntityConfig("customer", "", "c_custkey")], frames={"customer": root})
    made = synthesis.synthesise(graph, "customer", AutoFeatureConfig(max_depth=0), "c_acctbal")
    return spark.createDataFrame([(c,) for c in made.matrix.columns if c not in ("c_custkey", "c_acctbal", "c_nationkey")], "feature_name string")


# extensions of the themes

_CURR = '"SK_ID_CURR"'


@query(
    f"""WITH {FRAMES_SQL}, b AS (SELECT {_CURR}, count(*) FILTER ("DAYS_CREDIT" >= -7) AS c FROM bureau GROUP BY 1),
    p AS (SELECT {_CURR}, count(*) FILTER ("DAYS_DECISION" >= -90) AS n FROM previous_application GROUP BY 1), g AS (SELECT {_CURR}, min(gap) AS m FROM gaps GROUP BY 1)
    SELECT coalesce(p.{_CURR}, b.{_CURR}) AS {_CURR}, n AS velocity_prev_count_90d, m AS velocity_prev_decision_gap_min, CASE WHEN n IS NOT NULL THEN coalesce(m <= 3, false)::INT END AS velocity_prev_burst_flag,
    c AS velocity_bureau_recent_credit_count_7d FROM p LEFT JOIN g ON g.{_CURR} = p.{_CURR} FULL JOIN b ON b.{_CURR} = p.{_CURR}"""
)
def velocity_variants(spark, sf_dir):
    f = frames(spark, sf_dir)
    return variants.velocity(f["previous_application"], f["bureau"])


@query(
    f"""WITH {FRAMES_SQL} SELECT {_CURR}, round(stddev_samp("AMT_CREDIT" - "AMT_APPLICATION"), 4) AS consistency_prev_credit_gap_std, count(DISTINCT "NAME_CONTRACT_STATUS") AS consistency_prev_status_types
    FROM previous_application GROUP BY 1"""
)
def consistency_variants(spark, sf_dir):
    return rounded(variants.consistency(frames(spark, sf_dir)["previous_application"]), 4)


@query(
    f"""WITH {FRAMES_SQL}, c AS (SELECT {_CURR}, max(atm / (abs(total) + 1)) AS m, count(*) FILTER (atm > 0) AS n FROM card_rows JOIN owner USING ("SK_ID_PREV") GROUP BY 1),
    i AS (SELECT {_CURR}, avg(late::DOUBLE) FILTER (num = 1) AS f, stddev_samp(late::DOUBLE) AS s FROM inst JOIN owner USING ("SK_ID_PREV") GROUP BY 1)
    SELECT coalesce(c.{_CURR}, i.{_CURR}) AS {_CURR}, round(m, 6) AS cashout_atm_ratio_max, n::BIGINT AS cashout_atm_count, round(f, 6) AS cashout_first_payment_gap_mean, round(s, 6) AS cashout_payment_gap_std
    FROM c FULL JOIN i ON c.{_CURR} = i.{_CURR}"""
)
def cashout_variants(spark, sf_dir):
    f = frames(spark, sf_dir)
    return rounded(variants.cashout(f["previous_application"], f["credit_card_balance"], f["installments_payments"]))


@query(
    f"""WITH {FRAMES_SQL} SELECT {_CURR}, count(*) AS history_prev_count, round(count(*) FILTER ("NAME_CONTRACT_STATUS" = 'Refused')::DOUBLE / count(*), 6) AS history_prev_refused_ratio,
    max(-"DAYS_DECISION") AS history_first_decision_days, min(-"DAYS_DECISION") AS history_last_decision_days FROM previous_application GROUP BY 1"""
)
def history_variants(spark, sf_dir):
    return rounded(variants.history(frames(spark, sf_dir)["previous_application"]))


@query(f"WITH {MATRIX_SQL} SELECT {_CURR}, round(coalesce(velocity_prev_count_30d, 0)::DOUBLE / nullif(coalesce(order_count, 0) - coalesce(velocity_prev_count_30d, 0), 0), 6) AS acceleration FROM matrix")
def acceleration(spark, sf_dir):
    return rounded(matrix(spark, sf_dir).select(KEY, variants.acceleration("velocity_prev_count_30d", "order_count").alias("acceleration")))


# composites

_SCORES = '(SELECT *, abs(c_acctbal) / 10000 AS "EXT_SOURCE_2", (c_custkey % 4)::DOUBLE / 4 AS prev_reject_rate, c_custkey % 5 AS velocity_prev_count_7d FROM customer)'


def _scored(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k, (F.abs("c_acctbal") / 10000).alias("EXT_SOURCE_2"), ((k % 4).cast("double") / 4).alias("prev_reject_rate"), (k % 5).alias("velocity_prev_count_7d"), F.col("c_acctbal").alias("AMT_CREDIT")
    )


@query(f'SELECT c_custkey, round(velocity_prev_count_7d * "EXT_SOURCE_2", 6) AS multiply, round(velocity_prev_count_7d + "EXT_SOURCE_2", 6) AS add, round(velocity_prev_count_7d - "EXT_SOURCE_2", 6) AS subtract FROM {_SCORES}')
def composite_interaction(spark, sf_dir):
    return rounded(_scored(spark, sf_dir).select("c_custkey", *[composite.interaction("velocity_prev_count_7d", "EXT_SOURCE_2", k).alias(k) for k in ("multiply", "add", "subtract")]))


@query(f'SELECT c_custkey, round(velocity_prev_count_7d * (1 - "EXT_SOURCE_2"), 6) AS composite_velocity_external, coalesce(prev_reject_rate > 0.5 AND "EXT_SOURCE_2" < 0.3, false)::INT AS composite_reject_low_score_flag FROM {_SCORES}')
def composite_velocity_risk(spark, sf_dir):
    return rounded(composite.velocity_risk(_scored(spark, sf_dir)).select("c_custkey", "composite_velocity_external", "composite_reject_low_score_flag"))


@query('SELECT c_custkey, round((1 - least(greatest((c_custkey * 13 % 6000) / 365::DOUBLE, 0), 1)) * c_acctbal, 4) AS composite_stability_risk FROM customer')
def composite_stability_risk(spark, sf_dir):
    rows = _scored(spark, sf_dir).withColumn("DAYS_EMPLOYED", -(F.col("c_custkey") * 13 % 6000))
    return rounded(composite.stability_risk(rows).select("c_custkey", "composite_stability_risk"), 4)


@query(
    """SELECT c_custkey, round(CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal / (c_custkey % 7) END, 6) AS composite_credit_usage_ratio, round(CASE WHEN coalesce(c_nationkey, 0) <> 0 THEN coalesce(c_acctbal, 0) / c_nationkey END, 6) AS composite_income_to_annuity_ratio,
    round((c_custkey % 5) * (1 - abs(c_acctbal) / 10000), 6) AS composite_velocity_x_external, (c_custkey % 3 > 0 AND (c_custkey % 10) / 10::DOUBLE < 0.3)::INT AS composite_high_risk_flag FROM customer"""
)
def composite_examples(spark, sf_dir):
    k, money = F.col("c_custkey"), F.col("c_acctbal")
    rows = table(spark, sf_dir, "customer").select(
        k, money.alias("AMT_BALANCE"), (k % 7).alias("AMT_CREDIT_LIMIT_ACTUAL"), money.alias("AMT_INCOME_TOTAL"), F.col("c_nationkey").alias("AMT_ANNUITY"),
        (k % 5).alias("prev_app_count_30d"), (F.abs(money) / 10000).alias("EXT_SOURCE_2"), (k % 3).alias("prev_reject_count"), ((k % 10) / 10).alias("EXT_SOURCE_1"),
    )
    specs = composite.example_specs()
    return rounded(composite.build_composites(rows, specs).matrix.select("c_custkey", *[s.feature_name for s in specs]))


# filters and selection

_IN_ORDER = ["FLAG_MOBIL", "segment", *NUMERIC[1:], "order_total_twice", "constant", "mostly_null"]
_CORRELATED = [*NUMERIC, "order_total_twice"]
_DROPS = f"""WITH {MATRIX_SQL}, rates AS ({' UNION ALL '.join(f"SELECT {i} AS k, '{c}' AS f, avg((\"{c}\" IS NULL)::INT) AS m, count(DISTINCT \"{c}\") AS d FROM matrix" for i, c in enumerate(_IN_ORDER))}),
rho AS ({' UNION ALL '.join(f"SELECT {i} AS i, {j} AS j, * FROM (" + _RANKED.format(a=f'"{a}"', b=f'"{b}"').replace(chr(39) + chr(34), chr(39)).replace(chr(34) + chr(39), chr(39)) + ")" for j, b in enumerate(_CORRELATED) for i, a in enumerate(_CORRELATED[:j]))}),
gone AS (SELECT f FROM rates WHERE m > 0.95 OR d <= 1),
close AS (SELECT feature_b AS f, arg_min(feature_a, i) AS parent, min(j) AS j FROM rho WHERE abs(correlation) >= 0.95 AND feature_a NOT IN (SELECT f FROM gone) AND feature_b NOT IN (SELECT f FROM gone) GROUP BY 1),
drops AS (SELECT f AS feature_name, 'high_missing_rate' AS drop_reason FROM rates WHERE m > 0.95 UNION ALL SELECT f, 'near_constant' FROM rates WHERE m <= 0.95 AND d <= 1
  UNION ALL SELECT f, 'high_correlation_with_' || parent FROM close)"""

catalogue.ORACLE_SQL["filter_drops"] = f"{_DROPS} SELECT * FROM drops"
catalogue.ORACLE_SQL["correlation_groups"] = f"{_DROPS} SELECT feature_name AS dropped_feature, drop_reason, substring(drop_reason, 23) AS representative_feature FROM drops WHERE starts_with(drop_reason, 'high_correlation_with_')"


@query(f"{_DROPS} SELECT {len(_IN_ORDER)}::BIGINT AS input, ({len(_IN_ORDER)} - count(*))::BIGINT AS kept, count(*) FILTER (drop_reason = 'high_missing_rate') AS high_missing_rate, count(*) FILTER (drop_reason = 'near_constant') AS near_constant, count(*) FILTER (starts_with(drop_reason, 'high_correlation')) AS high_correlation FROM drops")
def filter_summary(spark, sf_dir):
    found = filters.basic_filters(matrix(spark, sf_dir), KEY, TARGET).summary
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{c} bigint" for c in found))


_WIDE = "raw AS (" + " UNION ALL ".join(f'SELECT "SK_ID_CURR" AS id, "TARGET" AS y, \'{c}\' AS f, "{c}"::DOUBLE AS x FROM matrix' for c in _CORRELATED)
_WIDE += ' UNION ALL SELECT "SK_ID_CURR", "TARGET", \'segment\', (dense_rank() OVER (ORDER BY coalesce(segment, \'MISSING\')) - 1)::DOUBLE FROM matrix)'
_CARD = catalogue._CARD.replace(catalogue._LONG[len(MATRIX_SQL) : catalogue._LONG.index(",\nlong AS")], ", " + _WIDE)
_CARD = _DROPS + _CARD[len("WITH ") + len(MATRIX_SQL) :]
_DECIDED = f"""{_CARD}, decided AS (SELECT *, {catalogue._LEVEL}, iv >= 0.02 AND (univariate_roc_auc >= 0.55 OR lift_top_decile >= 1.5) AS selected_flag,
CASE WHEN iv < 0.02 THEN 'rejected' WHEN iv < 0.1 AND univariate_roc_auc < 0.55 THEN 'needs_optimization' ELSE 'selected' END AS decision FROM card WHERE feature_name NOT IN (SELECT feature_name FROM drops))"""


def _selected(spark, sf_dir):
    return decision.select_features(matrix(spark, sf_dir), KEY, TARGET)


@query(f"{_DECIDED} SELECT feature_name, round(iv, 6) AS iv, iv_level, selected_flag, decision FROM decided")
def selection_run(spark, sf_dir):
    return rounded(_selected(spark, sf_dir).scorecard.select("feature_name", "iv", "iv_level", "selected_flag", "decision"))


_SIGNAL_SQL = _DECIDED.replace('SELECT a."SK_ID_CURR", a."TARGET",', f'SELECT a."SK_ID_CURR", {SIGNAL} AS "TARGET",')


@query(f'{_SIGNAL_SQL} SELECT "SK_ID_CURR" AS id, "TARGET" AS target, f AS feature_name, round(x) AS value FROM matrix JOIN raw ON raw.id = "SK_ID_CURR" WHERE f <> \'segment\' AND f IN (SELECT feature_name FROM decided WHERE selected_flag)')
def selected_values(spark, sf_dir):
    """The selected matrix, for a target that has a signal, as one row a key and numeric feature."""
    made = decision.select_features(with_signal(matrix(spark, sf_dir)), KEY, TARGET).matrix
    chosen = [c for c in made.columns if c not in (KEY, TARGET, "segment")]
    if not chosen:
        return spark.createDataFrame([], "id bigint, target int, feature_name string, value double")
    return long_form(made, chosen, [KEY, TARGET]).select(F.col(KEY).alias("id"), F.col(TARGET).alias("target"), F.col("feature").alias("feature_name"), F.round("x").alias("value"))


@query(f"""{_DECIDED} SELECT {len(_IN_ORDER)}::BIGINT AS input_feature_count, count(*) AS after_filter_count, count(*) FILTER (selected_flag) AS selected_feature_count,
    round((SELECT avg("TARGET") FROM matrix), 6) AS baseline_rate, count(*) FILTER (iv_level = 'none') AS iv_none, count(*) FILTER (decision = 'rejected') AS rejected FROM decided""")
def selection_summary(spark, sf_dir):
    s = _selected(spark, sf_dir).summary
    row = (s["input_feature_count"], s["after_filter_count"], s["selected_feature_count"], round(s["baseline_rate"], 6), s["iv_distribution"].get("none", 0), s["decision_distribution"].get("rejected", 0))
    return spark.createDataFrame([row], "input_feature_count bigint, after_filter_count bigint, selected_feature_count bigint, baseline_rate double, iv_none bigint, rejected bigint")


@query(f"""{_DECIDED}, reasons AS (SELECT *, CASE WHEN iv < 0.02 THEN format('low_iv({{:.4f}})', iv) WHEN iv < 0.1 AND univariate_roc_auc < 0.55 THEN format('weak_signal(iv={{:.4f}}, auc={{:.4f}})', iv, univariate_roc_auc) ELSE '' END AS r FROM decided)
    SELECT coalesce(reasons.feature_name, drops.feature_name) AS feature_name, round(iv, 6) AS iv, decision, coalesce(nullif(r, ''), drops.drop_reason, '') AS drop_reason FROM reasons FULL JOIN drops ON reasons.feature_name = drops.feature_name""")
def final_report(spark, sf_dir):
    found = _selected(spark, sf_dir)
    return rounded(decision.final_report(found.scorecard, found.drops, include_dropped=True).select("feature_name", "iv", "decision", "drop_reason"))


@query("SELECT 'constant' AS feature_name, 0.5::DOUBLE AS univariate_roc_auc, round(avg((c_acctbal < 0)::INT), 6) AS univariate_pr_auc, 0.0::DOUBLE AS recall_at_topk, 1.0::DOUBLE AS lift_top_decile, 0.0::DOUBLE AS iv FROM customer")
def uni_constant(spark, sf_dir):
    return rounded(univariate.evaluate(matrix(spark, sf_dir), KEY, TARGET, ["constant"]))


@query('SELECT round(avg((c_acctbal < 0)::INT), 6) AS baseline_rate FROM customer')
def baseline_rate(spark, sf_dir):
    anchor = synthesis.anchor_frame(frames(spark, sf_dir), "application")
    return rounded(anchor.agg(F.avg(F.col(TARGET).cast("double")).alias("baseline_rate")))


# stability


@query(
    f"""{_PAIR}, m AS (SELECT f, l_orderkey % 2 AS o, avg((x IS NULL)::INT) AS r, avg(x) AS a, stddev_pop(x) AS s FROM li GROUP BY 1, 2)
    SELECT t.f AS feature_name, round(t.r, 6) AS train_missing_rate, round(t.a, 6) AS train_mean, round(t.s, 6) AS train_std, round(v.r, 6) AS test_missing_rate, round(v.a, 6) AS test_mean, round(v.s, 6) AS test_std
    FROM m t JOIN m v ON t.f = v.f AND t.o = 0 AND v.o = 1"""
)
def psi_moments(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    found = stability.feature_psi(li.filter("l_orderkey % 2 = 0"), li.filter("l_orderkey % 2 = 1"), _STABLE)
    return rounded(found.select("feature_name", *[f"{s}_{m}" for s in ("train", "test") for m in ("missing_rate", "mean", "std")]))


_NUMBERS = ["o_custkey", "o_orderkey", "o_totalprice"]
_CHECKED = _ORDERS.replace("SELECT o_totalprice AS x, 'o_totalprice' AS f,", "SELECT x, f, flag,").replace(
    "FROM orders, q)", "FROM (" + " UNION ALL ".join(f"SELECT {c}::DOUBLE AS x, '{c}' AS f, o_orderstatus AS flag, o_orderdate FROM orders" for c in _NUMBERS) + "), q)"
)
_BY_TIME = _psi_sql("SELECT f, x FROM li WHERE s = 0", "SELECT s AS g, f, x FROM li WHERE s > 0", "part")
_BY_SLICE = _psi_sql("SELECT f, x FROM li WHERE flag = (SELECT flag FROM biggest)", "SELECT flag AS g, f, x FROM li WHERE flag IN (SELECT flag FROM sizes) AND flag <> (SELECT flag FROM biggest)", "part")
for _name in ("base", "other", "lim", "e", "eb", "ab", "grid", "sh", "psi"):
    _BY_SLICE = _BY_SLICE.replace(f", {_name} AS (", f", s_{_name} AS (").replace(f"\n{_name} AS (", f"\ns_{_name} AS (").replace(f"FROM {_name} ", f"FROM s_{_name} ").replace(f"JOIN {_name} ", f"JOIN s_{_name} ")
    _BY_SLICE = _BY_SLICE.replace(f" {_name}.", f" s_{_name}.").replace(f"({_name}.", f"(s_{_name}.").replace(f"FROM {_name}\n", f"FROM s_{_name}\n").replace(f"SELECT {_name}.", f"SELECT s_{_name}.")
_RUN = (
    _CHECKED
    + _BY_TIME
    + ", sizes AS (SELECT o_orderstatus AS flag, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 100), biggest AS (SELECT flag FROM sizes ORDER BY n DESC, flag LIMIT 1)"
    + _BY_SLICE
    + """, worst AS (SELECT 'time' AS check_type, feature_name, max(psi) AS max_psi FROM psi GROUP BY 2 UNION ALL SELECT 'slice', feature_name, max(psi) FROM s_psi GROUP BY 2)"""
)


def _run(spark, sf_dir):
    return stability.run_checks(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderstatus")


@query(f"{_RUN} SELECT check_type, feature_name, round(max_psi, 6) AS max_psi, max_psi < 0.25 AS is_stable, {_LEVELS.format('max_psi')} FROM worst")
def stability_run(spark, sf_dir):
    return rounded(_run(spark, sf_dir).summary.select("check_type", "feature_name", "max_psi", "is_stable", "stability_level"))


@query(f"{_RUN} SELECT count(DISTINCT feature_name) AS total_features_checked, count(*) FILTER (max_psi < 0.1) AS stable, count(*) FILTER (max_psi >= 0.1 AND max_psi < 0.25) AS moderate, count(*) FILTER (max_psi >= 0.25) AS unstable FROM worst")
def stability_counts(spark, sf_dir):
    found = _run(spark, sf_dir).counts
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{c} bigint" for c in found))


