"""Hand-computed fixtures for nulls, ties and degenerate cases, and plan checks."""

import json

import pytest

import __spark_entry__
from orebody import archive, registry
from orebody.config import AutoFeatureConfig, EntityConfig
from orebody.functions.expr import average_ranks, counted, long_form, numbered, quantiles
from orebody.operators import advanced, candidates, composite, decision, filters, profile, stability, synthesis, themes, univariate
from orebody.operators.entity import build_graph, semi_join
from orebody.plans import catalogue


def test_entry_and_names(spark):
    q, o = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(o) <= set(q) and len(q) > 40
    assert {"velocity_counts", "uni_auc", "psi_pair", "model_gain"} <= set(q)


def test_velocity_boundaries(spark):
    prev = spark.createDataFrame([(1, -30), (1, -7), (1, -7), (1, None), (2, -1), (2, -2)], "SK_ID_CURR long, DAYS_DECISION int")
    bureau = spark.createDataFrame([(1, -31)], "SK_ID_CURR long, DAYS_CREDIT int")
    anchor = spark.createDataFrame([(1,), (2,), (3,)], "SK_ID_CURR long")
    got = {r[0]: tuple(r[1:]) for r in themes.semantic_features({"previous_applications": prev, "bureau": bureau}, anchor, ["velocity", "unknown"]).matrix.collect()}
    assert got == {1: (2, 3, 11.5, 0), 2: (2, 2, None, None), 3: (None, None, None, None)}


def test_cashout_late(spark):
    prev = spark.createDataFrame([(10, 1), (11, 2)], "SK_ID_PREV long, SK_ID_CURR long")
    inst = spark.createDataFrame([(10, 1, 0, None), (10, 2, 0, 0), (10, 3, 0, 1), (10, 4, 0, 31), (11, 2, 0, 5)], "SK_ID_PREV long, NUM_INSTALMENT_NUMBER int, DAYS_INSTALMENT int, DAYS_ENTRY_PAYMENT int")
    card = spark.createDataFrame([], "SK_ID_PREV long, AMT_DRAWINGS_ATM_CURRENT double, AMT_DRAWINGS_CURRENT double")
    f = {"previous_application": prev, "installments_payments": inst, "credit_card_balance": card}
    got = {r.SK_ID_CURR: (r.cashout_first_payment_delinquency_days_max, r.cashout_fpd_severe_flag, r.cashout_installments_late_ratio) for r in themes.get_theme("cashout").build(f, prev.select("SK_ID_CURR")).collect()}
    assert got == {1: (None, 0, 0.5), 2: (None, None, 1.0)}


def test_composites(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, None), (None, 4.0)], "a double, b double")
    specs = [composite.CompositeSpec("r", "a / b"), composite.CompositeSpec("w", "np.where(r > 0, 1, fillna(b, -1))"), composite.CompositeSpec("bad", "__import__('os')"), composite.CompositeSpec("gone", "a + zz")]
    made = composite.build_composites(df, specs)
    assert [s.feature_name for s in made.valid] == ["r", "w"] and [n for n, _ in made.rejected] == ["bad", "gone"]
    assert [(x.r, x.w) for x in made.matrix.collect()] == [(None, 0.0), (None, -1.0), (None, 4.0)]
    assert [x[0] for x in df.select(composite.cross("a", "b", "/")).collect()] == [None, None, 0.0]


def test_univariate(spark):
    rows = [(1, 1, 3.0, 1.0), (2, 0, 1.0, 1.0), (3, 1, 1.0, 1.0), (4, 0, 0.0, 1.0), (5, 0, None, 1.0)]
    card = {r.feature_name: r for r in univariate.evaluate(spark.createDataFrame(rows, "id int, y int, x double, k double"), "id", "y").collect()}
    assert card["x"].univariate_roc_auc == pytest.approx(5 / 6)
    assert card["x"].univariate_pr_auc == pytest.approx(0.5 * 1 + 0.5 * 2 / 4)
    assert (card["k"].univariate_roc_auc, card["k"].recall_at_topk, card["k"].lift_top_decile, card["k"].iv) == (0.5, 0.0, 1.0, 0.0)
    one = univariate.evaluate(spark.createDataFrame([(1, 0, 1.0), (2, 0, 2.0)], "id int, y int, x double"), "id", "y").first()
    assert (one.univariate_roc_auc, one.lift_top_decile, one.iv) == (0.5, 1.0, 0.0)


def test_decisions(spark):
    schema = "feature_name string, univariate_roc_auc double, univariate_pr_auc double, recall_at_topk double, lift_top_decile double, iv double"
    card = spark.createDataFrame([("a", 0.6, 0.0, 0.0, 1.0, 0.02), ("b", 0.5, 0.0, 0.0, 1.0, 0.1), ("c", 0.5, 0.0, 0.0, 2.0, 0.05), ("d", 0.9, 0.0, 0.0, 3.0, 0.0199)], schema)
    got = {r.feature_name: (r.iv_level, r.selected_flag, r.decision, r.drop_reason) for r in decision.decide(card).collect()}
    assert got["a"] == ("none", True, "selected", "") and got["b"] == ("weak", False, "selected", "")
    assert got["c"] == ("weak", True, "needs_optimization", "weak_signal(iv=0.0500, auc=0.5000)")
    assert got["d"] == ("none", False, "rejected", "low_iv(0.0199)")


def test_filters(spark):
    rows = [(i, i % 2, float(i), 2.0 * i, 5.0, None if i else 1.0, bool(i % 3), float(i * 7 % 10) if i % 4 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, y int, a double, b double, c double, m double, flag boolean, n double")
    got = filters.basic_filters(df, "id", "y")
    assert [tuple(r) for r in got.drops.collect()] == [("m", "high_missing_rate"), ("c", "near_constant"), ("b", "high_correlation_with_a")]
    assert got.kept == ["a", "flag", "n"]
    assert filters.prune(["a", "b", "c"], [("a", "b", 0.99), ("b", "c", -0.97), ("a", "c", None)], 0.95) == [("b", "a"), ("c", "b")]


def test_psi(spark):
    a = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    b = spark.createDataFrame([(float(i),) for i in range(50)] + [(None,)], "x double")
    same, half = stability.feature_psi(a, a).first(), stability.feature_psi(a, b).first()
    assert same.psi == 0 and half.psi > 0.25 and half.stability_level == "unstable" and same.is_stable
    with pytest.raises(ValueError):
        stability.time_splits(a, "x", 1)


def test_graph(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(10, 1, 2.0, "u"), (11, 1, 4.0, "v"), (12, 3, 9.0, "w")], "cid int, pid int, v double, s string")
    configs = [EntityConfig("p", "", "id"), EntityConfig("c", "", "cid", "p", "pid")]
    graph = build_graph(spark, configs, frames={"p": parent, "c": child})
    assert graph.get_frame("c").count() == 2 and graph.verify()["relationships"] == ["p.id <- c.pid"]
    row = {r.id: r for r in synthesis.synthesise(graph, "p").matrix.collect()}
    assert (row[1].count_c, row[1].sum_c_v, row[1].num_unique_c_s, row[2].count_c, row[2].mean_c_v) == (2, 6.0, 2, 0, None)
    assert semi_join(child, "pid", parent.limit(0), "id").count() == 0
    assert "LeftSemi" in semi_join(child, "pid", parent, "id")._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        build_graph(spark, [configs[1]], frames={"c": child})


def test_profile(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "a", None)], "row_id int, s string, x double")
    got = {r.column: r for r in profile.column_quality(t).collect()}
    assert (got["x"].null_rate, got["s"].unique_count, got["row_id"].mean, got["s"].sample_values) == (0.5, 1, 1.5, ["a", "a"])
    assert profile.detect_primary_key(t) == ["row_id"] and profile.column_quality(t.limit(0)).count() == 3
    assert profile.orphan_rate(t.limit(0), t, "row_id").first()["orphan_rate"] == 0


def test_no_python_in_plans(spark):
    df = spark.range(50).selectExpr("id", "cast(id % 3 = 0 as int) y", "cast(id as double) x")
    plan = univariate.ranking(long_form(df, ["x"], ["id", "y"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_registry_and_archive(tmp_path, capsys):
    path = str(tmp_path / "registry.json")
    base = ["--path", path]
    assert registry.main([*base, "register", "--name", "velocity_7d", "--theme", "velocity", "--hypothesis", "h"]) == 0
    assert registry.main([*base, "register", "--name", "velocity_7d", "--theme", "velocity", "--hypothesis", "h"]) == 0
    assert "warning" in capsys.readouterr().out
    assert registry.main([*base, "update", "--name", "velocity_7d", "--status", "validated"]) == 0
    assert registry.main([*base, "update", "--name", "none", "--status", "validated"]) == 1
    assert registry.main([*base, "export", "--output", str(tmp_path / "f.csv")]) == 0
    assert json.load(open(path))["features"][0]["status"] == "validated" and "velocity_7d" in (tmp_path / "f.csv").read_text()
    (tmp_path / "outputs" / "selection").mkdir(parents=True)
    (tmp_path / "outputs" / "selection" / "feature_selection_report.json").write_text('{"selected_feature_count": 2}')
    (tmp_path / "README.md").write_text("stays")
    folder = archive.archive(tmp_path, "First Run!")
    assert (folder / "project" / "outputs" / "selection").exists() and (tmp_path / "README.md").exists()
    assert all((tmp_path / "outputs" / n).is_dir() for n in archive.WORKSPACE) and "selected_feature_count" in (folder / "summary.md").read_text()


def test_model_queries_run_whole(spark, monkeypatch):
    calls = {}
    for name in ("model_gain", "forward_selection"):
        monkeypatch.setattr(advanced, name, lambda df, key, target, *features, _name=name, **model: calls.update({_name: (features, model)}))
        catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")
    numeric = {*catalogue.NUMERIC, "order_total_twice", "constant", "mostly_null"}
    assert set(calls["forward_selection"][0][0]) == set().union(*calls["model_gain"][0]) == numeric
    assert calls["forward_selection"][1] == calls["model_gain"][1] == {}


def test_cross_auc_feature_of_one_fold(spark):
    rows = [(f, k % 2, float(k), 1.0 if f == 0 else None) for f in range(2) for k in range(20)]
    df = spark.createDataFrame(rows, "__fold int, y int, x double, once double")
    assert 0 <= advanced.cross_auc(df, "y", ["x", "once"], folds=2, trees=2) <= 1


def test_ranks_and_quantiles(spark):
    import numpy as np

    rnd = np.random.default_rng(0)
    rows = [(f, float(v)) for f in "ab" for v in rnd.integers(0, 12, 301 if f == "a" else 40)] + [("a", None), ("c", 7.0)]
    df = spark.createDataFrame(rows, "f string, x double")
    counts = counted(df, ["f"])
    steps = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = {r.f: r.q for r in quantiles(counts, ["f"], steps).collect()}
    for f in "abc":
        assert got[f] == pytest.approx(np.quantile([x for g, x in rows if g == f and x is not None], steps))
    ranks = {(r.f, r.x): r.r for r in average_ranks(counts.filter("x IS NOT NULL"), ["f"]).collect()}
    own = sorted(x for g, x in rows if g == "b")
    assert all(ranks["b", v] == np.mean([k + 1 for k, x in enumerate(own) if x == v]) for v in set(own))
    placed = numbered(df, ["f"], ["x"], "k").collect()
    for f in "abc":
        own = sorted((r.k, r.x) for r in placed if r.f == f)
        assert [k for k, _ in own] == list(range(1, len(own) + 1)) and [x for _, x in own if x is not None] == sorted(x for _, x in own if x is not None)
    assert numbered(df.limit(0), [], ["x"], "k").count() == 0


def test_spearman_with_nulls(spark):
    import numpy as np

    rnd = np.random.default_rng(3)
    rows = [(i, float(rnd.integers(0, 5)), None if rnd.random() < 0.3 else float(rnd.integers(0, 9)), 0.0 if rnd.random() < 0.8 else float(i)) for i in range(200)]
    got = {(r.feature_a, r.feature_b): r.correlation for r in filters.spearman_pairs(spark.createDataFrame(rows, "id int, a double, b double, z double"), "id", ["a", "b", "z"]).collect()}

    def rank(v):
        return [np.mean([k + 1 for k, x in enumerate(sorted(v)) if x == y]) for y in v]

    for i, j, pair in ((1, 2, ("a", "b")), (1, 3, ("a", "z")), (2, 3, ("b", "z"))):
        both = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
        assert got[pair] == pytest.approx(np.corrcoef(rank([x for x, _ in both]), rank([y for _, y in both]))[0, 1])


def test_stratified_folds(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(90)], "id int, y int")
    sizes = {(r.y, r["__fold"]): r["count"] for r in advanced.with_folds(df, "id", "y").groupBy("y", "__fold").count().collect()}
    assert sizes == {(0, f): 27 for f in range(3)} | {(1, f): 3 for f in range(3)}


def test_candidate_run_and_files(spark, tmp_path):
    parent = spark.createDataFrame([(1, 0, 5.0), (2, 1, None)], "SK_ID_CURR long, TARGET int, DAYS_BIRTH double")
    prev = spark.createDataFrame([(10, 1, 2.0, -3), (11, 1, 4.0, -20), (12, 3, 9.0, -1)], "SK_ID_PREV long, SK_ID_CURR long, v double, DAYS_DECISION int")
    bureau = spark.createDataFrame([(1, -5)], "SK_ID_CURR long, DAYS_CREDIT int")
    frames = {"application": parent, "previous_application": prev, "bureau": bureau}
    graph = build_graph(spark, [EntityConfig("application", "", "SK_ID_CURR"), EntityConfig("p", "", "SK_ID_PREV", "application", "SK_ID_CURR")], frames={"application": parent, "p": prev.drop("DAYS_DECISION")})
    made = candidates.run_candidates(graph, frames, "application", "SK_ID_CURR", "TARGET", output=str(tmp_path))
    row = {r.SK_ID_CURR: r for r in made.matrix.collect()}
    assert (row[1].sum_p_v, row[1].velocity_prev_count_7d, row[2].count_p, row[2].velocity_prev_count_7d) == (6.0, 1, 0, None)
    assert json.load(open(tmp_path / "candidate_pool_summary.json")) == made.summary and made.summary["row_count"] == 2
    assert spark.read.parquet(str(tmp_path / "candidate_pool.parquet")).count() == 2
    for name in ("auto/auto_feature_matrix.parquet", "auto/auto_feature_defs.csv", "semantic/semantic_feature_matrix.parquet", "semantic/semantic_feature_registry.csv"):
        assert (tmp_path / name).exists()
    alone = candidates.run_candidates(None, frames, "application", "SK_ID_CURR", "TARGET")
    assert alone.auto is None and alone.summary["auto_feature_count"] == 0 and alone.matrix.count() == 2
    one = candidates.run_auto(graph, "application", AutoFeatureConfig(sample_size=1)).matrix.collect()
    assert len(one) == 1 and one[0].count_p == {1: 2, 2: 0}[one[0].SK_ID_CURR]
    built = composite.build_composites(made.matrix.withColumn("EXT_SOURCE_2", made.matrix.velocity_prev_count_7d * 0.5).withColumnRenamed("velocity_prev_count_30d", "prev_app_count_30d"), composite.example_specs(), str(tmp_path))
    assert [s.feature_name for s in built.valid] == ["composite_velocity_x_external"] and len(built.rejected) == 3
    assert (tmp_path / "composite_feature_matrix.parquet").exists() and (tmp_path / "composite_feature_specs.csv").exists()


def test_advanced_files(spark, tmp_path):
    df = spark.createDataFrame([(i, int(i % 3 == 0), float(i % 3), float(i % 7), 2.0 * (i % 7)) for i in range(90)], "id int, y int, a double, b double, c double")
    made = advanced.run_advanced(df, "id", "y", output=str(tmp_path), base_count=1, folds=2, trees=3, depth=2)
    assert made.summary == {"feature_count": 3, "duplicate_pairs": 1, "positive_gain": made.summary["positive_gain"]}
    steps = advanced.forward_selection(df, "id", "y", ["a", "b", "c"], folds=2, trees=3, depth=2, output=str(tmp_path)).collect()
    assert steps[0].feature_name == "a" and steps[0].cumulative_auc == 1.0 and len(steps) == 1
    for name in ("duplicate_features.csv", "model_gain_report.csv", "incremental_gain_report.csv"):
        assert (tmp_path / name).exists()
