"""From measures to decisions: IV levels, flags, reasons, the selected matrix and the reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.config import EnginePaths, SelectionConfig
from orebody.operators import filters, univariate
from orebody.sources import io
from orebody.sources.shared import checkpoint


def decide(scorecard: DataFrame, config: SelectionConfig = SelectionConfig(), stability: DataFrame | None = None) -> DataFrame:
    """Adds iv_level, selected_flag, decision and drop_reason. With a stability summary, features above max_psi go (opt-in)."""
    iv, auc, lift = F.col("iv"), F.col("univariate_roc_auc"), F.col("lift_top_decile")
    level = F.when(iv <= config.min_iv, "none").when(iv <= config.min_iv_medium, "weak").when(iv <= config.min_iv_strong, "medium").otherwise("strong")
    weak = (iv < config.min_iv_medium) & (auc < config.min_auc)
    out = (
        scorecard.withColumn("iv_level", level)
        .withColumn("selected_flag", (iv >= config.min_iv) & ((auc >= config.min_auc) | (lift >= config.min_lift)))
        .withColumn("decision", F.when(iv < config.min_iv, "rejected").when(weak, "needs_optimization").otherwise("selected"))
        .withColumn(
            "drop_reason",
            F.when(iv < config.min_iv, F.format_string("low_iv(%.4f)", iv)).when(weak, F.format_string("weak_signal(iv=%.4f, auc=%.4f)", iv, auc)).otherwise(""),
        )
    )
    if stability is not None:
        unstable = stability.groupBy("feature_name").agg(F.max("max_psi").alias("__psi")).filter(F.col("__psi") > config.max_psi)
        out = out.join(unstable, "feature_name", "left")
        gone = F.col("__psi").isNotNull()
        out = (
            out.withColumn("selected_flag", F.col("selected_flag") & ~gone)
            .withColumn("decision", F.when(gone, "rejected").otherwise(F.col("decision")))
            .withColumn("drop_reason", F.when(gone, F.format_string("unstable(psi=%.4f)", "__psi")).otherwise(F.col("drop_reason")))
            .drop("__psi")
        )
    return out


def legacy_decide(scorecard: DataFrame, baseline: float, min_auc: float = 0.52, ap_lift: float = 1.02) -> DataFrame:
    """The older rule: AUC, or average precision a little above the base rate."""
    good = (F.col("univariate_roc_auc") >= min_auc) | (F.col("univariate_pr_auc") >= baseline * ap_lift)
    return scorecard.withColumn("selected_flag", good).withColumn("drop_reason", F.when(good, "").otherwise("weak_univariate_signal"))


def final_report(scorecard: DataFrame, drops: DataFrame, include_dropped: bool = False) -> DataFrame:
    """The scorecard with the drop report's reasons; filtered features follow as rows of their own if asked."""
    known = drops.select("feature_name", F.col("drop_reason").alias("filter_reason"))
    out = scorecard.join(F.broadcast(known), "feature_name", "left") if not include_dropped else scorecard.join(known, "feature_name", "full")
    return out.withColumn("drop_reason", F.coalesce(F.nullif(F.col("drop_reason"), F.lit("")), "filter_reason", F.lit(""))).drop("filter_reason")


def top_features(scorecard: DataFrame, n: int = 10) -> DataFrame:
    return scorecard.orderBy(F.desc("iv"), "feature_name").limit(n)


@dataclass(frozen=True)
class SelectionResult:
    matrix: DataFrame
    scorecard: DataFrame
    drops: DataFrame
    groups: DataFrame
    report: DataFrame
    summary: dict


def select_features(df: DataFrame, key: str, target: str, config: SelectionConfig = SelectionConfig(), paths: EnginePaths | None = None, stability: DataFrame | None = None) -> SelectionResult:
    """Filters, scores and decides; writes matrix, tables, summary and report if paths are given."""
    df = df.filter(F.col(target).isNotNull())
    df = checkpoint(df)
    filtered = filters.basic_filters(df, key, target, config.missing_threshold, config.corr_threshold)
    card = decide(univariate.evaluate(filtered.matrix, key, target, filtered.kept, config.topk_ratio), config, stability)
    rows = card.collect()  # a row a feature, read several times below
    card = card.sparkSession.createDataFrame(rows, card.schema)
    chosen = {r["feature_name"] for r in rows if r["selected_flag"]}
    matrix = df.select(key, target, *[c for c in filtered.kept if c in chosen])
    count = lambda c: {v: sum(r[c] == v for r in rows) for v in sorted({r[c] for r in rows})}
    summary = {
        "input_feature_count": filtered.summary["input"],
        "after_filter_count": filtered.summary["kept"],
        "selected_feature_count": len(chosen),
        "baseline_rate": df.agg(F.avg(F.col(target).cast("double"))).first()[0],
        "iv_distribution": count("iv_level"),
        "decision_distribution": count("decision"),
        "criteria": {k: getattr(config, k) for k in ("min_iv", "min_iv_medium", "min_iv_strong", "min_auc", "min_lift", "topk_ratio")},
    }
    groups = filters.correlation_groups(filtered.drops)
    result = SelectionResult(matrix, card, filtered.drops, groups, final_report(card, filtered.drops), summary)
    if paths:
        out = paths.selection_dir
        io.write_matrix(matrix, f"{out}/selected_features.parquet")
        for name, table in (("feature_scorecard", card), ("dropped_by_basic_filters", filtered.drops), ("correlation_groups", groups), ("feature_selection_report", result.report)):
            io.write_report(table, f"{out}/{name}.csv")
        io.write_json(summary, f"{out}/feature_selection_report.json")
        io.write_text(selection_report(result), f"{out}/feature_selection_report.md")
    return result


def selection_report(result: SelectionResult) -> str:
    s = result.summary
    lines = ["# Feature selection", "", f"Features: {s['input_feature_count']} in, {s['after_filter_count']} after filters, {s['selected_feature_count']} selected.", f"Base rate: {s['baseline_rate']}", "", "| feature | IV | AUC | lift | decision |", "| --- | --- | --- | --- | --- |"]
    for r in top_features(result.scorecard, 20).collect():
        lines.append(f"| {r['feature_name']} | {r['iv']:.4f} | {r['univariate_roc_auc']:.4f} | {r['lift_top_decile']:.2f} | {r['decision']} |")
    lines += ["", "| level | features |", "| --- | --- |", *[f"| {k} | {v} |" for k, v in s["iv_distribution"].items()], "", "| decision | features |", "| --- | --- |"]
    return "\n".join([*lines, *[f"| {k} | {v} |" for k, v in s["decision_distribution"].items()], ""])
