"""Stability: population stability index between two samples, over time splits and over slices."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.functions.expr import counted, long_form, numeric_columns, quantiles
from orebody.operators.univariate import bin_of, edges
from orebody.sources import io

#: (below, level); what is not below any is unstable.
LEVELS = ((0.1, "stable"), (0.25, "moderate"))
MIN_SHARE = 0.01


def level_of(psi):
    return F.when(psi < LEVELS[0][0], LEVELS[0][1]).when(psi < LEVELS[1][0], LEVELS[1][1]).otherwise("unstable")


def psi_between(base: DataFrame, other: DataFrame, by: list[str], bins: int = 10, min_share: float = MIN_SHARE) -> DataFrame:
    """by, psi. ``base`` has feature and x, ``other`` by (feature among them) and x; nulls count on neither side.

    Bins are base's deciles; every bin counts, empty ones with the least share.
    """
    base, other = base.filter("x IS NOT NULL"), other.filter("x IS NOT NULL")
    cuts = edges(base, ["feature"], bins)
    held = lambda rows, keys: rows.join(F.broadcast(cuts), "feature").groupBy(*keys, bin_of(F.col("x")).alias("bin")).agg(F.count("*").alias("n"))
    e, a = held(base, ["feature"]), held(other, by)
    e_total, a_total = e.groupBy("feature").agg(F.sum("n").alias("e_all")), a.groupBy(*by).agg(F.sum("n").alias("a_all"))
    grid = a_total.join(e_total, "feature").join(cuts, "feature").withColumn("bin", F.explode(F.sequence(F.lit(0), F.size("edges"))))
    both = grid.join(e.withColumnRenamed("n", "en"), ["feature", "bin"], "left").join(a.withColumnRenamed("n", "an"), [*by, "bin"], "left")
    share = lambda n, total: F.greatest(F.coalesce(F.col(n), F.lit(0)).cast("double") / F.col(total).cast("double"), F.lit(min_share))
    p = both.withColumn("a", share("an", "a_all")).withColumn("e", share("en", "e_all"))
    return p.groupBy(*by).agg(F.sum(F.when(F.size("edges") > 0, (F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))).otherwise(0.0)).alias("psi"))


def moments(rows: DataFrame, by: list[str], side: str) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.avg(F.col("x").isNull().cast("double")).alias(f"{side}_missing_rate"), F.avg("x").alias(f"{side}_mean"), F.stddev_pop("x").alias(f"{side}_std")
    )


def compare(base: DataFrame, other: DataFrame, by: list[str]) -> DataFrame:
    """by, psi, is_stable, stability_level and both sides' missing rate, mean and deviation."""
    psi = psi_between(base, other, by)
    out = moments(other, by, "test").join(moments(base, ["feature"], "train"), "feature").join(psi, by, "left")
    out = out.withColumn("psi", F.coalesce("psi", F.lit(0.0)))
    return out.withColumn("stability_level", level_of(F.col("psi"))).withColumn("is_stable", F.col("psi") < LEVELS[1][0]).withColumnRenamed("feature", "feature_name")


def feature_psi(expected: DataFrame, actual: DataFrame, features: list[str] | None = None) -> DataFrame:
    """PSI and moments of every shared numeric feature between two tables."""
    features = features or [c for c in numeric_columns(expected) if c in actual.columns]
    return compare(long_form(expected, features, []), long_form(actual, features, []), ["feature"])


def summarise(detail: DataFrame) -> DataFrame:
    """feature_name, max_psi, is_stable (in all) and the worst stability_level."""
    order = F.when(F.col("stability_level") == "stable", 0).when(F.col("stability_level") == "moderate", 1).otherwise(2)
    worst = detail.groupBy("feature_name").agg(F.max("psi").alias("max_psi"), F.bool_and("is_stable").alias("is_stable"), F.max(order).alias("__worst"))
    names = F.when(F.col("__worst") == 0, "stable").when(F.col("__worst") == 1, "moderate").otherwise("unstable")
    return worst.withColumn("stability_level", names).drop("__worst")


def _features(df: DataFrame, drop: list[str | None], features: list[str] | None) -> list[str]:
    return features or [c for c in numeric_columns(df) if c not in drop]


def time_splits(df: DataFrame, time_col: str, n_splits: int = 3) -> DataFrame:
    """Adds split_index: first up to the first time quantile, then (q_i, q_i+1], last above; null times are left out."""
    if n_splits < 2:
        raise ValueError("n_splits must be at least 2")
    kind = dict(df.dtypes)[time_col]
    t = F.col(f"`{time_col}`").cast("timestamp").cast("double") if kind.startswith(("timestamp", "date")) else F.col(f"`{time_col}`").cast("double")
    rows = df.withColumn("__t", t).filter("__t IS NOT NULL")
    times = counted(rows.withColumn("__all_rows", F.lit(0)), ["__all_rows"], "__t")
    q = quantiles(times, ["__all_rows"], [i / n_splits for i in range(1, n_splits)], "__t").first()
    if q is None:
        raise ValueError(f"no times in {time_col}")
    return rows.withColumn("split_index", sum((F.col("__t") > v).cast("int") for v in q["q"])).drop("__t")


def time_stability(df: DataFrame, time_col: str, n_splits: int = 3, features: list[str] | None = None, drop: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(detail, summary) of the later splits against the first."""
    features = _features(df, [time_col, *drop], features)
    rows = long_form(time_splits(df, time_col, n_splits), features, ["split_index"])
    detail = compare(rows.filter("split_index = 0").drop("split_index"), rows.filter("split_index > 0"), ["feature", "split_index"])
    detail = detail.withColumn("split_label", F.format_string("split_%d_vs_0", "split_index"))
    return detail, summarise(detail)


def slice_consistency(df: DataFrame, slice_col: str, min_slice_size: int = 100, features: list[str] | None = None, drop: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(detail, summary) of the slices of enough rows against the largest (the first by name of equals)."""
    sizes = df.filter(F.col(slice_col).isNotNull()).groupBy(F.col(slice_col).cast("string").alias("slice_name")).count().filter(F.col("count") >= min_slice_size)
    base = sizes.orderBy(F.desc("count"), "slice_name").limit(2).collect()
    if len(base) < 2:
        raise ValueError(f"fewer than two slices of {min_slice_size} rows in {slice_col}")
    features = _features(df, [slice_col, *drop], features)
    rows = long_form(df.withColumn("slice_name", F.col(slice_col).cast("string")).join(sizes.select("slice_name"), "slice_name", "left_semi"), features, ["slice_name"])
    first = F.col("slice_name") == base[0]["slice_name"]
    detail = compare(rows.filter(first).drop("slice_name"), rows.filter(~first), ["feature", "slice_name"])
    return detail, summarise(detail)


@dataclass(frozen=True)
class StabilityResult:
    time_detail: DataFrame | None
    slice_detail: DataFrame | None
    summary: DataFrame | None
    counts: dict
    report: str


def run_checks(df: DataFrame, time_col: str | None = None, slice_col: str | None = None, output: str | None = None, drop: tuple[str, ...] = (), **params) -> StabilityResult:
    """Time and slice checks, their summaries one below the other; level counts are of rows, the total of features."""
    time_detail = slice_detail = None
    parts = []
    if time_col:
        time_detail, s = time_stability(df, time_col, params.get("n_splits", 3), drop=(*drop, *([slice_col] if slice_col else [])))
        parts.append(s.withColumn("check_type", F.lit("time")))
    if slice_col:
        slice_detail, s = slice_consistency(df, slice_col, params.get("min_slice_size", 100), drop=(*drop, *([time_col] if time_col else [])))
        parts.append(s.withColumn("check_type", F.lit("slice")))
    summary = None
    for p in parts:
        summary = p if summary is None else summary.unionByName(p)
    counts = {"total_features_checked": 0, "stable": 0, "moderate": 0, "unstable": 0}
    if summary is not None:
        counts = summary.agg(F.count_distinct("feature_name").alias("total_features_checked"), *[F.count_if(F.col("stability_level") == v).alias(v) for v in ("stable", "moderate", "unstable")]).first().asDict()
    report = stability_report(summary, counts)
    if output:
        for name, detail in (("time_stability", time_detail), ("slice_consistency", slice_detail)):
            if detail is not None:
                io.write_report(detail, f"{output}/{name}_detail.csv")
                io.write_report(summarise(detail), f"{output}/{name}_summary.csv")
        io.write_text(report, f"{output}/stability_report.md")
    return StabilityResult(time_detail, slice_detail, summary, counts, report)


def stability_report(summary: DataFrame | None, counts: dict) -> str:
    lines = ["# Stability", "", *[f"{k}: {v}" for k, v in counts.items()]]
    for level in ("unstable", "moderate") if summary is not None else ():
        lines += ["", f"## {level}", "", "| feature | check | PSI |", "| --- | --- | --- |"]
        rows = summary.filter(F.col("stability_level") == level).orderBy(F.desc("max_psi"), "feature_name").limit(20).collect()
        lines += [f"| {r['feature_name']} | {r['check_type']} | {r['max_psi']:.4f} |" for r in rows]
    return "\n".join([*lines, ""])
