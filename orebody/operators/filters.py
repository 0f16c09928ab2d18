"""Basic filters: mostly missing, near constant, and correlated features."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.functions.expr import as_double, average_ranks, correlation, counted, long_form, numeric_columns
from orebody.sources.shared import checkpoint

DROPS = "feature_name string, drop_reason string"
#: Pairs in one aggregate.
CHUNK = 200


@dataclass(frozen=True)
class FilterResult:
    matrix: DataFrame
    kept: list[str]
    drops: DataFrame
    summary: dict = field(default_factory=dict)


def missing_rates(df: DataFrame, features: list[str]) -> DataFrame:
    """feature_name and missing_rate of every feature, in one pass."""
    cells = [F.struct(F.lit(c).alias("feature_name"), F.avg(_value(df, c).isNull().cast("double")).alias("missing_rate")) for c in features]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def constants(df: DataFrame, features: list[str]) -> DataFrame:
    """feature_name and is_constant: no two different present values."""
    cells = [F.struct(F.lit(c).alias("feature_name"), F.coalesce(F.min(_value(df, c)) == F.max(_value(df, c)), F.lit(True)).alias("is_constant")) for c in features]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def _value(df: DataFrame, c: str):
    return as_double(df, c) if c in numeric_columns(df) else F.col(f"`{c}`")


def pearson_pairs(df: DataFrame, features: list[str]) -> DataFrame:
    """feature_a, feature_b (in order) and correlation, over rows where both are present."""
    pairs = list(combinations(features, 2))
    out = None
    for i in range(0, max(len(pairs), 1), CHUNK):
        cells = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), correlation(as_double(df, a), as_double(df, b)).alias("correlation")) for a, b in pairs[i : i + CHUNK]]
        if not cells:
            return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, correlation double")
        part = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
        out = part if out is None else out.unionByName(part)
    return out


def spearman_pairs(df: DataFrame, key: str, features: list[str]) -> DataFrame:
    """As pearson_pairs, of average ranks; pairs are ranked on the rows where both are present.

    Features without nulls are ranked once; only pairs with nulls are ranked anew each.
    """
    spark = df.sparkSession
    rates = {r["feature_name"]: r["missing_rate"] for r in missing_rates(df, features).collect()} if features else {}
    whole = [c for c in features if rates[c] == 0]
    broken = [(a, b) for a, b in combinations(features, 2) if rates[a] or rates[b]]
    out = spark.createDataFrame([], "feature_a string, feature_b string, correlation double")
    if len(whole) > 1:
        rows = long_form(df, whole, [key])
        ranks = rows.join(average_ranks(counted(rows, ["feature"]), ["feature"]), ["feature", "x"]).select(key, "feature", "r")
        wide = ranks.groupBy(key).pivot("feature", whole).agg(F.first("r"))
        out = out.unionByName(pearson_pairs(wide, whole))
    by = ["feature_a", "feature_b"]
    for i in range(0, len(broken), CHUNK):
        cells = F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), as_double(df, a).alias("x"), as_double(df, b).alias("y")) for a, b in broken[i : i + CHUNK]])
        # equal pairs of values are counted together first: ranks and sums then work on these
        joint = checkpoint(df.select(F.inline(cells)).filter("x IS NOT NULL AND y IS NOT NULL").groupBy(*by, "x", "y").agg(F.count("*").alias("w")))
        rank = lambda v: average_ranks(joint.groupBy(*by, v).agg(F.sum("w").alias("n")), by, v).withColumnRenamed("r", f"r{v}")  # noqa: E731, B023
        ranked = joint.join(rank("x"), [*by, "x"]).join(rank("y"), [*by, "y"])
        out = out.unionByName(ranked.groupBy(*by).agg(weighted_correlation("rx", "ry", "w").alias("correlation")))
    return out


def weighted_correlation(x: str, y: str, w: str):
    """Pearson correlation of x and y, each row standing for w rows; null where either is constant."""
    n, a, b = F.sum(w), F.sum(F.col(w) * F.col(x)), F.sum(F.col(w) * F.col(y))
    spread = lambda total, square: F.sqrt(F.greatest(n * square - total * total, F.lit(0.0)))
    return F.try_divide(n * F.sum(F.col(w) * F.col(x) * F.col(y)) - a * b, spread(a, F.sum(F.col(w) * F.col(x) * F.col(x))) * spread(b, F.sum(F.col(w) * F.col(y) * F.col(y))))


def prune(features: list[str], pairs: list[tuple[str, str, float | None]], threshold: float) -> list[tuple[str, str]]:
    """(dropped, earliest feature that it follows), in column order; that feature may be dropped itself."""
    rho = {(a, b): abs(r) for a, b, r in pairs if r is not None}
    out = []
    for j, b in enumerate(features):
        parent = next((a for a in features[:j] if rho.get((a, b), -1) >= threshold), None)
        if parent is not None:
            out.append((b, parent))
    return out


def basic_filters(df: DataFrame, key: str, target: str, missing_threshold: float = 0.95, corr_threshold: float = 0.95) -> FilterResult:
    """Three steps of drops, each on what the one before left; the report is in the order of the steps."""
    features = [c for c in df.columns if c not in (key, target)]
    kept, drops = list(features), []
    gone = {r[0] for r in missing_rates(df, kept).filter(F.col("missing_rate") > missing_threshold).collect()} if kept else set()
    drops += [(c, "high_missing_rate") for c in kept if c in gone]
    kept = [c for c in kept if c not in gone]
    gone = {r[0] for r in constants(df, kept).filter("is_constant").collect()} if kept else set()
    drops += [(c, "near_constant") for c in kept if c in gone]
    kept = [c for c in kept if c not in gone]
    numeric = [c for c in numeric_columns(df) if c in kept]
    pairs = [tuple(r) for r in spearman_pairs(df, key, numeric).collect()]  # a row a pair of features
    followers = prune(numeric, pairs, corr_threshold)
    drops += [(c, f"high_correlation_with_{p}") for c, p in followers]
    kept = [c for c in kept if c not in dict(followers)]
    summary = {"input": len(features), "kept": len(kept), **{k: sum(r.startswith(k) for _, r in drops) for k in ("high_missing_rate", "near_constant", "high_correlation")}}
    return FilterResult(df.select(key, target, *kept), kept, df.sparkSession.createDataFrame(drops, DROPS), summary)


def correlation_groups(drops: DataFrame) -> DataFrame:
    """dropped_feature, drop_reason and the representative that the reason names."""
    prefix = "high_correlation_with_"
    rows = drops.filter(F.col("drop_reason").startswith(prefix))
    return rows.select(F.col("feature_name").alias("dropped_feature"), "drop_reason", F.expr(f"substring(drop_reason, {len(prefix) + 1})").alias("representative_feature"))
