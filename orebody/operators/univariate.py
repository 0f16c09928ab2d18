"""Univariate scores of all features in one plan: AUC, average precision, recall at top k, lift and IV.

Rows become (id, y, feature, x); equal scores are counted together, and running counts over scores are
prefix sums in two levels, so that no task holds a whole feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebody.functions.expr import counted, long_form, numbered, numeric_columns, prefix_sums, quantiles
from orebody.sources.shared import checkpoint

LIFT_SHARE = 0.10
MISSING = "MISSING"
FLOOR = 1e-10


def coded(df: DataFrame, column: str) -> DataFrame:
    """(value, code): each string, null as MISSING, and its place among the sorted distinct values."""
    values = df.select(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(MISSING)).alias("value")).distinct()
    return numbered(values, [], ["value"], "code").withColumn("code", (F.col("code") - 1).cast("double"))


def scores(df: DataFrame, key: str, target: str, features: list[str]) -> DataFrame:
    """(id, y, feature, x) without nulls in x: medians for missing numbers (0 if all are), codes for strings; y must be present."""
    df = df.filter(F.col(target).isNotNull())
    numeric = [c for c in numeric_columns(df) if c in features]
    texts = [c for c in features if c not in numeric]
    base = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{target}`").cast("int").alias("y"), *[F.col(f"`{c}`") for c in features])
    out = None
    if numeric:
        rows = long_form(base, numeric, ["id", "y"])
        medians = quantiles(counted(rows, ["feature"]), ["feature"], [0.5]).select("feature", F.col("q")[0].alias("m"))  # a row a feature
        out = rows.join(F.broadcast(medians), "feature", "left").select("id", "y", "feature", F.coalesce("x", "m", F.lit(0.0)).alias("x"))
    for c in texts:
        codes = coded(base, c)
        part = base.select("id", "y", F.lit(c).alias("feature"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING)).alias("value")).join(codes, "value")
        part = part.select("id", "y", "feature", F.col("code").alias("x"))
        out = part if out is None else out.unionByName(part)
    return checkpoint(out)  # every measure reads it several times


def ranking(rows: DataFrame) -> DataFrame:
    """feature, n, pos, auc, ap_up and ap_down (average precision of x and of -x); neutral for one class or one value."""
    groups = rows.groupBy("feature", "x").agg(F.sum("y").alias("p"), F.count("*").alias("n"))
    run = prefix_sums(groups, ["feature"], "x", ["p", "n"])
    totals = rows.groupBy("feature").agg(F.sum("y").alias("pos_all"), F.count("*").alias("n_all"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    run = run.join(F.broadcast(totals), "feature")
    p, n = F.col("p").cast("double"), F.col("n").cast("double")
    neg_below = (F.col("n_below") - F.col("p_below")).cast("double")
    up_p, up_n = F.col("pos_all") - F.col("p_below"), F.col("n_all") - F.col("n_below")
    down_p, down_n = F.col("p_below") + F.col("p"), F.col("n_below") + F.col("n")
    out = run.groupBy("feature", "pos_all", "n_all", "lo", "hi").agg(
        F.sum(p * (neg_below + (n - p) / 2)).alias("u"),
        F.sum(p * up_p.cast("double") / up_n.cast("double")).alias("up"),
        F.sum(p * down_p.cast("double") / down_n.cast("double")).alias("down"),
    )
    plain = (F.col("lo") == F.col("hi")) | (F.col("pos_all") == 0) | (F.col("pos_all") == F.col("n_all"))
    base = F.col("pos_all").cast("double") / F.col("n_all").cast("double")
    div = lambda a, b: F.try_divide(F.col(a), b)
    return out.select(
        "feature",
        F.col("n_all").alias("n"),
        F.col("pos_all").alias("pos"),
        plain.alias("plain"),
        F.when(plain, 0.5).otherwise(div("u", F.col("pos_all").cast("double") * (F.col("n_all") - F.col("pos_all")))).alias("auc"),
        F.when(plain, base).otherwise(div("up", F.col("pos_all").cast("double"))).alias("ap_up"),
        F.when(plain, base).otherwise(div("down", F.col("pos_all").cast("double"))).alias("ap_down"),
    )


def top_share(rows: DataFrame, ranked: DataFrame, share: float) -> DataFrame:
    """feature, top (rows taken) and hits (positives in them): the best max(1, floor(n * share)) rows by score, then id.

    Whole groups of equal scores are taken by their counts; only the group at the edge is ordered by id.
    """
    sign = ranked.select("feature", F.when(F.col("ap_up") >= F.col("ap_down"), 1.0).otherwise(-1.0).alias("sign"), F.greatest(F.lit(1), F.floor(F.col("n").cast("double") * share)).cast("long").alias("top"))
    signed = rows.join(F.broadcast(sign), "feature").withColumn("s", -F.col("x") * F.col("sign"))
    groups = signed.groupBy("feature", "s", "top").agg(F.sum("y").alias("p"), F.count("*").alias("n"))
    run = prefix_sums(groups, ["feature"], "s", ["n"])
    inside = run.filter("n_below + n <= top").groupBy("feature").agg(F.sum("p").alias("p_in"))
    edge = run.filter("n_below < top AND n_below + n > top").select("feature", "s", (F.col("top") - F.col("n_below")).alias("take"))
    at_edge = signed.select("feature", "s", "id", "y").join(F.broadcast(edge), ["feature", "s"]).select("feature", "id", "y", "take")  # an edge a feature
    at_edge = numbered(at_edge, ["feature"], ["id"], "k").filter("k <= take").groupBy("feature").agg(F.sum("y").alias("p_edge"))
    out = sign.join(inside, "feature", "left").join(at_edge, "feature", "left")
    return out.select("feature", "top", (F.coalesce("p_in", F.lit(0)) + F.coalesce("p_edge", F.lit(0))).alias("hits"))


def edges(rows: DataFrame, by: list[str], bins: int = 10) -> DataFrame:
    """by, edges: the distinct inner quantiles strictly between least and greatest x."""
    counts = checkpoint(counted(rows, by))
    ends = counts.groupBy(*by).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    found = quantiles(counts, by, [i / bins for i in range(1, bins)]).join(F.broadcast(ends), by)
    return found.select(*by, F.array_sort(F.array_distinct(F.filter("q", lambda e: (e > F.col("lo")) & (e < F.col("hi"))))).alias("edges"))


def bin_of(x):
    return F.size(F.filter("edges", lambda e: e <= x))


def information_value(rows: DataFrame, bins: int = 10) -> DataFrame:
    """feature and iv: sum of (good - bad) * ln(good / bad) over the bins that have rows; 0 for one bin or one class."""
    cut = rows.join(F.broadcast(edges(rows, ["feature"], bins)), "feature")
    counts = cut.groupBy("feature", bin_of(F.col("x")).alias("bin")).agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good"))
    w = Window.partitionBy("feature")
    share = lambda c: F.greatest(F.try_divide(F.col(c).cast("double"), F.sum(c).over(w)), F.lit(FLOOR))
    parts = counts.withColumn("g", share("good")).withColumn("b", share("bad"))
    total = parts.groupBy("feature").agg(F.sum((F.col("g") - F.col("b")) * F.log(F.col("g") / F.col("b"))).alias("iv"), F.sum("good").alias("good_all"), F.sum("bad").alias("bad_all"), F.count("*").alias("k"))
    return total.select("feature", F.when((F.col("good_all") == 0) | (F.col("bad_all") == 0) | (F.col("k") < 2), 0.0).otherwise(F.coalesce("iv", F.lit(0.0))).alias("iv"))


def evaluate(df: DataFrame, key: str, target: str, features: list[str] | None = None, topk_ratio: float = 0.10) -> DataFrame:
    """The scorecard's measures, one row a feature; the direction with the better average precision counts."""
    features = features if features is not None else [c for c in df.columns if c not in (key, target)]
    schema = "feature_name string, univariate_roc_auc double, univariate_pr_auc double, recall_at_topk double, lift_top_decile double, iv double"
    if not features:
        return df.sparkSession.createDataFrame([], schema)
    rows = scores(df, key, target, features)
    ranked = checkpoint(ranking(rows))  # a row a feature
    recall = top_share(rows, ranked, topk_ratio).select("feature", F.col("hits").alias("hits_k"))
    lift = top_share(rows, ranked, LIFT_SHARE).select("feature", "top", F.col("hits").alias("hits_d"))
    all_ = ranked.join(recall, "feature").join(lift, "feature").join(information_value(rows), "feature")
    base = F.col("pos").cast("double") / F.col("n").cast("double")
    better = F.col("ap_up") >= F.col("ap_down")
    one_class = (F.col("pos") == 0) | (F.col("pos") == F.col("n"))
    plain = F.col("plain")
    return all_.select(
        F.col("feature").alias("feature_name"),
        F.when(plain | better, F.col("auc")).otherwise(1 - F.col("auc")).alias("univariate_roc_auc"),
        F.when(better, F.col("ap_up")).otherwise(F.col("ap_down")).alias("univariate_pr_auc"),
        F.when(plain | one_class, 0.0).otherwise(F.coalesce(F.try_divide(F.col("hits_k").cast("double"), F.col("pos")), F.lit(0.0))).alias("recall_at_topk"),
        F.when(plain | one_class | (base < 1e-9), 1.0).otherwise(F.try_divide(F.col("hits_d").cast("double") / F.col("top"), base)).alias("lift_top_decile"),
        F.when(plain, 0.0).otherwise(F.col("iv")).alias("iv"),
    )
