"""Null-safe arithmetic, guarded correlation and feature-long form; all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebody.sources.shared import checkpoint


def nullif0(c: Column) -> Column:
    return F.nullif(c, F.lit(0).cast("double"))


def coalesce0(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or either is null."""
    return a.cast("double") / nullif0(b.cast("double"))


def count_if(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0))


def true_int(condition: Column) -> Column:
    """1 where the condition holds; 0 where it fails or is null."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def clip(c: Column, lo: float, hi: float) -> Column:
    """Null stays null (least and greatest alone would skip it)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def correlation(a: Column, b: Column) -> Column:
    """Pearson over the rows where both are present; null where either is constant."""
    both = a.isNotNull() & b.isNotNull()
    spread = F.stddev_pop(F.when(both, a)) * F.stddev_pop(F.when(both, b))
    return F.try_divide(F.covar_pop(a, b), spread)


def numeric_columns(df: DataFrame, drop: tuple[str, ...] = ()) -> list[str]:
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")
    return [c for c, t in df.dtypes if c not in drop and (t in kinds or t.startswith("decimal"))]


def as_double(df: DataFrame, c: str) -> Column:
    """Booleans become 0 and 1, NaN becomes null."""
    x = F.col(f"`{c}`")
    x = x.cast("int").cast("double") if dict(df.dtypes)[c] == "boolean" else x.cast("double")
    return F.when(~F.isnan(x), x)


def long_form(df: DataFrame, features: list[str], carry: list[str]) -> DataFrame:
    """(carry..., feature, x): one row a feature and row; all features then share one plan."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), as_double(df, f).alias("x")) for f in features])
    return df.select(*[F.col(f"`{c}`") for c in carry], F.inline(cells))


def counted(rows: DataFrame, by: list[str], x: str = "x") -> DataFrame:
    """(by, x, n): the distinct values of each group and how often they occur; summed before the shuffle."""
    return rows.groupBy(*by, x).agg(F.count("*").alias("n"))


def prefix_sums(df: DataFrame, by: list[str], x: str, values: list[str], ranges: int = 64) -> DataFrame:
    """Adds ``<value>_below``: the sum of each value over the group's rows with smaller x (x distinct in a group).

    In two levels: approximate quantiles cut each group's values into ranges, so that no task holds a whole group.
    Groups are features or pairs of features, so the table of their cuts is bounded and broadcast.
    """
    steps = [i / ranges for i in range(1, ranges)]
    edges = df.groupBy(*by).agg(F.percentile_approx(x, steps, 10_000).alias("__edges"))
    cut = df.join(F.broadcast(edges), by).withColumn("__range", F.size(F.filter("__edges", lambda e: e <= F.col(x)))).drop("__edges")
    inside = Window.partitionBy(*by, "__range").orderBy(x).rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(*by, "__range").agg(*[F.sum(v).alias(f"__{v}") for v in values])
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    tops = sums.select(*by, "__range", *[F.coalesce(F.sum(f"__{v}").over(before), F.lit(0)).alias(f"__{v}_before") for v in values])
    out = cut
    for v in values:
        out = out.withColumn(f"{v}_below", F.coalesce(F.sum(v).over(inside), F.lit(0)))
    out = out.join(F.broadcast(tops), [*by, "__range"])  # a row a range and group
    for v in values:
        out = out.withColumn(f"{v}_below", F.col(f"{v}_below") + F.col(f"__{v}_before"))
    return out.drop("__range", *[f"__{v}_before" for v in values])


def average_ranks(counts: DataFrame, by: list[str], x: str = "x") -> DataFrame:
    """(by, x, r): the mean rank of each distinct value; ``counts`` as of ``counted``."""
    return prefix_sums(counts, by, x, ["n"]).select(*by, x, (F.col("n_below") + (F.col("n") + 1) / F.lit(2.0)).alias("r"))


def quantiles(counts: DataFrame, by: list[str], steps: list[float], x: str = "x") -> DataFrame:
    """(by, q): the exact quantiles, interpolated between neighbours, of each group; null values are left out.

    ``counts`` as of ``counted``.  Each step asks for the values at two places of the sorted group; the distinct
    value whose run of places holds one answers it, so no task gathers a group's values.
    """
    counts = counts.filter(F.col(x).isNotNull())
    sizes = counts.groupBy(*by).agg(F.sum("n").alias("__all"))
    run = prefix_sums(counts, by, x, ["n"]).join(F.broadcast(sizes), by)
    place = lambda q: F.lit(q) * (F.col("__all") - 1)
    asked = F.array(*[f(place(q)).cast("long") for q in steps for f in (F.floor, F.ceil)])
    held = F.array_distinct(F.filter(asked, lambda i: (i >= F.col("n_below")) & (i < F.col("n_below") + F.col("n"))))
    found = run.select(*by, x, "__all", F.explode(held).alias("__at")).groupBy(*by, "__all").agg(F.map_from_entries(F.collect_list(F.struct("__at", x))).alias("__m"))
    out = []
    for q in steps:
        lo, hi = (F.element_at("__m", f(place(q)).cast("long")) for f in (F.floor, F.ceil))
        out.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (place(q) - F.floor(place(q)))))
    return found.select(*by, F.array(*out).alias("q"))


def numbered(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """Adds the row's number, from 1, inside its group in the given order; by ranges, so that no task holds a group."""
    dealt = checkpoint(df.repartitionByRange(*by, *order).withColumn("__part", F.spark_partition_id()))
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("__part", *by).agg(F.count("*").alias("__n"))  # a row a partition and group
    starts = sizes.select("__part", *by, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__part", *by).orderBy(*order))
    same = [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in ("__part", *by)]
    out = dealt.withColumn(name, inside).alias("l").join(starts.alias("r"), same)
    return out.select(*[F.col(f"l.`{c}`") for c in df.columns], (F.col(f"l.`{name}`") + F.col("r.__start")).alias(name))
