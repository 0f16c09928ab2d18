"""Relational feature synthesis to a bounded depth, the leakage guard, and the merge of candidate pools.

At each parent every child edge gives COUNT(child); SUM, MEAN, MAX, MIN and STD of the child's numeric
non-key columns and of its own synthesised columns; NUM_UNIQUE of its strings.  COUNT and SUM of no
children are 0, the others null.  Children are aggregated by their foreign key before the join.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.config import AutoFeatureConfig
from orebody.functions.expr import as_double, numeric_columns
from orebody.operators.entity import EntityGraph

#: Aggregates in one groupBy; wider sets are cut, so that generated code stays compilable.
CHUNK = 100


@dataclass(frozen=True)
class AutoFeatures:
    matrix: DataFrame
    names: list[str]
    definitions: DataFrame


def physical(name: str) -> str:
    """Column name of a definition such as MEAN(orders.o_totalprice)."""
    return re.sub(r"\W+", "_", name).strip("_").lower()


def _aggregate(df: DataFrame, child: str, fk: str, keys: set[str], primitives: tuple[str, ...], made: dict[str, str]):
    """(column, definition, zero if empty) of each aggregate of a child."""
    out = []
    if "count" in primitives:
        out.append((F.count("*"), f"COUNT({child})", True))
    numeric = [c for c in numeric_columns(df) if c not in keys]
    functions = {"sum": (F.sum, True), "mean": (F.avg, False), "max": (F.max, False), "min": (F.min, False), "std": (F.stddev_samp, False)}
    for c in numeric:
        for p in primitives:
            if p in functions:
                out.append((functions[p][0](as_double(df, c)), f"{p.upper()}({child}.{made.get(c, c)})", functions[p][1]))
    if "num_unique" in primitives:
        out += [(F.count_distinct(F.col(f"`{c}`")), f"NUM_UNIQUE({child}.{c})", False) for c, t in df.dtypes if t == "string" and c not in keys and c not in made]
    return out


def synthesise(graph: EntityGraph, target_entity: str, config: AutoFeatureConfig = AutoFeatureConfig(), target_col: str | None = None) -> AutoFeatures:
    """The target entity with its synthesised columns; those whose name holds ``target_col`` are dropped."""

    def grow(name: str, depth: int) -> tuple[DataFrame, dict[str, str]]:
        df, made = graph.frames[name], {}
        key = graph.configs[name].index
        if depth == 0:
            return df, made
        for child, fk, _ in graph.children(name):
            rows, below = grow(child, depth - 1)
            keys = {graph.configs[child].index, fk, *[f for _, f, _ in graph.children(child)]}
            aggs = _aggregate(rows, child, fk, keys, config.agg_primitives, below)
            for i in range(0, len(aggs), CHUNK):
                part = aggs[i : i + CHUNK]
                grouped = rows.groupBy(F.col(f"`{fk}`").alias("__fk")).agg(*[a.alias(physical(d)) for a, d, _ in part])
                df = df.join(grouped, F.col(f"`{key}`") == F.col("__fk"), "left").drop("__fk")
                zeros = {physical(d): F.coalesce(F.col(physical(d)), F.lit(0)) for _, d, z in part if z}
                df = df.withColumns(zeros) if zeros else df
                made |= {physical(d): d for _, d, _ in part}
        return df, made

    matrix, made = grow(target_entity, config.max_depth)
    own = graph.frames[target_entity]
    key = graph.configs[target_entity].index
    if "absolute" in config.trans_primitives:
        absolute = {f"ABSOLUTE({c})": F.abs(as_double(own, c)) for c in numeric_columns(own, (key, target_col or ""))}
        matrix = matrix.withColumns({physical(d): x for d, x in absolute.items()})
        made |= {physical(d): d for d in absolute}
    leaks = leaking(list(made) + [c for c in own.columns if c != key], target_col)
    matrix = matrix.drop(*leaks)
    names = [c for c in made if c not in leaks]
    spark = matrix.sparkSession
    definitions = spark.createDataFrame([(c, made[c]) for c in names], "feature_name string, definition string")
    return AutoFeatures(matrix, names, definitions)


def leaking(names: list[str], target_col: str | None) -> list[str]:
    """Names that hold the target's name, but for the target itself."""
    return [c for c in names if target_col and c != target_col and (target_col in c or physical(target_col) in c)]


def is_synthesis_available() -> bool:
    return True


@dataclass(frozen=True)
class Pool:
    matrix: DataFrame
    summary: dict


def merge_pools(anchor: DataFrame, key: str, target: str | None, auto: DataFrame | None, semantic: DataFrame | None) -> Pool:
    """Anchor key and target, then both pools' columns by left joins on the key; a name in both gets _auto and _semantic."""
    base = anchor.select(*[c for c in (key, target) if c])
    held = set(base.columns)
    cols = {n: [c for c in df.columns if c not in held] if df is not None else [] for n, df in (("auto", auto), ("semantic", semantic))}
    both = set(cols["auto"]) & set(cols["semantic"])
    out = base
    for n, df in (("auto", auto), ("semantic", semantic)):
        if cols[n]:
            named = [F.col(f"`{c}`").alias(f"{c}_{n}" if c in both else c) for c in cols[n]]
            out = out.join(df.select(F.col(f"`{key}`").alias("__key"), *named), F.col(f"`{key}`") == F.col("__key"), "left").drop("__key")
    summary = {"total_feature_count": len(cols["auto"]) + len(cols["semantic"]), "auto_feature_count": len(cols["auto"]), "semantic_feature_count": len(cols["semantic"])}
    return Pool(out, summary)


def anchor_frame(frames: dict[str, DataFrame], target_entity: str | None = None) -> DataFrame:
    if not frames:
        raise ValueError("no frames")
    return frames[target_entity] if target_entity in frames else next(iter(frames.values()))
