"""The candidate run: synthesised and semantic features, merged into one pool, with the files that later stages read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from orebody.config import AutoFeatureConfig
from orebody.operators import synthesis, themes
from orebody.operators.entity import EntityGraph, sample_rows, semi_join
from orebody.sources import io


@dataclass(frozen=True)
class Candidates:
    matrix: DataFrame
    auto: synthesis.AutoFeatures | None
    semantic: themes.SemanticFeatures
    summary: dict


def sampled(graph: EntityGraph, target_entity: str, n: int, seed: int) -> EntityGraph:
    """The graph with ``n`` rows of the target entity, and of every table below those that belong to them."""
    frames = dict(graph.frames)
    frames[target_entity] = sample_rows(frames[target_entity], graph.configs[target_entity].index, n, seed)
    waiting = [target_entity]
    while waiting:
        parent = waiting.pop()
        for child, fk, key in graph.children(parent):
            frames[child] = semi_join(frames[child], fk, frames[parent], key)
            waiting.append(child)
    return EntityGraph(frames, graph.configs, graph.edges)


def run_auto(graph: EntityGraph, target_entity: str, config: AutoFeatureConfig = AutoFeatureConfig(), target: str | None = None, output: str | None = None) -> synthesis.AutoFeatures:
    """Synthesised features of the target entity; of ``config.sample_size`` of its rows, if that is set."""
    if config.sample_size:
        graph = sampled(graph, target_entity, config.sample_size, config.random_seed)
    made = synthesis.synthesise(graph, target_entity, config, target)
    if output:
        io.write_matrix(made.matrix, f"{output}/auto_feature_matrix.parquet")
        io.write_report(made.definitions, f"{output}/auto_feature_defs.csv")
    return made


def run_semantic(frames: dict[str, DataFrame], anchor: DataFrame, names: list[str] | None = None, key: str | None = None, output: str | None = None) -> themes.SemanticFeatures:
    made = themes.semantic_features(frames, anchor, names, key)
    if output:
        io.write_matrix(made.matrix, f"{output}/semantic_feature_matrix.parquet")
        io.write_report(made.registry, f"{output}/semantic_feature_registry.csv")
    return made


def run_candidates(
    graph: EntityGraph | None,
    frames: dict[str, DataFrame],
    target_entity: str,
    key: str,
    target: str | None = None,
    config: AutoFeatureConfig = AutoFeatureConfig(),
    names: list[str] | None = None,
    output: str | None = None,
) -> Candidates:
    """Both kinds of features and their merge in one call; without a graph, or without synthesis, semantic ones alone."""
    anchor = synthesis.anchor_frame(frames, target_entity)
    auto = run_auto(graph, target_entity, config, target, f"{output}/auto" if output else None) if graph is not None and synthesis.is_synthesis_available() else None
    semantic = run_semantic(frames, anchor.select(*[c for c in (key, target) if c]), names, key, f"{output}/semantic" if output else None)
    made = None
    if auto is not None:
        made = auto.matrix.select(key, *[c for c in auto.matrix.columns if c not in (key, target)])
    pool = synthesis.merge_pools(anchor, key, target, made, semantic.matrix)
    summary = pool.summary | ({"row_count": pool.matrix.count()} if output else {})
    if output:
        io.write_matrix(pool.matrix, f"{output}/candidate_pool.parquet")
        io.write_json(summary, f"{output}/candidate_pool_summary.json")
    return Candidates(pool.matrix, auto, semantic, summary)
