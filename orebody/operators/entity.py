"""The entity tree: loading, sampling by semi-joins from the root down, relationships."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orebody.config import EntityConfig
from orebody.sources import io


@dataclass(frozen=True)
class EntityGraph:
    """Frames by name with their configurations; ``edges`` are (parent, key, child, foreign key)."""

    frames: dict[str, DataFrame]
    configs: dict[str, EntityConfig]
    edges: list[tuple[str, str, str, str]] = field(default_factory=list)

    def get_frame(self, name: str) -> DataFrame:
        return self.frames[name]

    def children(self, name: str) -> list[tuple[str, str, str]]:
        """(child, foreign key, the parent's key) of every edge down."""
        return [(c, fk, key) for p, key, c, fk in self.edges if p == name]

    def verify(self) -> dict:
        return {
            "entities": list(self.frames),
            "relationships": [f"{p}.{key} <- {c}.{fk}" for p, key, c, fk in self.edges],
            "row_counts": {n: df.count() for n, df in self.frames.items()},
        }


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (all, if fewer), chosen by a hash of the key, so that reruns agree."""
    return df.orderBy(F.xxhash64(F.col(f"`{key}`"), F.lit(seed)), F.col(f"`{key}`")).limit(n)


def semi_join(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Children of the parent's rows; none, if the parent has none."""
    return child.join(parent.select(F.col(f"`{key}`").alias("__key")), F.col(f"`{foreign_key}`") == F.col("__key"), "left_semi")


class EntityGraphBuilder:
    """Fluent builder. Tables come from files under ``data_dir`` or from given frames."""

    def __init__(self, spark: SparkSession, data_dir: str = ".", sample_size: int | None = None, frames: dict[str, DataFrame] | None = None, seed: int = 42):
        self.spark, self.data_dir, self.sample_size, self.given, self.seed = spark, data_dir, sample_size, frames or {}, seed
        self.configs: list[EntityConfig] = []

    def add_entity(self, config: EntityConfig) -> EntityGraphBuilder:
        self.configs.append(config)
        return self

    def add_entities(self, configs: list[EntityConfig]) -> EntityGraphBuilder:
        self.configs.extend(configs)
        return self

    def _load(self, config: EntityConfig) -> DataFrame:
        if config.name in self.given:
            df = io.clean(self.given[config.name])
            return df.select(*[c for c in config.columns if c in df.columns]) if config.columns else df
        return io.read(self.spark, f"{self.data_dir}/{config.file_path}", config.columns)

    @staticmethod
    def _keyed(df: DataFrame, key: str) -> DataFrame:
        """A missing key column is numbered 0, 1, ... without gaps, in two levels of prefix sums."""
        if key in df.columns:
            return df
        numbered = df.withColumn("__at", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__at", 33))
        sizes = numbered.groupBy("__part").count()
        before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
        out = numbered.join(F.broadcast(starts), "__part")  # a row a partition
        return out.withColumn(key, F.col("__start") + (F.col("__at") - F.shiftleft("__part", 33))).drop("__at", "__part", "__start")

    def build(self) -> EntityGraph:
        root = next((c for c in self.configs if c.parent is None), None)
        if root is None:
            raise ValueError("no root entity: one configuration must have no parent")
        first = self._keyed(self._load(root), root.index)
        graph = EntityGraph({root.name: sample_rows(first, root.index, self.sample_size, self.seed) if self.sample_size else first}, {root.name: root})
        waiting = [c for c in self.configs if c is not root]
        while waiting:
            ready = [c for c in waiting if c.parent is None or c.parent in graph.frames]
            if not ready:
                raise ValueError(f"unresolved parents of: {', '.join(c.name for c in waiting)}")
            for c in ready:
                df = self._load(c)
                if c.parent and c.foreign_key:
                    key = graph.configs[c.parent].index
                    df = semi_join(df, c.foreign_key, graph.frames[c.parent], key)
                    graph.edges.append((c.parent, key, c.name, c.foreign_key))
                graph.frames[c.name], graph.configs[c.name] = self._keyed(df, c.index), c
            waiting = [c for c in waiting if c not in ready]
        return graph


def build_graph(spark: SparkSession, configs: list[EntityConfig], data_dir: str = ".", sample_size: int | None = None, frames: dict[str, DataFrame] | None = None) -> EntityGraph:
    return EntityGraphBuilder(spark, data_dir, sample_size, frames).add_entities(configs).build()
