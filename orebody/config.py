"""Configuration of entities, synthesis, selection and paths."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class EntityConfig:
    """A table of the entity tree: its file, key, parent and the foreign key to the parent's key."""

    name: str
    file_path: str
    index: str
    parent: str | None = None
    foreign_key: str | None = None
    columns: list[str] | None = None
    target: str | None = None


@dataclass(frozen=True)
class AutoFeatureConfig:
    agg_primitives: tuple[str, ...] = ("sum", "mean", "max", "min", "std", "count", "num_unique")
    trans_primitives: tuple[str, ...] = ("absolute",)
    max_depth: int = 2
    #: Rows of the target entity that a candidate run synthesises for; all, if not set.
    sample_size: int | None = None
    random_seed: int = 42


@dataclass(frozen=True)
class SelectionConfig:
    topk_ratio: float = 0.10
    missing_threshold: float = 0.95
    corr_threshold: float = 0.95
    min_auc: float = 0.55
    min_lift: float = 1.5
    min_iv: float = 0.02
    min_iv_medium: float = 0.1
    min_iv_strong: float = 0.3
    #: Opt-in: features above it are rejected when a stability summary is given.
    max_psi: float = 0.25


@dataclass(frozen=True)
class EnginePaths:
    data_dir: Path
    output_dir: Path
    candidate_dir: Path = field(default=None)  # type: ignore[assignment]
    selection_dir: Path = field(default=None)  # type: ignore[assignment]

    def __post_init__(self) -> None:
        for name, default in (("data_dir", None), ("output_dir", None), ("candidate_dir", "candidate_pool"), ("selection_dir", "selection")):
            value = getattr(self, name)
            object.__setattr__(self, name, Path(value) if value is not None else Path(self.output_dir) / default)

    @property
    def raw_dir(self) -> Path:
        return self.data_dir
