"""Quality by a factorisation machine over hashed words, structure statistics and length metadata.

y(x) = b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j, where the pairwise term is computed in linear
time as half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2 over the factors.  Words have the value
1 / sqrt(distinct words) so that long texts do not drown the structure slots, whose value is 1.

Scale: training takes at most ``most`` labelled rows of each class, whatever the corpus; scoring is one
pass over the documents without a shuffle, and the model (about 10 MB) is broadcast.

Defined results: null and empty texts have the structure slots of an empty text and no words; documents
with several labels count as good if one says so; without both classes in the labels every score is 1, so
that nothing is rejected unlearnt; repeated rows are scored alike; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.llm import features
from orebody.llm.common import held_out
from orebody.llm.features import N_SLOTS, N_STATS, row_sums, stat_slots

#: At most so many labelled texts of each class are learnt from.
MOST_ROWS = 4000
FACTORS = 8
THRESHOLD = 0.5


@dataclass(frozen=True)
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, bounds: np.ndarray, slots: np.ndarray, values: np.ndarray):
        """(output, factor sums) of rows given as flat slots and values."""
        x = values[:, None]
        v = self.factors[slots] * x
        total = row_sums(v, bounds)
        pairs = 0.5 * (total**2 - row_sums(v * v, bounds)).sum(axis=1)
        return self.bias + row_sums(self.linear[slots] * values, bounds) + pairs, total

    def scores(self, bounds, slots, values) -> np.ndarray:
        if not self.linear.size:
            return np.ones(len(bounds) - 1)
        return 1 / (1 + np.exp(-np.clip(self.raw(bounds, slots, values)[0], -30, 30)))


NOTHING = Machine(0.0, np.zeros(0, np.float32), np.zeros((0, FACTORS), np.float32))


def slots_of(bounds, ids, stats):
    """Words and structure slots of each row as one flat sparse row."""
    n = len(bounds) - 1
    words = np.diff(bounds)
    out_bounds = bounds + np.arange(n + 1) * N_STATS
    slots = np.empty(out_bounds[-1], np.int32)
    values = np.ones(out_bounds[-1], np.float32)
    at = np.arange(len(ids)) + np.repeat(np.arange(n) * N_STATS, words)
    slots[at] = ids
    values[at] = np.repeat(1 / np.sqrt(np.maximum(words, 1)), words)
    ends = out_bounds[1:, None] - N_STATS + np.arange(N_STATS)
    slots[ends] = stat_slots(stats)
    return out_bounds, slots, values


def train(rows, labels: np.ndarray, rounds: int = 12, rate: float = 0.05, decay: float = 1e-5, seed: int = 0) -> Machine:
    """Adagrad on the logistic loss, classes weighted alike. ``rows``: (ids, statistics)."""
    if len(set(labels.tolist())) < 2:
        return NOTHING
    rng = np.random.default_rng(seed)
    machine = Machine(0.0, np.zeros(N_SLOTS, np.float32), rng.normal(0, 0.01, (N_SLOTS, FACTORS)).astype(np.float32))
    bias, gb = 0.0, 1e-6
    gl, gf = np.full(N_SLOTS, 1e-6, np.float32), np.full((N_SLOTS, FACTORS), 1e-6, np.float32)
    weight = np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean())
    n_batches = max(1, min(16, len(rows) // 16), len(rows) // 256)  # of few rows, small ones
    for _ in range(rounds):
        for part in np.array_split(rng.permutation(len(rows)), n_batches):
            lens = np.array([len(rows[i][0]) for i in part])
            bounds = np.concatenate([[0], np.cumsum(lens)])
            ids = np.concatenate([rows[i][0] for i in part])
            bounds, slots, values = slots_of(bounds, ids, np.stack([rows[i][1] for i in part]))
            out, total = Machine(bias, machine.linear, machine.factors).raw(bounds, slots, values)
            g = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - labels[part]) * weight[part] / len(part)
            row = np.repeat(np.arange(len(part)), np.diff(bounds))
            gx = (g[row] * values).astype(np.float32)
            dv = gx[:, None] * (total[row] - machine.factors[slots] * values[:, None])
            used, back = np.unique(slots, return_inverse=True)
            dl = np.bincount(back, gx) + decay * machine.linear[used]
            df = np.stack([np.bincount(back, dv[:, k]) for k in range(FACTORS)], axis=1) + decay * machine.factors[used]
            gl[used] += dl**2
            gf[used] += df**2
            machine.linear[used] -= rate * dl / np.sqrt(gl[used])
            machine.factors[used] -= rate * 0.2 * df / np.sqrt(gf[used])
            gb += g.sum() ** 2
            bias -= rate * g.sum() / np.sqrt(gb)
    return Machine(float(bias), machine.linear, machine.factors)


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> Machine:
    rows, y = features.training_rows(docs, labels, "quality", most, (0, 1))
    return train(rows, y)


def scorer(model: Machine):
    def scores(texts) -> np.ndarray:
        parts = [model.scores(*slots_of(bounds, ids, stats)) for bounds, ids, _, stats in features.rows_of(texts)]
        return np.concatenate(parts) if parts else np.zeros(0)

    return scores


def score(docs: DataFrame, model: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            s = scorer(shared.value)(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s.astype(float)), pa.array((s >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that the model does not reject."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(scorer(shared.value)(batch.column(at)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
