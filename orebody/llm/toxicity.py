"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words and word beginnings is trained in numpy from confirmed toxic
texts (P) and unlabelled texts (U) with the risk  pi * R+(P) + max(0, R-(U) - pi * R-(P)),  where pi is
the share of toxic texts and R+ / R- are logistic losses for calling a text toxic / clean.  When the bracket
falls below zero, the step goes against it (the non-negative correction), so that U's hidden toxic texts
are not fitted as clean.  Several classifiers are trained on different U samples' orders and averaged.

Scale: training takes at most ``most`` rows of each kind, whatever the corpus; scoring is one pass over
the documents without a shuffle, and the model (about 1 MB) is broadcast.

The prior pi is the share of toxic labels, unless it is given: it is right if labels are a random sample.  The
threshold is set so that ``SHARE`` of that prior of the unlabelled sample reaches it; where labels are not a
random sample, the rate of texts that are called toxic follows the labels' share and not the texts, and the
prior should be given.

Defined results: null and empty texts are scored like any text without words; documents with several
labels count as toxic if one says so; without a confirmed toxic text every score is 0; repeated rows are
scored alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.llm import features
from orebody.llm.common import held_out
from orebody.llm.features import WORD_BITS, row_sums

#: At most so many confirmed toxic and three times so many unlabelled texts are learnt from.
MOST_ROWS = 3000
PREFIXES = (4, 5)
THRESHOLD = 0.7
#: Share of the class prior that is called toxic among unlabelled texts: a little under all of it, to spare clean ones.
SHARE = 0.95


@dataclass(frozen=True)
class Linear:
    weights: np.ndarray
    bias: float

    def scores(self, bounds: np.ndarray, ids: np.ndarray) -> np.ndarray:
        if self.weights.size == 0:
            return np.zeros(len(bounds) - 1)
        return 1 / (1 + np.exp(-np.clip(row_sums(self.weights[ids], bounds) + self.bias, -30, 30)))


NOTHING = Linear(np.zeros(0), 0.0)


def flat(rows) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, ids) of rows of features."""
    lens = np.array([len(r[0]) for r in rows], np.int64)
    return np.concatenate([[0], np.cumsum(lens)]), np.concatenate([r[0] for r in rows]) if rows else np.zeros(0, np.int32)


def telling(positive, unlabelled, least: int = 5, z: float = 3.5) -> np.ndarray:
    """Marks the features whose share of P's texts differs from their share of U's beyond chance."""
    p, u = (np.bincount(np.concatenate([r[0] for r in rows]), minlength=1 << WORD_BITS) for rows in (positive, unlabelled))
    n_p, n_u = len(positive), len(unlabelled)
    both = (p + u) / (n_p + n_u)
    spread = np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n_p + 1 / n_u))
    return (p + u >= least) & (np.abs(p / n_p - u / n_u) > z * spread)


def risks(f_p: np.ndarray, f_u: np.ndarray, prior: float) -> tuple[float, float]:
    """(pi R+(P), R-(U) - pi R-(P)) of raw scores: the risk is the first plus the second, or plus 0 where that is negative."""
    return prior * np.logaddexp(0, -f_p).mean(), np.logaddexp(0, f_u).mean() - prior * np.logaddexp(0, f_p).mean()


def step_of(f_p: np.ndarray, f_u: np.ndarray, prior: float) -> np.ndarray:
    """Gradient by the scores of P, then of U: of the whole risk; where its second part is negative, of that part reversed."""
    s_p, s_u = 1 / (1 + np.exp(-f_p)), 1 / (1 + np.exp(-f_u))
    clean_p, clean_u = -prior * s_p / len(f_p), s_u / len(f_u)
    if risks(f_p, f_u, prior)[1] < 0:
        return np.concatenate([-clean_p, -clean_u])
    return np.concatenate([prior * (s_p - 1) / len(f_p) + clean_p, clean_u])


def train(positive, unlabelled, prior: float, rounds: int = 40, rate: float = 0.3, decay: float = 1e-4, seed: int = 0) -> Linear:
    """nnPU by Adagrad on mini-batches. ``positive``, ``unlabelled``: rows of features."""
    if not positive or not unlabelled:
        return NOTHING
    rng = np.random.default_rng(seed)
    keep = telling(positive, unlabelled)
    positive, unlabelled = ([(r[0][keep[r[0]]],) for r in rows] for rows in (positive, unlabelled))
    w, b = np.zeros(1 << WORD_BITS), np.log(prior / (1 - prior))
    gw, gb = np.full(1 << WORD_BITS, 1e-6), 1e-2
    n_batches = max(4, len(unlabelled) // 500)
    for _ in range(rounds):
        p_parts = np.array_split(rng.permutation(len(positive)), n_batches)
        u_parts = np.array_split(rng.permutation(len(unlabelled)), n_batches)
        for p_at, u_at in zip(p_parts, u_parts):
            if not len(p_at) or not len(u_at):
                continue
            bounds, ids = flat([*(positive[i] for i in p_at), *(unlabelled[i] for i in u_at)])
            f = np.clip(row_sums(w[ids], bounds) + b, -30, 30)
            g = step_of(f[: len(p_at)], f[len(p_at) :], prior)
            used, back = np.unique(ids, return_inverse=True)
            step = np.bincount(back, np.repeat(g, np.diff(bounds))) + decay * w[used]
            gw[used] += step**2
            w[used] -= rate * step / np.sqrt(gw[used])
            gb += g.sum() ** 2
            b -= rate * g.sum() / np.sqrt(gb)
    return Linear(w, float(b))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS, models: int = 3, prior: float | None = None) -> Linear:
    """Averaged nnPU classifiers from labels that are not held out, and unlabelled texts of rows that are not."""
    known = labels.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("__y"))
    toxic, total = known.agg(F.coalesce(F.sum("__y"), F.lit(0)), F.count("*")).first()
    if not toxic:
        return NOTHING
    prior = prior or min(max(toxic / total, 1e-4), 0.9)
    unlabelled = docs.filter(~held_out() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).alias("__y"))
    pos, _ = features.sampled_rows(docs, [known.filter("__y = 1")], most, PREFIXES, only_ids=True)
    some = features.drawn(unlabelled, docs.count(), 3 * most)
    unl, _ = features.sampled_rows(docs, [some], 3 * most, PREFIXES, only_ids=True)
    fitted = [train(pos, unl, prior, seed=k) for k in range(models)]
    if fitted[0].weights.size == 0:
        return NOTHING
    mean = Linear(np.mean([m.weights for m in fitted], axis=0), float(np.mean([m.bias for m in fitted])))
    return calibrated(mean, unl, prior)


def calibrated(model: Linear, unlabelled, prior: float, share: float = SHARE, threshold: float = THRESHOLD) -> Linear:
    """Shifts the bias so that a share of the prior, and no more, of the unlabelled texts reaches the threshold."""
    bounds, ids = flat(unlabelled)
    f = row_sums(model.weights[ids], bounds) + model.bias
    cut = float(np.quantile(f, 1 - share * prior))
    return Linear(model.weights, model.bias + float(np.log(threshold / (1 - threshold))) - cut)


def score(docs: DataFrame, model: Linear, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            parts = [shared.value.scores(bounds, ids) for bounds, ids, _, _ in features.rows_of(batch.column(2), PREFIXES)]
            s = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")
