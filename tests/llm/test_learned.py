"""Learned and approximate operators: held-out accuracy, recall, defined results of odd inputs, and the pipeline."""

import random

import numpy as np
import pytest

import corpus_pipeline
from orebody.llm import mixing, neighbours, quality, simhash, substrings, suffixes, toxicity

SMALL = "/root/testdata/sf0.01"


def corpus(spark, n=900):
    rnd = random.Random(5)
    vocab = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        toxic, good = int(rnd.random() < 0.2), int(rnd.random() < 0.7)
        words = [rnd.choice(vocab) for _ in range(60)]
        if toxic:
            words[10] = words[30] = rnd.choice(["nastyword", "vileword"])
        text = " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)
        docs.append((i, text))
        labels.append((i, good, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("module, column", [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_accuracy(spark, module, column):
    docs, labels = corpus(spark)
    rows = module.score(docs, module.fit(docs, labels)).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 200 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == r[column] for r in held]) > 0.9


@pytest.mark.parametrize("module", [toxicity, quality])
def test_no_labels(spark, odd, module):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = module.score(odd, module.fit(odd, none)).collect()
    assert len(rows) == 7 and {r.score for r in rows} == {0.0 if module is toxicity else 1.0}
    assert module.score(odd.limit(0), module.NOTHING).count() == 0


def test_risk_and_step():
    """The risk against its formula, and the step against differences of the risk, on both sides of the correction."""
    rng, prior, sides = np.random.default_rng(2), 0.2, set()
    for scale, shift in ((1, 0.0), (3, -4.0), (2, 2.0)):
        f_p, f_u = rng.normal(size=5) * scale + 3, rng.normal(size=9) * scale + shift
        loss = lambda z, y: float(np.log(1 + np.exp(-y * z)))

        def parts(f):
            p, u = f[:5], f[5:]
            toxic = prior * sum(loss(z, 1) for z in p) / 5
            return toxic, sum(loss(z, -1) for z in u) / 9 - prior * sum(loss(z, -1) for z in p) / 5

        f = np.concatenate([f_p, f_u])
        assert toxicity.risks(f_p, f_u, prior) == pytest.approx(parts(f))
        corrected = parts(f)[1] < 0
        sides.add(corrected)
        aim = (lambda f: -parts(f)[1]) if corrected else (lambda f: sum(parts(f)))
        eps = np.eye(14) * 1e-6
        want = [(aim(f + e) - aim(f - e)) / 2e-6 for e in eps]
        assert toxicity.step_of(f_p, f_u, prior) == pytest.approx(want, abs=1e-6)
    assert sides == {True, False}


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    m = quality.Machine(0.3, rng.normal(size=9).astype(np.float32), rng.normal(size=(9, 4)).astype(np.float32))
    slots, values = np.array([1, 4, 7, 8]), rng.normal(size=4).astype(np.float32)
    pairs = sum(m.factors[a] @ m.factors[b] * x * y for i, (a, x) in enumerate(zip(slots, values)) for b, y in list(zip(slots, values))[i + 1 :])
    assert m.raw(np.array([0, 4]), slots, values)[0][0] == pytest.approx(0.3 + m.linear[slots] @ values + pairs, rel=1e-4)


def recall(got, ids, x, k=20):
    """(share of the true k nearest found for every query of ``got``, mean share of rows scored exactly); exact scores are checked."""
    at = {int(v): i for i, v in enumerate(ids)}
    hits = n = 0
    for q, own in got.groupby("query_id"):
        own = own.sort_values("rank")
        s = x @ x[at[q]]
        assert own["rank"].tolist() == list(range(1, min(k, len(x) - 1) + 1)) and q not in set(own.vec_id) and own.vec_id.is_unique
        assert np.allclose(own.score, [s[at[v]] for v in own.vec_id]) and (np.diff(own.score) <= 0).all()
        s[at[q]] = -np.inf
        hits, n = hits + (own.score >= np.sort(s)[::-1][k - 1] - 1e-9).sum(), n + k
    return hits / n, got.groupby("query_id").n_scored.first().mean() / len(x)


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 16)).astype(np.float32)
    x[1000:2200] = x[1000]
    x[2200:3000] = x[2200] + rng.normal(size=(800, 16)).astype(np.float32) * np.float32(0.003)
    rows = [(i, [float(v) for v in r], "c") for i, r in enumerate(x)] + [(4000, None, "c"), (4020, [0.0] * 16, "c"), (4040, [float("nan")] * 16, "c"), (4060, [None] * 16, "c"), (None, [1.0] * 16, "c"), (4080, [1.0] * 9, "c")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell string")
    got = neighbours.search(table, part_rows=500).toPandas()
    assert set(got.query_id) == set(range(0, 4000, 20))
    found, exact = recall(got, np.arange(4000), x.astype(float))
    assert found >= 0.9 and exact < 0.2
    # ties go to smaller ids: the queries that lie in the large group of equal vectors
    own = got[got.query_id == 1200].sort_values("rank")
    assert own.vec_id.tolist() == list(range(1000, 1020)) and len(set(own.score)) == 1
    assert neighbours.search(table.limit(0)).count() == 0


def test_neighbours_of_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.toPandas().sort_values("vec_id")
    got = neighbours.search(table).toPandas()
    found, exact = recall(got, rows.vec_id.to_numpy(), np.stack(rows.embedding.to_numpy()).astype(float))
    assert got.query_id.nunique() == (rows.vec_id % 20 == 0).sum() and found >= 0.9 and exact < 0.2


def test_few_and_repeated_neighbours(spark):
    one = spark.createDataFrame([(0, [1.0, 0.0, 2.0]), (0, [0.5, 0.0, 1.0]), (20, [1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r)[:4] for r in neighbours.search(one).collect())
    # the repeated id 0 asks once, with its first vector in order, and is a candidate twice; the repeated row 7 twice
    assert got == [(0, 1, 7, 1.5), (0, 2, 7, 1.5), (0, 3, 20, 1.5), (20, 1, 0, 3.0), (20, 2, 7, 3.0), (20, 3, 7, 3.0), (20, 4, 0, 1.5)]
    single = spark.createDataFrame([(0, [2.0]), (40, [-1.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r)[:4] for r in neighbours.search(single).collect()) == [(0, 1, 40, -2.0), (40, 1, 0, -2.0)]


def test_odd_inputs(spark, odd):
    assert simhash.groups(odd).count() == 7
    assert simhash.groups(odd.limit(0)).count() == 0
    assert {r.n_removed for r in substrings.deduplicate(odd).filter("doc_id = 4").collect()} == {3000}
    assert substrings.deduplicate(odd).count() == suffixes.deduplicate(odd).count() == mixing.mix(odd).count() == 7
    assert substrings.deduplicate(odd.limit(0)).count() == suffixes.deduplicate(odd.limit(0)).count() == 0


ODD = [(1, None, "de", "a", 0), (2, "", None, "a", 0), (3, "  \n\t ", "de", None, 5), (None, "an own text without an id, long enough", "de", "b", 40), (4, "same text " * 60, "en", "b", 600), (4, "same text " * 60, "en", "b", 600),
       (5, "same text " * 60, None, "c", None), (6, "the leaked words of a benchmark item are ten in all", "en", "c", 50), (7, "one", "en", None, 3), (8, "ünï cødé " * 300_000, "en", "c", 2_700_000)]
CLASHES = "__doc string, size int, taken int, __id int, __h int, __hash int, node int, label int, key int, c0 int, c1 int, score int"


def odd_tables(spark, folder, rows):
    """Tables of a pipeline run in which documents have columns by the operators' own names."""
    names = [c.split()[0] for c in CLASHES.split(", ")]
    docs = spark.createDataFrame([(*r, *["x" if c == "__doc" else 7 for c in names]) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "the leaked words of a benchmark item are ten"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(None, 1, 1), (4, None, None), (90, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Without labels of both classes nothing is rejected; copies, leaks and empty texts go, each by its stage."""
    docs = odd_tables(spark, str(tmp_path), ODD)
    want = {"quality": 10, "near_copies": 6, "contamination": 5}
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        seen = stage(spark, seen, str(tmp_path)).cache()
        assert seen.columns == docs.columns
        if name in want:
            assert seen.count() == want[name], name
    ids = {r.doc_id for r in seen.select("doc_id").collect()}
    assert ids <= {None, 4, 7, 8} and 8 in ids  # texts without words are in no mix
    packed = corpus_pipeline.STAGES[4][1](spark, seen, str(tmp_path)).collect()
    assert {d for r in packed for d in r.doc_ids} == ids
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(packed)


def test_pipeline_of_empty_tables(spark, tmp_path):
    odd_tables(spark, str(tmp_path), [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns, name
        if name != "mix":
            assert 0.5 * n < docs.count() <= n
    assert corpus_pipeline.STAGES[4][1](spark, docs, SMALL).count() > 0


def planted(changed, seed, words=200):
    """Two texts of own words of which the second has words changed, and their exact similarity."""
    rnd = random.Random(seed)
    a = ["w%dx%d" % (seed, rnd.randrange(10**6)) for _ in range(words)]
    b = list(a)
    for k in rnd.sample(range(words), changed):
        b[k] = "other%dx%d" % (seed, k)
    x, y = ({tuple(t[i : i + 5]) for i in range(words - 4)} for t in (a, b))
    return " ".join(a), " ".join(b), len(x & y) / len(x | y)


def test_near_copies_are_exact(spark):
    pairs = [planted(seed % 8 + 1, seed) for seed in range(200)]
    assert sum(0.8 <= j < 0.85 for *_, j in pairs) >= 20 and sum(0.7 <= j < 0.8 for *_, j in pairs) >= 20
    rows = [(2 * k + side, pair[side]) for k, pair in enumerate(pairs) for side in (0, 1)]
    kept = {r.doc_id for r in simhash.first_of_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {2 * k for k in range(len(pairs))} | {2 * k + 1 for k, (*_, j) in enumerate(pairs) if j < 0.8}


def test_near_copies_count_a_shingle_once(spark):
    line = "one line that is repeated very often " * 200
    a, b, _ = planted(200, 1, words=300)
    rows = [(1, line + a), (2, line + b), (3, " ".join("z%d" % k for k in range(300)) + " " + line), (4, " ".join("z%d" % k for k in range(300)) + " " + line * 3)]
    assert {r.doc_id for r in simhash.first_of_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {1, 2, 3}


def jaccard_groups(rows, k=5, least=0.8):
    """Least id of each row's component, by all pairs of exact sets of shingles."""
    sets = [frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if (w := t.lower().split()) else frozenset() for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= least * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {rows[find(a)][0] for a in range(len(rows))}


@pytest.mark.parametrize("chunk, hot", [(1024, 16384), (16, 16384), (16, 40)])
def test_large_families_of_near_copies(spark, monkeypatch, chunk, hot):
    """Families far larger than a chunk, whole, in chunks and dealt by ranges: the same document of each stays."""
    monkeypatch.setattr(simhash, "STAGE_CHUNK", chunk)
    monkeypatch.setattr(simhash, "STAGE_HOT", hot)
    rnd = random.Random(11)
    rows = []
    for family in range(3):
        base = ["f%dw%d" % (family, rnd.randrange(10**6)) for _ in range(150)]
        for i in range(260):
            words = list(base)
            for k in rnd.sample(range(150), rnd.randrange(1, 5)):
                words[k] = "c%d" % rnd.randrange(10**6)
            rows.append((family + 3 * i, " ".join(words)))
    rows += [(10_000 + i, " ".join("s%d" % rnd.randrange(10**6) for _ in range(40))) for i in range(60)]
    rows.sort()
    kept = {r.doc_id for r in simhash.first_of_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == jaccard_groups(rows)


def test_near_copies_of_the_table(spark):
    """The small table's texts by all pairs of exact sets."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    assert {r.doc_id for r in simhash.first_of_groups(docs).collect()} == jaccard_groups(rows)
