"""Odd inputs of every operator: nulls, empty and very long texts, repeated rows, empty tables, columns by internal names."""

import collections
import hashlib

import numpy as np

from orebody.llm import decontamination, mixing, packing, quality, secrets, simhash, substrings, suffixes, toxicity
from orebody.llm.common import KERNEL_BYTES
from orebody.llm.queries import tokenizer

CLASHES = "p int, r int, key int, node int, fp int, label int, size int, score int, held_out int, n_words int, tokens int, ids int, kept int, __src int, __row int, v int, cell int"


def table(spark, rows):
    names = [c.split()[0] for c in CLASHES.split(", ")]
    return spark.createDataFrame([(*r, *[3] * len(names)) for r in rows], f"doc_id long, text string, source string, {CLASHES}")


def test_columns_by_internal_names(spark, odd):
    rows = [(1, None, "a"), (2, "", None), (None, "some words of a text", "a"), (4, "x y " * 700, "b"), (4, "x y " * 700, "b"), (5, "ünï cødé token=abcdef123", None)]
    docs = table(spark, rows)
    bench = spark.createDataFrame([(1, "words of a text", 7, 7), (None, None, 7, 7), (None, "some words", 7, 7)], "item_id long, text string, p int, n_words int")
    path, pattern = tokenizer()
    assert simhash.groups(docs).count() == 6
    assert {r.n_removed for r in substrings.deduplicate(docs).filter("doc_id = 4").collect()} == {1400}
    assert {r.n_removed for r in suffixes.deduplicate(docs).filter("doc_id = 4").collect()} == {2800}
    assert mixing.mix(docs).count() == 6 and mixing.take_documents(docs).columns == docs.columns
    assert simhash.first_of_groups(docs).columns == docs.columns and simhash.first_of_groups(docs).count() == 4
    found = {r.doc_id: r for r in decontamination.find(docs, bench).collect()}
    assert (found[None].n_hit, found[None].n_items, found[1].n_words, found[2].contaminated) == (5, 2, 0, False)
    assert decontamination.clean(docs, bench).columns == docs.columns and decontamination.clean(docs, bench).count() == 5
    assert decontamination.find(docs.limit(0), bench).count() == decontamination.clean(docs.limit(0), bench).count() == 0
    scan = {r.doc_id: r for r in secrets.scan(docs, np.zeros((256, 256))).collect()}
    assert scan[5].n_assign == 1 and scan[1].spans == ""
    ids = collections.Counter(d for r in packing.pack(docs, path, pattern).collect() for d in [*r.doc_ids, *r.empty_doc_ids])
    assert ids[1] == ids[2] == ids[None] == ids[5] == 1 and ids[4] >= 2
    assert packing.pack(docs.limit(0), path, pattern).count() == 0
    assert quality.accepted(docs, quality.NOTHING).columns == docs.columns and quality.accepted(docs, quality.NOTHING).count() == 6
    for module in (toxicity, quality):
        assert module.score(docs, module.NOTHING).count() == 6 and module.score(docs.limit(0), module.NOTHING).count() == 0


def test_several_labels_of_a_document(spark):
    """A document is toxic, or good, if one of its labels says so; null labels say nothing."""
    docs = spark.createDataFrame([(i, ("vile " if i % 2 else "kind ") + " ".join("w%d" % (i * k % 97) for k in range(30))) for i in range(400)], "doc_id long, text string")
    rows = [(i, y, y) for i in range(400) for y in ((0, 1) if i % 2 else (0, 0))] + [(i, None, None) for i in range(400)] + [(None, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    for module in (toxicity, quality):
        got = module.score(docs, module.fit(docs, labels)).collect()
        assert np.mean([r.predicted == r.doc_id % 2 for r in got]) > 0.9  # as for the held-out accuracy; with the least label it is about a half


def test_texts_longer_than_a_kernel(spark):
    """Texts above what a kernel, a bucket and a packed group take at once: whole results."""
    long = " ".join("w%d" % (k * k) for k in range(250_000))
    assert len(long) > 2 * KERNEL_BYTES
    key = "AKIA" + "Q" * 30
    rows = [(1, long + " " + key, "a"), (2, long, "a"), (3, "short text", "b")]
    docs = table(spark, rows)
    words = {i: len(t.split()) for i, t, _ in rows}
    assert {r.doc_id: r.size for r in mixing.mix(docs).collect()} == words
    removed = {r.doc_id: (r.n_words, r.n_removed) for r in substrings.deduplicate(docs, bucket_bytes=1 << 20).collect()}
    assert removed == {1: (words[1], words[2]), 2: (words[2], words[2]), 3: (2, 0)}
    cut = {r.doc_id: r.n_removed for r in suffixes.deduplicate(docs, bucket_bytes=1 << 20).collect()}
    assert cut == {1: len(long), 2: len(long), 3: 0}
    bench = spark.createDataFrame([("x", " ".join(long.split()[-10:])), ("y", "short text")], "item_id string, text string")
    hit = {r.doc_id: r.items_sha256 for r in decontamination.find(docs, bench).collect()}
    want = {k: hashlib.sha256(v.encode()).hexdigest() for k, v in ((1, "x"), (2, "x"), (3, "y"))}
    assert hit == want
    found = {r.doc_id: (r.n_access, r.spans) for r in secrets.scan(docs, np.full((256, 256), -1.0)).collect()}
    assert found[1] == (1, f"access:{len(long) + 1}:{len(long) + 35}") and found[2] == (0, "")
    fps = {r.doc_id: r.component_id for r in simhash.groups(docs).collect()}
    assert fps == {1: 1, 2: 1, 3: 3}
    path, pattern = tokenizer()
    packed = packing.pack(docs, path, pattern, group_tokens=100_000).collect()
    lengths = collections.Counter()
    for r in packed:
        for k, d in enumerate(r.doc_ids):
            lengths[d] += r.cu_seqlens[k + 1] - r.cu_seqlens[k]
    assert lengths[1] > lengths[2] > 250_000 and lengths[3] == 2
    assert all(0 <= r.score <= 1 for r in quality.score(docs, quality.NOTHING).collect())
