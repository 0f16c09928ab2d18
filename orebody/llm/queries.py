"""The registered queries opN_<name>: thin calls of the operators with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebody.llm import decontamination, mixing, neighbours, packing, quality, secrets, simhash, substrings, suffixes, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> tuple[str, str]:
    """(path of the vocabulary, pattern) of the public byte-level tokenizer that the packing query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(secrets.labelled_samples(docs)))


def op3_simhash(spark, sf_dir):
    return simhash.groups(table(spark, sf_dir, "documents"))


def op4_recompression(spark, sf_dir):
    found = substrings.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op6_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer())


def op7_decontamination(spark, sf_dir):
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("item_ids")


def op8_suffixes(spark, sf_dir):
    found = suffixes.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_neighbours(spark, sf_dir):
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op10_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_toxicity, op2_secrets, op3_simhash, op4_recompression, op5_quality, op6_packing, op7_decontamination, op8_suffixes, op9_neighbours, op10_mixing)
}

ORACLE_SQL = {
    "op4_recompression": r"""
        WITH docs AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (SELECT k, s, array_to_string(w[s:s + 34], ' ') AS t FROM docs, unnest(range(1, len(w) - 33)) AS u(s)),
        hot AS (SELECT k, s FROM (SELECT k, s, count(*) OVER (PARTITION BY t) AS n FROM win) WHERE n > 1),
        gone AS (SELECT k, list(DISTINCT i) AS g FROM hot, unnest(range(s, s + 35)) AS u(i) GROUP BY k),
        kept AS (SELECT doc_id, w, coalesce(g, []) AS g FROM docs LEFT JOIN gone USING (k))
        SELECT doc_id, len(w)::BIGINT AS n_words, len(g)::BIGINT AS n_removed,
               sha256(array_to_string(CASE WHEN len(g) = 0 THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(g, i)) END, ' ')) AS kept_sha256
        FROM kept""",
    "op7_decontamination": r"""
        WITH low AS (SELECT row_number() OVER () AS k, doc_id,
                            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        pat AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS t
                FROM item, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS u(s) WHERE len(w) > 0),
        size AS (SELECT DISTINCT m FROM pat),
        win AS (SELECT k, s, m, array_to_string(w[s:s + m - 1], ' ') AS t FROM low, size, unnest(range(1, len(w) - m + 2)) AS u(s)),
        hit AS (SELECT win.k, win.s, win.m, pat.item_id FROM win JOIN pat ON win.m = pat.m AND win.t = pat.t),
        words AS (SELECT k, count(DISTINCT i) AS n_hit FROM hit, unnest(range(s, s + m)) AS u(i) GROUP BY k),
        items AS (SELECT k, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT k, item_id::VARCHAR AS id FROM hit) GROUP BY k)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM low LEFT JOIN words USING (k) LEFT JOIN items USING (k)""",
    "op10_mixing": r"""
        WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                              md5(coalesce(doc_id::VARCHAR, '')) AS o FROM documents),
        src AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM sized GROUP BY source),
        w AS (SELECT *, ([5, 2, 1])[(sid - 1) % 3 + 1]::BIGINT AS weight FROM src),
        r AS (SELECT *, (source_size * 3)::DOUBLE / weight::DOUBLE AS ratio FROM w),
        l AS (SELECT *, (sum(source_size) OVER () - (sum(source_size * 3) OVER o - source_size * 3))::DOUBLE
                        / (sum(weight) OVER (ORDER BY ratio, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
              FROM r WINDOW o AS (ORDER BY ratio, sid ROWS UNBOUNDED PRECEDING)),
        t AS (SELECT *, CASE WHEN ratio <= level THEN (source_size * 3)::DOUBLE
                        ELSE weight::DOUBLE * (SELECT arg_min(level, (ratio, sid)) FROM l WHERE ratio > level) END AS target FROM l),
        p AS (SELECT *, round(target)::BIGINT AS take FROM t),
        d AS (SELECT doc_id, size, source_size, target, take,
                     (sum(size) OVER (PARTITION BY sid ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS s
              FROM sized JOIN p ON sized.source IS NOT DISTINCT FROM p.source)
        SELECT doc_id, size, source_size, target,
               CASE WHEN source_size = 0 THEN 0
                    ELSE size * (take // source_size) + greatest(least(s + size, take % source_size) - s, 0) END::BIGINT AS taken
        FROM d""",
}
