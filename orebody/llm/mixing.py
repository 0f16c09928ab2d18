"""Mixing sources to target weights with a low-discrepancy source schedule (DataFrame functions only).

Every source's documents are shuffled by the MD5 of their ids and laid end to end; the stream is cut
into blocks of ``block_words`` words.  Slot i of the mix takes the golden-ratio point frac(i * phi) and
maps it through the cumulative shares of the sources, so that every stretch of the schedule holds every
source in proportion.  The slots of a source are ranked, and rank k takes block k mod n in pass k div n.
A source leaves the schedule when its target is met (its last block is cut to fit); ranks that the
points leave undealt, a few a source, are dealt at the end.

Scale: a document becomes one narrow row, which is written once and read from there.  Positions are prefix
sums in two levels (about sqrt(rows) hash ranges a source, then rows inside a range), so no task sees a whole
source, however hot; slots are ranked the same way by chunks, sources numbered the same way by ranges of names.
The level of the targets is found by rounds of one small aggregate each.

Defined results: null text has size 0; null source is a source of its own, ordered last; a document of
size 0 is kept with taken 0; rows with the same id and size are interchangeable; an empty table gives no
rows; other columns of the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebody.llm.common import checkpoint

#: Fixed values of the default mix: weights by rank of the source, repeating; most repeats of a source.
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 256
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Slots that are ranked together.
CHUNK = 4096
#: Cells of the table that maps points to sources, for few sources and for very many.
GRID, LARGEST_GRID = 1 << 10, 1 << 20
#: Sources that one task puts in order.
SOURCES_A_TASK = 100_000
#: The golden ratio less one, and the fraction of 2**20 times it (keeps i * phi exact to 1e-9 for 1e12 slots).
PHI = 0.6180339887498949
PHI_20 = (PHI * (1 << 20)) % 1.0

_KEY = ["__src", "__nul"]
_KEY_ORDER = ["__nul", "__src"]


def sized(docs: DataFrame, n_ranges: int) -> DataFrame:
    """One narrow row a document: id, source key, size, place in the shuffle; dealt by source and hash range."""
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    u32 = F.conv(F.substring(order, 1, 8), 16, 10).cast("long")
    return docs.select(
        F.col("doc_id"),
        F.coalesce(F.col("source"), F.lit("")).alias("__src"),
        F.col("source").isNull().alias("__nul"),
        F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
        order.alias("__order"),
        F.shiftright(u32 * F.lit(n_ranges), 32).alias("__range"),
    )


def running(sources: DataFrame, value, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all sources up to each, in the order of name: inside parts, and over parts."""
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    parts = sources.groupBy("__part").agg(F.sum(value).alias("__sum")).select("__part", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__part").orderBy(*_KEY_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    return sources.withColumn(name, F.sum(value).over(inside)).join(parts, "__part").withColumn(name, F.col(name) + F.col("__before")).drop("__before")


def numbered(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """(key, source_size) -> with part, rank by code point (null last) and weight."""
    sources = checkpoint(sources)
    dealt = sources.repartitionByRange(1 + sources.count() // SOURCES_A_TASK, *_KEY_ORDER)
    ranked = running(checkpoint(dealt.withColumn("__part", F.spark_partition_id())), F.lit(1), "__sid")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("__sid") - 1) % len(weights) + 1).cast("int"))
    return ranked.withColumn("__weight", weight.cast("long"))


def targets(sources: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Adds the target of numbered sources: shares by weight, capped, the excess reshared until none is above."""
    cap = F.col("source_size") * max_repeats
    ratio = cap.cast("double") / F.col("__weight").cast("double")
    size, weight = F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("__weight"), F.lit(0))
    level, before = -1.0, -1
    while True:  # a round fills the sources that the level covers; the level rises until it covers no more
        full = ratio <= level
        total, full_cap, open_weight, n_full = sources.agg(
            size, F.coalesce(F.sum(F.when(full, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("__weight"))), F.lit(0)), F.count(F.when(full, 1))
        ).first()
        if n_full == before or not open_weight:
            break
        level, before = float(total - full_cap) / float(open_weight), n_full
    return sources.withColumn("target", F.when(ratio <= level, cap.cast("double")).otherwise(F.col("__weight").cast("double") * F.lit(level)))


def plan(with_targets: DataFrame, block_words: int) -> tuple[DataFrame, int]:
    """Adds words to take, whole passes, rest, blocks, ranks and the interval of the unit line of each source; and all ranks."""
    take = F.round("target").cast("long")
    size = F.col("source_size")
    ranked = (
        with_targets.withColumn("__take", take)
        .withColumn("__whole", F.when(size > 0, F.expr("__take div source_size")).otherwise(F.lit(0)).cast("long"))
        .withColumn("__rest", F.col("__take") - F.col("__whole") * size)
        .withColumn("__blocks", F.expr(f"(source_size + {block_words - 1}) div {block_words}"))
        .withColumn("__ranks", F.col("__whole") * F.col("__blocks") + F.expr(f"(__rest + {block_words - 1}) div {block_words}"))
    )
    ranked = checkpoint(ranked)
    n_slots = int(ranked.agg(F.coalesce(F.sum("__ranks"), F.lit(0))).first()[0])
    line = running(ranked, F.col("__ranks"), "__hi")
    share = lambda c: c.cast("double") / F.lit(float(max(n_slots, 1)))
    return checkpoint(line.withColumn("__lo", share(F.col("__hi") - F.col("__ranks"))).withColumn("__hi", share(F.col("__hi")))), n_slots


def schedule(sources: DataFrame, n_slots: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix: one row a slot with its source, block, pass and words [lo, hi) of the source's stream.

    ``sources`` is a plan(); ``n_slots`` the sum of its ranks.  Slots dealt to a source that has met its
    target are skipped; ranks that the points left undealt follow at the end, so targets are met exactly.
    """
    spark = sources.sparkSession
    grid = min(LARGEST_GRID, max(GRID, 1 << (4 * sources.count()).bit_length()))
    point = F.expr(f"(id div 1048576) * {PHI_20}D + (id % 1048576) * {PHI}D + 0.5D")
    slots = spark.range(n_slots).select(
        F.col("id").alias("slot"), (point - F.floor(point)).alias("__x"), F.expr(f"id div {CHUNK}").alias("__chunk")
    )
    cells = sources.filter("__ranks > 0").select(
        "__sid", "__lo", "__hi", F.explode(F.sequence(F.floor(F.col("__lo") * grid), F.least(F.floor(F.col("__hi") * grid), F.lit(grid - 1)))).alias("__cell")
    )
    dealt = (
        slots.withColumn("__cell", F.least(F.floor(F.col("__x") * grid), F.lit(grid - 1)))
        .join(cells, "__cell")
        .filter("__x >= __lo AND __x < __hi")
        .select("slot", "__chunk", "__sid")
    )
    counts = dealt.groupBy("__chunk", "__sid").agg(F.count("*").alias("__n"))
    before = counts.withColumn(
        "__before", F.coalesce(F.sum("__n").over(Window.partitionBy("__sid").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    ranked = dealt.withColumn("__k", F.row_number().over(Window.partitionBy("__chunk", "__sid").orderBy("slot")) - 1).join(
        before, ["__chunk", "__sid"]
    ).select("slot", "__sid", (F.col("__k") + F.col("__before")).alias("rank"))
    had = counts.groupBy("__sid").agg(F.sum("__n").alias("__had"))
    late = (
        sources.join(had, "__sid", "left")
        .withColumn("__had", F.coalesce("__had", F.lit(0)))
        .filter("__had < __ranks")
        .select("__sid", F.explode(F.sequence("__had", F.col("__ranks") - 1)).alias("rank"))
        .select(F.lit(n_slots).cast("long").alias("slot"), "__sid", F.col("rank").cast("long"))
    )
    pieces = sources.select("__sid", "source_size", "__whole", "__rest", "__blocks", "__ranks")
    return (
        ranked.unionByName(late)
        .join(pieces, "__sid")
        .filter("rank < __ranks")
        .withColumn("block", F.expr("rank % __blocks"))
        .withColumn("pass", F.expr("rank div __blocks"))
        .withColumn("lo", F.col("block") * block_words)
        .withColumn("__end", F.least(F.col("lo") + block_words, F.col("source_size")))
        .withColumn("hi", F.when(F.col("pass") < F.col("__whole"), F.col("__end")).otherwise(F.least("__end", "__rest")))
        .select("slot", "__sid", "block", "pass", "lo", "hi", "__end")
    )


def mix(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, size, source_size, target and taken (words that the mix takes, repeats counted) of every row.

    ``docs`` needs doc_id, text and source.  A few small driver actions size the hash ranges, the targets and the
    schedule; each returns one row of numbers.
    """
    n_ranges = max(1, math.isqrt(docs.count()))
    rows = checkpoint(sized(docs, n_ranges))  # the only reading of the texts
    key = [*_KEY, "__range"]
    ranges = rows.groupBy(*key).agg(F.sum("size").alias("__sum"))
    by_source = Window.partitionBy(*_KEY)
    starts = ranges.withColumn("__start", F.sum("__sum").over(by_source.orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__sum"))
    sources, n_slots = plan(targets(numbered(rows.groupBy(*_KEY).agg(F.sum("size").alias("source_size")), weights), max_repeats), block_words)
    dealt = schedule(sources, n_slots, block_words)
    blocks = checkpoint(
        dealt.groupBy("__sid", "block").agg(
            F.sum(F.when(F.col("hi") == F.col("__end"), 1).otherwise(0)).alias("__passes"),
            F.max(F.when(F.col("hi") < F.col("__end"), F.col("hi"))).alias("__cut"),
        )
    )
    info = starts.join(sources.select(*_KEY, "__sid", "source_size", "target"), _KEY).drop("__sum")
    here = Window.partitionBy(*key).orderBy("__order", "doc_id", "size")
    placed = (
        rows.withColumn("__row", F.row_number().over(here))
        .withColumn("__to", F.sum("size").over(here.rowsBetween(Window.unboundedPreceding, 0)))
        .join(info, key)
        .withColumn("__s", F.col("__start") + F.col("__to") - F.col("size"))
        .withColumn("__e", F.col("__start") + F.col("__to"))
        .withColumn("block", F.explode(F.sequence(F.expr(f"__s div {block_words}"), F.expr(f"greatest(__e - 1, __s) div {block_words}"))))
    )
    lo, hi = F.greatest("__s", F.col("block") * block_words), F.least("__e", (F.col("block") + 1) * block_words)
    words = F.greatest(hi - lo, F.lit(0)) * F.coalesce("__passes", F.lit(0)) + F.greatest(F.least(hi, F.coalesce("__cut", lo)) - lo, F.lit(0))
    return (
        placed.join(blocks, ["__sid", "block"], "left")
        .groupBy("__sid", "__range", "__row", "doc_id", "size", "source_size", "target")
        .agg(F.sum(words).cast("long").alias("taken"))
        .select("doc_id", "size", "source_size", "target", "taken")
    )


def take_documents(docs: DataFrame, **params) -> DataFrame:
    """The mixed documents themselves, with the input's columns: a row for each whole pass over a document and,
    for the one document a source that the target cuts, a row of its first words.

    Rows with equal id, text and source are one document in several rows: they share its words equally, and what
    does not divide goes into rows of their own, so that no word of the mix is lost.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])  # no name of the input's can clash with those below
    doc_id, text, source = (F.col(f"c{names.index(c)}") for c in ("doc_id", "text", "source"))
    rows = plain.withColumn("__hash", F.xxhash64(text, source))
    keyed = rows.select(F.struct(doc_id.alias("doc_id"), F.col("__hash")).alias("doc_id"), text.alias("text"), source.alias("source"))
    taken = mix(keyed, **params).select(F.col("doc_id.doc_id").alias("__id"), F.col("doc_id.__hash").alias("__h"), "size", "taken")
    taken = checkpoint(taken.groupBy("__id", "__h", "size").agg(F.sum("taken").alias("__all"), F.count("*").alias("__rows")).filter("__all > 0"))
    same = doc_id.eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__h"))
    copies = rows.join(taken.select("__id", "__h", "size", F.expr("__all div __rows").alias("__words")), same)
    left = taken.filter("__all % __rows > 0").select("__id", "__h", "size", F.expr("__all % __rows").alias("__words"))
    if not left.isEmpty():
        copies = copies.unionByName(rows.join(left, same).dropDuplicates(["__id", "__h"]))
    rest = F.expr("__words % size")
    passes = F.expr("__words div size").cast("int")
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0)), F.lit(1), rest.cast("int")), " ")
    copies = copies.withColumn("__whole", F.explode(F.concat(F.array_repeat(F.lit(True), passes), F.array_repeat(F.lit(False), F.when(rest > 0, 1).otherwise(0)))))
    out = {c: F.col(f"c{k}") for k, c in enumerate(names)}
    out["text"] = F.when(F.col("__whole"), text).otherwise(cut)
    if "n_chars" in out:
        out["n_chars"] = F.when(F.col("__whole"), out["n_chars"]).otherwise(F.length(cut).cast(docs.schema["n_chars"].dataType))
    return copies.select(*[x.alias(c) for c, x in out.items()])
