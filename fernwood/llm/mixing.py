"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations.

1. Every source's words and target: weights are given to the sources in their order (code
   points, null last), the targets share ``share`` times all words in proportion to the
   weights, and a target stops at ``max_repeat`` times its source's words; what it cannot
   take is shared out again by weight until no target is above its limit.
2. Each source's documents are shuffled by a hash of their id and laid end to end; this
   stream of words is cut into blocks of ``block_words`` words (the last one is shorter).  A
   source that gives more than it has is read again from its first block.
3. The schedule: slot ``i`` has the golden-ratio point ``frac((i + 1/2) * 0.618...)``; the
   interval of the cumulative weights that the point falls in names the slot's source.  The
   weights are the numbers of blocks that the targets need.
4. Slots are ranked per source: the r-th slot of a source takes its r-th block.  A source's
   last block is cut so that its taken words end at its target.  There are three times as
   many slots as blocks are needed; as any interval of one over the number of needed blocks
   then holds a point, every source gets all its slots, and slots beyond them stay unused.

5. The mix in order: every document knows the first slot of each reading of it, and
   :func:`mixed_documents` lays its copies out by these slots, so that whatever reads the mix
   from front to back meets the sources in the schedule's proportions all the way.

Everything is keyed by hashes, so a rerun gives the same mix.  No source is handled by one
task: word positions and slot ranks come from range-bucketed running totals, and the final
join is on (source, block), whose rows are bounded by the block's words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwood.llm.common import WORD_PATTERN, fresh, written
from fernwood.operators.ranking import global_rank, running_total

GOLDEN = 0.6180339887498949
#: partitions of a written mix at most (a layout bound: they only grow beyond it)
MAX_PARTS = 100_000


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_repeat: float) -> DataFrame:
    """``(_sid, source, source_size, target)`` from ``(source, size)`` rows.

    Only sums over the sources come to the driver.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_rank(sources.withColumn("_null", F.col("source").isNull()),
                         [("_null", True), ("source", True)], out="_sid").drop("_null")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.col("_sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = written(ranked.withColumns({"_w": weight, "_cap": F.col("source_size") * float(max_repeat)}), "sources")
    first = ranked.agg(F.sum("source_size").alias("n"), F.sum("_w").alias("w")).first()
    total = share * (first["n"] or 0)
    level, capped = (total / first["w"] if first["w"] else 0.0), -1
    while True:
        full = F.col("_cap") <= F.col("_w") * F.lit(level)
        now = ranked.agg(F.count_if(full).alias("k"), F.sum(F.when(full, F.col("_cap"))).alias("cap"),
                         F.sum(F.when(~full, F.col("_w"))).alias("w")).first()
        if now["k"] == capped or not now["w"]:
            break
        capped, level = now["k"], (total - (now["cap"] or 0.0)) / now["w"]
    return ranked.select("_sid", "source", "source_size",
                         F.least(F.col("_cap"), F.col("_w") * F.lit(level)).alias("target"))


def mixing_plan(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_repeat: float = 2.0,
                block_words: int = 1024, id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The documents with their sizes and targets, and the pieces that the schedule takes.

    Documents: ``_id, source, size, source_size, target, _sid, _end`` (a document covers the
    words before ``_end`` of its source's stream); pieces: ``slot, _sid, _end, _id, epoch,
    from_word, to_word`` in words of the document, end exclusive (``epoch``: how often the
    source was read to its end before).  A null source is a source;
    null, empty and white-space texts have size 0 and are never taken; repeated rows are
    separate documents that share an id; an empty table gives two empty tables.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    sized = written(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"),
                                size.alias("size"), F.xxhash64(F.col(text_col)).alias("_text")), "sizes")
    sources = written(source_targets(sized, weights, share, max_repeat), "targets")
    docs_of = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    order = docs_of.withColumn("_h", F.xxhash64("_id", F.lit(seed)))
    placed = written(running_total(order, [("_h", True), ("_id", True), ("size", True)],
                                   {"_end": "size"}, ["_sid"]).drop("_h"), "placed")

    b, goal = F.lit(block_words), F.round("target").cast("long")
    blocks = F.ceil(F.col("source_size") / b).cast("long")
    whole = F.floor(goal / F.col("source_size")).cast("long")
    need = whole * blocks + F.ceil((goal - whole * F.col("source_size")) / b).cast("long")
    wanted = sources.filter(goal > 0).select("_sid", "source_size", goal.alias("_goal"), blocks.alias("_blocks"),
                                             need.alias("_need"))
    wanted = written(running_total(wanted, [("_sid", True)], {"_upto": "_need"}), "wanted")
    n, k = wanted.agg(F.coalesce(F.sum("_need"), F.lit(0)), F.count(F.lit(1))).first()
    slots = slot_sources(wanted, int(n), int(k))
    ranked = global_rank(slots, [("slot", True)], ["_sid"], "_rank").filter("_rank <= _need")
    r = F.col("_rank") - 1
    epoch = F.floor(r / F.col("_blocks")).cast("long")
    block = r - epoch * F.col("_blocks")
    quota = F.least(b.cast("long"), F.col("source_size") - block * b,
                    F.col("_goal") - epoch * F.col("source_size") - block * b)
    uses = ranked.select("slot", "_sid", epoch.alias("epoch"), block.alias("_block"), (block * b).alias("_lo"),
                         (block * b + quota).alias("_hi"))

    start = F.col("_end") - F.col("size")
    parts = placed.filter("size > 0").select(
        "_id", "_sid", "_end", "size",
        F.explode(F.sequence(F.floor(start / b), F.floor((F.col("_end") - 1) / b))).alias("_block"))
    pieces = parts.join(uses, ["_sid", "_block"]).select(
        "slot", "_sid", "_end", "_id", "epoch", (F.greatest("_lo", start) - start).alias("from_word"),
        (F.least("_hi", F.col("_end")) - start).alias("to_word"))
    return placed, pieces.filter("from_word < to_word")


def slot_sources(wanted: DataFrame, n: int, k: int) -> DataFrame:
    """``(slot, _sid, ...)`` of the golden-ratio schedule over ``n`` needed blocks of ``k`` sources.

    The points are matched with the cumulative weights cell by cell: [0, 1) is cut into
    cells, a source is listed in every cell its interval touches.
    """
    cells = max(1024, 2 * k)
    unit = F.lit(float(max(n, 1)))
    # a point and a bound are compared as doubles of the same formula, so each point has one source
    lo, hi = (F.col("_upto") - F.col("_need")) / unit, F.col("_upto") / unit
    listed = wanted.select("*", lo.alias("_from"), hi.alias("_to")).withColumn("_cell", F.explode(F.sequence(
        F.floor(F.col("_from") * cells), F.least(F.floor(F.col("_to") * cells), F.lit(cells - 1)))))
    spark = wanted.sparkSession
    slots = spark.range(3 * n + 64 if n else 0).withColumnRenamed("id", "slot")
    slots = slots.withColumn("_u", F.pmod((F.col("slot") + 0.5) * GOLDEN, F.lit(1.0).cast("double")))
    slots = slots.withColumn("_cell", F.least(F.floor(F.col("_u") * cells), F.lit(cells - 1)))
    return slots.join(listed, "_cell").filter("_u >= _from AND _u < _to").select(
        "slot", "_sid", "source_size", "_goal", "_blocks", "_need")


def _amounts(docs: DataFrame, **options) -> DataFrame:
    placed, pieces = mixing_plan(docs, **options)
    # the end position is unique among the documents of a source that have words; a source is
    # read few times over, so a document has few epochs
    epochs = pieces.groupBy("_sid", "_end", "epoch").agg(
        F.sum(F.col("to_word") - F.col("from_word")).alias("n"), F.min("slot").alias("slot"),
        F.count(F.lit(1)).alias("k"))
    taken = epochs.groupBy("_sid", "_end").agg(
        F.sum("n").alias("taken"), F.sum("k").alias("n_pieces"),
        F.transform(F.array_sort(F.collect_list(F.struct("epoch", "slot"))), lambda e: e["slot"]).alias("slots"))
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")
    full = placed.filter("size > 0").join(taken, ["_sid", "_end"], "left").withColumns(
        {"taken": F.coalesce("taken", zero), "n_pieces": F.coalesce("n_pieces", zero), "slots": F.coalesce("slots", none)})
    return full.unionByName(placed.filter("size = 0").withColumns({"taken": zero, "n_pieces": zero, "slots": none}))


def mixed_amounts(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: ``id_col, size, source_size, target, taken, source, slot, n_pieces``.

    ``taken`` is the number of words the mix takes, repeats counted; ``slot`` the first slot of
    the schedule that takes some of them (null: none does) and ``n_pieces`` the number of
    slots that do.
    """
    return _amounts(docs, id_col=id_col, **options).select(
        F.col("_id").alias(id_col), "size", "source_size", "target", "taken", "source",
        F.array_min("slots").alias("slot"), "n_pieces")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    part_words: int = 4_000_000, **options) -> DataFrame:
    """``docs`` as the mix takes them, columns unchanged: a document's rows repeat as often as its
    words are taken, rounded to whole documents.

    The rows come in the order of the schedule: copy ``i`` of a document stands at the first slot
    of its ``i``-th reading, partitions are ranges of slots of about ``part_words`` words, sorted
    inside, and so is a table written from them.  A document without words is never taken.
    Rows with the same id and text are the same document: each of them is repeated as often as
    the one with the most words taken.
    """
    amounts = written(_amounts(docs, id_col=id_col, text_col=text_col, **options).filter("taken > 0"), "amounts")
    words, last = amounts.agg(F.coalesce(F.sum("taken"), F.lit(0)), F.coalesce(F.max(F.array_max("slots")), F.lit(0))).first()
    times = F.round(F.col("taken") / F.col("size")).cast("int")
    amounts = amounts.groupBy("_id", "_text").agg(F.max(F.struct(times.alias("times"), "slots")).alias("_mix")).filter(
        "_mix.times > 0")
    slot, mix = fresh("_slot", docs.columns), F.col("_mix")
    same = docs[id_col].eqNullSafe(amounts["_id"]) & (F.xxhash64(docs[text_col]) == amounts["_text"])
    copies = F.transform(F.sequence(F.lit(1), mix["times"]), lambda i: F.element_at(
        mix["slots"], F.least(i, F.size(mix["slots"]))))
    placed = docs.join(amounts, same).select(*[docs[c] for c in docs.columns], F.explode(copies).alias(slot))
    parts = max(1, min(-(-int(words) // part_words), MAX_PARTS))
    part = F.floor(F.col(slot) * parts / (int(last) + 1)).cast("int")
    return placed.repartitionById(parts, part).sortWithinPartitions(slot, F.xxhash64(id_col)).drop(slot)
