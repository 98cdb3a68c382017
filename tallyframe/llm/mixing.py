"""Mixing sources to target weights: a time-varying curriculum, in DataFrame expressions only.

Each source has a weight over training progress (a step function). Its integral gives the source's
share of the token budget and, as a function of progress, its cumulative demand; inverting that
demand turns a token offset within the source into a training position; documents are range-sorted
by position.

Offsets are running sums over a source in the order of a seeded hash of ``doc_id``. They are built in
two levels (a source is cut into ``BLOCKS`` hash blocks, sums of blocks are small), so a source that
holds most of the rows is spread over all tasks.

Defined results: a null text or a text without words has size 0 and is never taken; a null source is
a source of its own, ranked last; rows repeated under one doc_id are separate rows, ordered by size
and text hash; an empty table gives an empty result; other columns of the input are not read."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.sources.sinks import stored

WORD = r"[^\x20\x09-\x0D]+"
BLOCKS = 4096
#: Weights of the sources by rank, repeating, over progress: (end of the phase, weights).
#: Over the whole run they integrate to 5, 2, 1.
CURRICULUM = ((0.5, (6.0, 1.5, 0.5)), (1.0, (4.0, 2.5, 1.5)))
BUDGET = 1.5
REPEATS = 2.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _by_class(rank: Column, values: Sequence[float]) -> Column:
    out = F.lit(float(values[-1]))
    for i, v in enumerate(values[:-1]):
        out = F.when(rank % len(values) == i, F.lit(float(v))).otherwise(out)
    return out


def _integrals(schedule) -> list[list[float]]:
    """Per class of sources, the integral of the weight up to each end of a phase."""
    out = [[0.0] for _ in schedule[0][1]]
    start = 0.0
    for end, weights in schedule:
        for sums, w in zip(out, weights):
            sums.append(sums[-1] + w * (end - start))
        start = end
    return out


def source_targets(sizes: DataFrame, schedule=CURRICULUM, budget: float = BUDGET,
                   repeats: float = REPEATS) -> DataFrame:
    """(source, source_size) -> plus rank, target: the budget shared by integrated weight, where no
    target exceeds ``repeats`` times its source and the excess is reshared by weight.

    The repeated resharing ends where every source holds min(repeats * size, level * weight); sorted
    by the level at which they fill up, the level follows from running sums. One row per source."""
    total = [sums[-1] for sums in _integrals(schedule)]
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_fill = Window.orderBy("fills_at", "rank")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    ranked = (ranked.withColumn("weight", _by_class(F.col("rank"), total))
              .withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
              .withColumn("fills_at", F.col("cap") / F.col("weight")))
    level = ((F.sum("source_size").over(everything) * F.lit(float(budget))
              - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    levelled = ranked.withColumn("level_here", level)
    # the first source (in order of filling up) that the level reaches without filling it, sets the level
    level = F.min(F.when(F.col("level_here") <= F.col("fills_at"), F.struct("fills_at", "rank", "level_here"))
                  ).over(everything)["level_here"]
    return (levelled.withColumn("level", level)
            .withColumn("target", F.when(F.col("level").isNull() | (F.col("level") >= F.col("fills_at")),
                                         F.col("cap")).otherwise(F.col("level") * F.col("weight")))
            .select("source", "source_size", "rank", "target"))


def _position(offset: Column, target: Column, rank: Column, schedule) -> Column:
    """Progress at which a source's demand reaches ``offset``: the inverse of its integrated weight."""
    integrals = _integrals(schedule)
    share = F.when(target > 0, offset / target).otherwise(F.lit(0.0))
    out, start = F.lit(0.0), 0.0
    for p, (end, weights) in enumerate(schedule):
        low = _by_class(rank, [sums[p] / sums[-1] for sums in integrals])
        width = _by_class(rank, [(sums[p + 1] - sums[p]) / sums[-1] for sums in integrals])
        done = F.when(width > 0, (share - low) / width).otherwise(F.when(share > low, 1.0).otherwise(0.0))
        out = out + F.lit(end - start) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), done))
        start = end
    return out


def mix(docs: DataFrame, schedule=CURRICULUM, budget: float = BUDGET, repeats: float = REPEATS,
        seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words the mix takes, repeats
    counted; the document at which the source's target ends is cut there), positions (training progress in
    0..1 at which each of its passes begins), position (the first, null if none), text_key (hash of the
    text, to tell rows of one doc_id apart), order_key."""
    sized = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("text_key"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("order_key"))
    sized = stored(sized.withColumn("block", F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long") % BLOCKS))
    blocks = sized.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    sources = source_targets(blocks.groupBy("source").agg(F.sum("block_size").alias("source_size")),
                             schedule, budget, repeats)
    run = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("source", "block",
                           F.coalesce(F.sum("block_size").over(run), F.lit(0)).alias("before"))
    same_source = blocks["source"].eqNullSafe(sources["source"])
    blocks = blocks.join(sources, same_source).select(
        blocks["source"].alias("block_source"), blocks["block"].alias("block_id"), "before",
        "source_size", "rank", "target")
    placed = sized.join(blocks, sized["source"].eqNullSafe(blocks["block_source"])
                        & (sized["block"] == blocks["block_id"]))
    run = (Window.partitionBy("source", "block").orderBy("order_key", "doc_id", "size", "text_key")
           .rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("before") + F.coalesce(F.sum("size").over(run), F.lit(0))
    placed = placed.withColumn("start", start).withColumn("whole", F.round("target").cast("long"))
    taken, dues = F.lit(0).cast("long"), []
    for k in range(math.ceil(repeats)):
        passed = F.col("start") + F.lit(k) * F.col("source_size")
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("whole") - passed))
        taken = taken + words
        dues.append(F.when(words > 0, _position(passed.cast("double"), F.col("target"), F.col("rank"), schedule)))
    return (placed.withColumn("taken", taken).withColumn("positions", F.array_compact(F.array(*dues)))
            .select("doc_id", "source", "size", "source_size", "target", "taken",
                    F.get("positions", F.lit(0)).alias("position"), "positions", "text_key", "order_key"))


def in_training_order(rows: DataFrame) -> DataFrame:
    """Range-sorted by position; what is not taken comes last."""
    return rows.orderBy(F.col("position").asc_nulls_last(), "order_key")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The corpus of the mix, in training order: every document as often as the mix begins it (the document
    at which a target ends stays whole), with the columns of ``docs``."""
    plan = (mix(docs.select("doc_id", "source", "text"), **options).where("taken > 0")
            .dropDuplicates(["doc_id", "source", "text_key"])
            .select(F.struct("doc_id", "source", "text_key", "positions", "order_key").alias("_mix")))
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("text_key"),
                       F.struct(*[docs[n] for n in docs.columns]).alias("row"))
    kept = rows.join(plan, rows["doc_id"].eqNullSafe(plan["_mix.doc_id"])
                     & rows["source"].eqNullSafe(plan["_mix.source"]) & (rows["text_key"] == plan["_mix.text_key"]))
    return (kept.select("row", "_mix.order_key", F.explode("_mix.positions").alias("due"))
            .orderBy("due", "order_key").select("row.*"))
