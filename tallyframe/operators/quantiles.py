"""Exact interpolated quantiles whose state stays bounded at any table size, in two scans.

The first scan counts the values and sketches them: a mergeable summary of bounded size names two
values between which each wanted rank lies.  The second counts exactly what lies below and at those
two, and writes what lies strictly between, a few values in ten thousand whatever their distribution.
Ranks are then read off what was written: sorted within one task where it has been counted to be
little, else by narrowing, where each round counts the values per bucket (a map-side combined
aggregate with a bounded number of groups) and keeps the bucket that holds the wanted rank.

The sketch proposes only; the counts decide.  A rank that lies outside its two values is
found by narrowing over the table itself.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from tallyframe.sources.sinks import discard, materialize, stored

QUARTILES = (0.25, 0.5, 0.75)
BUCKETS = 1024
# A bracket with at most this many values is sorted within one task.
SORT_LIMIT = 20_000
STEPS_PER_OCTAVE = 64
# Ranks of the sketch are off by at most one in ACCURACY; its two values stand three times that apart on either side.
ACCURACY = 10_000
MARGIN = 3 / ACCURACY
# Expressions sketched together.
CHUNK = 16
# From this many values on, what lies in the first brackets is kept instead of rescanned,
# provided that it is a small part of the whole.
KEEP_FROM_ROWS = 5_000_000
KEEP_SHARE = 0.125

_BRACKETS = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("bracket", T.IntegerType()),
    T.StructField("lo", T.DoubleType()),
    T.StructField("hi", T.DoubleType()),
])


def _magnitude_bucket(v: Column) -> Column:
    """Monotone bucket by sign and logarithm: sorts out any spread of magnitudes."""
    inf = float("inf")
    step = F.floor(F.log2(F.abs(v)) * STEPS_PER_OCTAVE) + 1100 * STEPS_PER_OCTAVE
    top = 4000 * STEPS_PER_OCTAVE
    return (
        F.when(F.isnan(v), F.lit(2 * top))
        .when(v == inf, F.lit(top))
        .when(v == -inf, F.lit(-top))
        .when(v == 0, F.lit(0))
        .when(v > 0, step)
        .otherwise(-step)
        .cast("long")
    )


def _long_values(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """One (key, v) row per non-null value."""
    keys = list(values)
    wide = df.select(*[values[k].cast("double").alias(f"v{i}") for i, k in enumerate(keys)])
    cols = wide.columns
    names = F.create_map(*[F.lit(x) for i, k in enumerate(keys) for x in (f"v{i}", k)])
    long = wide.unpivot([], cols, "slot", "v").where(F.col("v").isNotNull())
    return long.select(names[F.col("slot")].alias("key"), "v")


def _same(lo: float, hi: float) -> bool:
    return lo == hi or (math.isnan(lo) and math.isnan(hi))


def _wanted(total: int, p: float) -> set[int]:
    """Ranks of the two values that a quantile joins."""
    return {math.floor(p * (total - 1)), math.ceil(p * (total - 1))}


def order_statistics(df: DataFrame, values: Mapping[str, Column],
                     probabilities: Sequence[float] = QUARTILES) -> dict[str, list[float]]:
    """{key: [quantile per probability]} of each expression; keys without values are absent.

    Every action returns a handful of rows per key."""
    keys, out = list(values), {}
    for start in range(0, len(keys), CHUNK):
        chunk = {k: values[k] for k in keys[start:start + CHUNK]}
        totals, solved = _seeded(df, chunk, probabilities)
        left = {k: sorted(r for p in probabilities for r in _wanted(t, p) if (k, r) not in solved)
                for k, t in totals.items()}
        left = {k: ranks for k, ranks in left.items() if ranks}
        if left:
            solved.update(_narrowed(_long_values(df, {k: chunk[k] for k in left}), left))
        for key, total in totals.items():
            out[key] = []
            for p in probabilities:
                position = p * (total - 1)
                a, b = solved[key, math.floor(position)], solved[key, math.ceil(position)]
                out[key].append(a if _same(a, b) else a + (b - a) * (position - math.floor(position)))
    return out


def _seeded(df: DataFrame, values: Mapping[str, Column], probabilities: Sequence[float]):
    """({key: number of values}, {(key, rank): value}): what a sketch and one pass between its values settle.

    An expression with at most ``SORT_LIMIT`` values is written whole instead of sketched."""
    keys = list(values)
    wide = df.select(*[values[k].cast("double").alias(f"v{i}") for i, k in enumerate(keys)])
    near = [q for p in probabilities for q in (max(0.0, p - MARGIN), min(1.0, p + MARGIN))]
    sketch = wide.agg(*[x for i in range(len(keys)) for x in (
        F.count(f"v{i}").alias(f"n{i}"), F.percentile_approx(f"v{i}", near, ACCURACY).alias(f"a{i}"))]).first()
    totals = {k: sketch[f"n{i}"] for i, k in enumerate(keys) if sketch[f"n{i}"]}
    between, counts, cells = [], [], []
    for i, k in enumerate(keys):
        v, total = F.col(f"v{i}"), totals.get(k, 0)
        if not total:
            continue
        if total <= SORT_LIMIT:
            between.append((k, None, None, sorted({r for p in probabilities for r in _wanted(total, p)})))
            cells.append((v, v.isNotNull()))
            continue
        for j, p in enumerate(probabilities):
            b, (low, high) = len(between), sketch[f"a{i}"][2 * j:2 * j + 2]
            between.append((k, low, high, sorted(_wanted(total, p))))
            counts += [F.count_if(c).alias(f"{name}{b}") for name, c in (
                ("under", v < low), ("to", v <= low), ("before", v < high), ("upto", v <= high))]
            cells.append((v, (v > low) & (v < high)))
    if not between:
        return totals, {}
    rows = F.explode(F.array_compact(F.array(*[
        F.when(inside, F.struct(F.lit(str(b)).alias("key"), v.alias("v"))) for b, (v, inside) in enumerate(cells)])))
    seen = Observation()
    # counted while the values between are written: one scan for both
    watched = wide.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    long = stored(watched.select(rows.alias("x")).select("x.key", "x.v"))
    found = seen.get
    solved, names, small, large, ranks = {}, {}, [], {}, {}
    for b, (k, low, high, wanted) in enumerate(between):
        under, to, before, upto = ((0, 0, totals[k], totals[k]) if low is None else
                                   (found[f"{name}{b}"] for name in ("under", "to", "before", "upto")))
        solved.update({(k, r): low for r in wanted if under <= r < to})
        solved.update({(k, r): high for r in wanted if before <= r < upto})
        inner = [r - to for r in wanted if to <= r < before]
        if not inner:
            continue
        names[str(b)], ranks[str(b)] = (k, to), inner
        if before - to <= SORT_LIMIT:
            small.append((str(b), -math.inf, math.nan, before - to, 0))
        else:
            large[str(b)] = inner
    inner_solved = _sorted_brackets(df.sparkSession, long, small, ranks) if small else {}
    if large:
        inner_solved.update(_narrowed(long.where(F.col("key").isin(list(large))), large))
    discard(long)
    solved.update({(names[b][0], r + names[b][1]): value for (b, r), value in inner_solved.items()})
    return totals, solved


def _narrowed(long: DataFrame, ranks: Mapping[str, list[int]]) -> dict[tuple[str, int], float]:
    """{(key, rank): value} of rows (key, v), by narrowing from buckets of magnitude on."""
    spark = long.sparkSession
    by_bucket = Window.partitionBy("key").orderBy("bucket")
    wanted = F.create_map(*[x for k, rs in ranks.items() for x in (F.lit(k), F.array(*[F.lit(int(r)) for r in rs]))])
    first = (
        long.groupBy("key", _magnitude_bucket(F.col("v")).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .withColumn("upto", F.sum("n").over(by_bucket))
        .withColumn("total", F.sum("n").over(Window.partitionBy("key")))
        .withColumn("before", F.col("upto") - F.col("n"))
    )
    found = first.where(F.exists(wanted[F.col("key")], lambda r: (r >= F.col("before")) & (r < F.col("upto")))).select(
        "key", "lo", "hi", "n", "before", "total").collect()
    open_brackets = [tuple(r[:5]) for r in found]
    whole_size, kept = sum({r["key"]: r["total"] for r in found}.values()), False
    solved: dict[tuple[str, int], float] = {}
    while True:
        wide_open, small = [], []
        for key, lo, hi, n, before in open_brackets:
            if _same(lo, hi):
                solved.update({(key, r): lo for r in ranks[key] if before <= r < before + n})
            elif n <= SORT_LIMIT:
                small.append((key, lo, hi, n, before))
            else:
                wide_open.append((key, lo, hi, n, before))
        still = wide_open + small
        left = sum(b[3] for b in still)
        if still and not kept and whole_size >= KEEP_FROM_ROWS and left <= KEEP_SHARE * whole_size:
            long, kept = materialize(_inside(spark, long, still).select("key", "v")), True
        if small:
            solved.update(_sorted_brackets(spark, long, small, ranks))
        if not wide_open:
            return solved
        open_brackets = _narrow(spark, long, wide_open, ranks)


def _inside(spark, long: DataFrame, brackets: list[tuple]) -> DataFrame:
    # at most two rows per (key, probability): a broadcast of proven size
    frame = spark.createDataFrame([(b[0], i, b[1], b[2]) for i, b in enumerate(brackets)], _BRACKETS)
    return long.join(
        F.broadcast(frame.withColumnRenamed("key", "k")),
        (F.col("key") == F.col("k")) & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")),
    )


def _sorted_brackets(spark, long, brackets, ranks) -> dict[tuple[str, int], float]:
    """Read the wanted ranks off brackets whose size has been counted and is small."""
    wanted = [(i, b, r) for i, b in enumerate(brackets) for r in ranks[b[0]] if b[4] <= r < b[4] + b[3]]
    offsets = F.create_map(*[
        x for i, b in enumerate(brackets)
        for x in (F.lit(i), F.array(*[F.lit(int(r - b[4])) for j, _, r in wanted if j == i]))
    ])
    rows = (
        _inside(spark, long, brackets)
        .groupBy("bracket").agg(F.sort_array(F.collect_list("v")).alias("sorted"))
        .select("bracket", F.posexplode(offsets[F.col("bracket")]).alias("slot", "offset"), "sorted")
        .select("bracket", "offset", F.get("sorted", F.col("offset")).alias("v"))
        .collect()
    )
    at = {(r["bracket"], r["offset"]): r["v"] for r in rows}
    return {(b[0], r): at[i, r - b[4]] for i, b, r in wanted}


def _narrow(spark, long, brackets, ranks) -> list[tuple]:
    """Split each bracket into equal-width buckets and keep those that hold a wanted rank."""
    share = (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))
    before = F.create_map(*[x for i, b in enumerate(brackets) for x in (F.lit(i), F.lit(int(b[4])))])
    wanted = F.create_map(*[
        x for i, b in enumerate(brackets)
        for x in (F.lit(i), F.array(*[F.lit(int(r)) for r in ranks[b[0]] if b[4] <= r < b[4] + b[3]]))
    ])
    by_bucket = Window.partitionBy("bracket").orderBy("bucket")
    rows = (
        _inside(spark, long, brackets)
        .groupBy("key", "bracket", F.floor(share * BUCKETS).cast("int").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .withColumn("upto", F.sum("n").over(by_bucket) + before[F.col("bracket")])
        .withColumn("before", F.col("upto") - F.col("n"))
        .withColumn("wanted", wanted[F.col("bracket")])
        .where(F.exists("wanted", lambda r: (r >= F.col("before")) & (r < F.col("upto"))))
        .select("key", "lo", "hi", "n", "before")
        .collect()
    )
    return [tuple(r) for r in rows]
