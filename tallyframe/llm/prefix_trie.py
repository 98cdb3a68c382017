"""The trie of conversation prefixes, rolled up in depth bands.

A node is a distinct sequence of first turns (role, text); its key is a hash chained over them. Rows come sorted
by conversation and turn, so a task makes the keys of one conversation after the other while it holds one band of
keys, and a node's row carries the keys of its ancestors within one band above.

Sums over subtrees would take either one row for each ancestor of each node, or a round for each level. Here the
levels form bands of fixed height. First every node counts for its ancestors within its band (and itself): at most
``height`` rows a node. Then, from the deepest band up, the total of a band's root is complete; it counts for its
ancestors in the band above, and completes their totals. So there are as many rounds as bands. Unless it is given,
the height is about the root of the greatest depth, which bounds rounds and rows alike.

All counts are combined before rows are dealt by node, so a first turn that a third of the conversations share
costs one row per task. Lists of conversations that end in a node are sorted by ranges, each task joins its numbers
to pieces of text, and only the pieces of a node come together, in order, to be hashed as a stream.

Defined results: a null role or text is an empty one; rows of a conversation are ordered by turn (null first), role
and text, repeated rows are turns of their own; rows with a null conv_id belong to no conversation and are left
out; an empty table gives an empty result, as then there is no conversation; other columns are not read."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.sources.sinks import stored

LEAST_HEIGHT = 4
#: Numbers that are joined to one piece of text.
PIECE_IDS = 10_000
ROOT = bytes(16)
NOTHING = hashlib.sha256(b"").hexdigest()
#: Of the rebuilt conversations of the query.
SHARED_TURNS, FAMILY = 6, 100

STEP = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("parent", T.BinaryType()), T.StructField("depth", T.LongType()),
    T.StructField("above", T.ArrayType(T.BinaryType())), T.StructField("chars", T.LongType()),
    T.StructField("conv_id", T.LongType()), T.StructField("ends", T.BooleanType())])
_STEP_KINDS = (pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.binary()), pa.int64(), pa.int64(), pa.bool_())


def child_key(parent: bytes, role: str, text: str) -> bytes:
    role, text = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
    return hashlib.blake2b(b"%b%d,%b%b" % (parent, len(role), role, text), digest_size=16).digest()


def _steps(height: int, skipped: Callable[[int], int]):
    """Rows (conv_id, own, role, text) in order to steps: a row per conversation and depth, and one for its end.

    Of the own turns of a conversation, the first ``skipped(conv_id)`` are passed over. ``above`` has the keys of the
    ancestors, nearest first, down to the root of the band that the parent is in."""

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, depth, key, chain, passed = None, 0, ROOT, [], 0
        rows: list[tuple] = []

        def ended():
            return key, None, depth, None, None, conv, True

        for batch in batches:
            for conv_id, own, role, text in zip(*[batch.column(c) for c in ("conv_id", "own", "role", "text")]):
                conv_id, text = conv_id.as_py(), text.as_py()
                if conv_id != conv:
                    if conv is not None:
                        rows.append(ended())
                    conv, depth, key, chain, passed = conv_id, 0, ROOT, [], skipped(conv_id)
                if own.as_py() and passed:
                    passed -= 1
                    continue
                if depth % height == 0:
                    chain = []
                chain.append(key)  # the ancestors in the parent's band
                parent, key, depth = key, child_key(key, role.as_py(), text), depth + 1
                rows.append((key, parent, depth, chain[::-1], len(text), conv, False))
                if len(rows) >= 8192:
                    yield written(rows)
                    rows = []
        if conv is not None:
            rows.append(ended())
        if rows:
            yield written(rows)

    def written(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _STEP_KINDS)], names=STEP.names)

    return steps


PIECE = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("first", T.LongType()), T.StructField("piece", T.StringType())])
HASHED = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("ends_sha256", T.StringType())])


def _id_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) to numbers joined by commas."""

    def written(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=PIECE.names)

    now, ids, out, size = None, [], [], 0
    for batch in batches:
        for key, conv_id in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if key != now or len(ids) >= PIECE_IDS:
                if ids:
                    out.append((now, ids[0], ",".join(map(str, ids))))
                    size += len(ids)
                    if size >= PIECE_IDS:
                        yield written(out)
                        out, size = [], 0
                now, ids = key, []
            ids.append(conv_id)
    if ids:
        out.append((now, ids[0], ",".join(map(str, ids))))
    if out:
        yield written(out)


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, first, piece) to the hash of all pieces of a key, joined by commas."""
    now, state = None, None
    for batch in batches:
        out = []
        for key, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist()):
            if key != now:
                if now is not None:
                    out.append((now, state.hexdigest()))
                now, state = key, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=HASHED.names)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], names=HASHED.names)


def _sums(counts: DataFrame) -> DataFrame:
    return counts.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _for_ancestors(nodes: DataFrame, ancestors: Column) -> DataFrame:
    return _sums(nodes.select(F.explode(ancestors).alias("key"), "leaves", "saved"))


def subtree_sums(nodes: DataFrame, height: int, bands: int) -> DataFrame:
    """(key, leaves, saved): sums over the subtree of each node. ``nodes`` has key, depth, above, and the node's own
    leaves and saved."""
    at_root = F.col("depth") % height == 0
    ancestors = F.when(at_root, F.array("key")).otherwise(F.concat(F.array("key"), F.col("above")))
    within = stored(_for_ancestors(nodes, ancestors))
    roots = stored(nodes.where(at_root & (F.col("depth") > 0)).select("key", "depth", "above").join(within, "key"))
    parts, risen = [within], None
    for band in range(bands - 1, 0, -1):
        # totals of this band's roots, completed by the band below, count for their ancestors in the band above
        complete = roots.where(F.col("depth") == band * height)
        if risen is not None:
            added = risen.toDF("key", "more_leaves", "more_saved")
            complete = complete.join(added, "key", "left").select(
                "above", *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")])
        risen = stored(_for_ancestors(complete, F.col("above")))
        parts.append(risen)
    return _sums(reduce(DataFrame.unionByName, parts))


def trie(turns: DataFrame, skipped: Callable[[int], int] = lambda conv_id: 0, height: int | None = None) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. ``turns`` has conv_id, turn, role, text and ``own`` (int): rows of own = 0 come before all others of
    their conversation, of the others the first ``skipped(conv_id)`` are passed over."""
    deepest = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    height = height or max(LEAST_HEIGHT, math.isqrt(deepest))
    partitions = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = stored(turns.repartition(partitions, "conv_id").sortWithinPartitions("conv_id", "own", "turn", "role", "text")
                   .select("conv_id", "own", "role", "text").mapInArrow(_steps(height, skipped), STEP))
    ends = steps.where("ends").select("key", "conv_id")
    root = (ends.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
            .select(F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
                    F.array().cast("array<binary>").alias("above"), F.lit(0).cast("long").alias("chars"), "n_convs", "conv_id"))
    # equal keys have equal parents, depths, ancestors and texts
    deeper = steps.where("not ends").groupBy("key").agg(
        *[F.min(c).alias(c) for c in ("parent", "depth", "above", "chars")],
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    nodes = root.unionByName(deeper)
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    bands = (nodes.agg(F.max("depth")).first()[0] or 0) // height + 1
    totals = subtree_sums(nodes.select(
        "key", "depth", "above", (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), height, bands)
    pieces = ends.repartitionByRange(partitions, "key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(
        _id_pieces, PIECE)
    hashes = (pieces.repartition(partitions, "key").sortWithinPartitions("key", "first").select("key", "piece")
              .mapInArrow(_hash_pieces, HASHED))
    parents = nodes.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.select("key", "parent", "conv_id", "depth", "n_convs", "n_children").join(totals, "key")
            .join(hashes, "key", "left").join(parents, "parent", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                    F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")))


def _own_turns(turns: DataFrame) -> DataFrame:
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
                        ).where("conv_id is not null")


def conversation_trie(turns: DataFrame, height: int | None = None) -> DataFrame:
    """The trie of the conversations as they are."""
    return trie(_own_turns(turns).withColumn("own", F.lit(1)), height=height)


def shared_turns(conv_id: int) -> int:
    return zlib.crc32(str(conv_id).encode()) % SHARED_TURNS


def rebuilt_trie(turns: DataFrame, height: int | None = None) -> DataFrame:
    """The trie of conversations whose first h turns are those of the first conversation of their hundred (if it has
    them), where h is the CRC-32 of the conv_id's digits modulo six."""
    own = _own_turns(turns)
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = own.where(F.col("conv_id") % FAMILY == 0)
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    heads = heads.withColumn("place", F.row_number().over(in_order)).where(F.col("place") < SHARED_TURNS)
    members = own.select("conv_id").distinct().select(
        "conv_id", family.alias("head"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS).alias("h"))
    given = members.join(heads.withColumnRenamed("conv_id", "head"), "head").where("place <= h").select(
        "conv_id", F.col("place").cast("long").alias("turn"), "role", "text", F.lit(0).alias("own"))
    return trie(own.withColumn("own", F.lit(1)).unionByName(given), shared_turns, height)
