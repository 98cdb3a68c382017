"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A fingerprint is the sum, lane by lane, of one wide vector per paragraph (a line that is not empty):
64 bytes of a keyed hash as eight lanes modulo 2**64, which decide equality, and ``LANES`` lanes
modulo 2**16 that count the paragraph's three-word shingles with a sign each, whose cosine is the
likeness. Sums do not depend on the order of paragraphs; paragraphs are inserted or deleted by adding
or subtracting their vectors.

Defined results: a null text is an empty one; an empty text has the zero fingerprint; two equal
fingerprints have likeness 1, a zero one and another 0; texts of equal paragraphs in another order have
equal fingerprints; lane counts wrap at 2**15 equal signed shingles. Texts of any length are hashed
whole, in pieces of bounded size."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.hashing import byte_table, mixed, odd_numbers, words

LANES = 128
SHINGLE = 3
PIECE_BYTES = 1 << 21

_BYTES = byte_table(20240229)
_FACTORS = odd_numbers(20240301, SHINGLE)


def _shingle_lanes(blob: bytes, owner_ends: np.ndarray, owners: int) -> np.ndarray:
    """Signed shingle counts (owners x LANES) of the paragraphs in ``blob``; owner i ends at owner_ends[i]."""
    data = np.frombuffer(blob, np.uint8)
    word, starts = words(data, _BYTES)
    if not len(word):
        return np.zeros((owners, LANES))
    lines = np.concatenate(([0], np.cumsum(data == 10)))[starts]
    shingle = word * _FACTORS[0]
    length = np.ones(len(word), np.int64)
    for k in range(1, SHINGLE):
        same = np.zeros(len(word), bool)
        same[:-k] = lines[:-k] == lines[k:]
        shingle[:-k] += np.where(same[:-k], word[k:] * _FACTORS[k], np.uint64(0))
        length += same
    first = np.concatenate(([True], lines[1:] != lines[:-1]))
    use = (length == SHINGLE) | first  # a paragraph of fewer words is one shingle
    shingle, at = mixed(shingle[use]), starts[use]
    lane = (shingle & np.uint64(LANES - 1)).astype(np.int64)
    sign = np.where(shingle >> np.uint64(63), -1.0, 1.0)
    owner = np.searchsorted(owner_ends, at, side="right")
    return np.bincount(owner * LANES + lane, sign, owners * LANES).reshape(owners, LANES)


def fingerprint_vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(n x 8 uint64, n x LANES uint16) of the texts. Both parts may be added and subtracted."""
    wide = np.zeros((len(texts), 8), np.uint64)
    lanes = np.zeros((len(texts), LANES), np.uint16)
    parts, owners, size = [], [], 0

    def flush():
        nonlocal parts, owners, size
        if parts:
            ends = np.cumsum([len(p) for p in parts])
            found = _shingle_lanes(b"".join(parts), ends, len(parts))
            np.add.at(lanes, np.array(owners), found.astype(np.int64).astype(np.uint16))
        parts, owners, size = [], [], 0

    for i, text in enumerate(texts):
        blob = text.encode("utf-8", "surrogatepass")
        paragraphs = [p for p in blob.split(b"\n") if p]
        if paragraphs:
            digests = b"".join(hashlib.blake2b(p, digest_size=64).digest() for p in paragraphs)
            wide[i] = np.frombuffer(digests, "<u8").reshape(-1, 8).sum(axis=0, dtype=np.uint64)
        run: list[bytes] = []
        for p in paragraphs:
            run.append(p)
            size += len(p) + 1
            if size >= PIECE_BYTES:
                parts.append(b"\n".join(run) + b"\n")
                owners.append(i)
                run = []
                flush()
        if run:
            parts.append(b"\n".join(run) + b"\n")
            owners.append(i)
    flush()
    return wide, lanes


def as_text(wide: np.ndarray, lanes: np.ndarray) -> list[str]:
    return [w.tobytes().hex() + v.tobytes().hex() for w, v in zip(wide, lanes)]


def likeness(wide_a, lanes_a, wide_b, lanes_b) -> np.ndarray:
    """0..1 for each row: 1 for equal fingerprints, else the cosine of the shingle lanes (0 if negative)."""
    a, b = lanes_a.astype(np.int16).astype(float), lanes_b.astype(np.int16).astype(float)
    norms = np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
    cosine = np.divide((a * b).sum(axis=1), norms, out=np.zeros(len(a)), where=norms > 0)
    equal = (wide_a == wide_b).all(axis=1) & (lanes_a == lanes_b).all(axis=1)
    return np.where(equal, 1.0, np.clip(cosine, 0.0, 1.0))


def _split_edit(text: str, following: str) -> tuple[str, str, str, str]:
    """(shared head, old tail, new tail, edited text). The head ends with a whole paragraph."""
    k = len(text) // 2
    keep = text[:len(text) - k]
    edited = keep + following[:k]
    cut = keep.rfind("\n") + 1
    return keep[:cut], text[cut:], edited[cut:], edited


RESULT = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType())])


def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order within each block; the last row of a block is only the neighbour of the one before."""
    held = None  # (block, own, doc_id, text) of the last row seen

    def results(rows):
        texts = [r[3] for r in rows]
        edits = [_split_edit(a, b) for a, b in zip(texts[:-1], texts[1:])]
        n = len(edits)
        pieces = [e[0] for e in edits] + [e[1] for e in edits] + [e[2] for e in edits] + [texts[-1]]
        wide, lanes = fingerprint_vectors(pieces)
        own_w = np.concatenate((wide[:n] + wide[n:2 * n], wide[3 * n:]))
        own_l = np.concatenate((lanes[:n] + lanes[n:2 * n], lanes[3 * n:]))
        new_w, new_l = wide[:n] + wide[2 * n:3 * n], lanes[:n] + lanes[2 * n:3 * n]
        out = pd.DataFrame({
            "doc_id": [r[2] for r in rows[:-1]],
            "n_chars": [len(t) for t in texts[:-1]],
            "edited_sha256": [hashlib.sha256(e[3].encode("utf-8", "surrogatepass")).hexdigest() for e in edits],
            "fingerprint": as_text(own_w[:-1], own_l[:-1]), "edited_fingerprint": as_text(new_w, new_l),
            "near_edited": likeness(own_w[:-1], own_l[:-1], new_w, new_l),
            "near_next": likeness(own_w[:-1], own_l[:-1], own_w[1:], own_l[1:])})
        same_block = [a[0] == b[0] and a[1] for a, b in zip(rows[:-1], rows[1:])]
        return out[same_block]

    for batch in batches:
        rows = [] if held is None else [held]
        size = len(rows[0][3]) if rows else 0
        for block, own, doc_id, text in zip(batch["block"], batch["own"], batch["doc_id"], batch["text"]):
            rows.append((block, own, doc_id, text or ""))
            size += len(rows[-1][3])
            if size >= 4 * PIECE_BYTES and len(rows) > 1:
                yield results(rows)
                rows, size = rows[-1:], len(rows[-1][3])
        if len(rows) > 1:
            yield results(rows)
        held = rows[-1] if rows else held


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row.

    The edited text replaces the last half of a text's code points by the first as many of the next
    document in descending order of doc_id (null ids last, rows of one id by text; the last is followed
    by the first). Documents are cut at quantiles of doc_id into as many blocks as there are shuffle
    partitions; the first row of each block also goes to the block before, so that every pair of
    neighbours meets in one task and texts move once. The edited fingerprint is the document's, less the
    paragraphs of its old tail, plus those of the new one."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(docs.select("doc_id").approxQuantile(
        "doc_id", [i / blocks for i in range(1, blocks)], 0.1 / blocks)))
    bounds = np.array(bounds, float)

    @F.pandas_udf("int")
    def block_of(ids: pd.Series) -> pd.Series:
        values = ids.astype(float)
        found = len(bounds) - np.searchsorted(bounds, values.to_numpy(), side="right")
        return pd.Series(np.where(values.isna(), len(bounds) + 1, found))

    placed = docs.withColumn("block", block_of("doc_id"))
    # one row per block: which id its first row has, and which block it therefore also goes to
    firsts = (placed.groupBy("block").agg(F.max("doc_id").alias("first_id"))
              .orderBy("block").collect())
    before = {row["block"]: firsts[i - 1]["block"] for i, row in enumerate(firsts)}
    if not firsts:
        return spark.createDataFrame([], RESULT).withColumn("doc_id", F.col("doc_id").cast("long"))
    first_ids = spark.createDataFrame(
        [(r["block"], r["first_id"], before[r["block"]]) for r in firsts],
        "first_block int, first_id long, goes_to int")
    placed = placed.join(
        F.broadcast(first_ids),  # one row per block
        (placed["block"] == first_ids["first_block"]) & placed["doc_id"].eqNullSafe(first_ids["first_id"]), "left")
    placed = placed.select("doc_id", "text", F.explode(F.when(
        F.col("goes_to").isNotNull(),
        F.array(F.struct("block", F.lit(True).alias("own")),
                F.struct(F.col("goes_to").alias("block"), F.lit(False).alias("own"))))
        .otherwise(F.array(F.struct("block", F.lit(True).alias("own"))))).alias("at"))
    placed = placed.select("doc_id", "text", "at.block", "at.own")
    return (placed.repartitionByRange(blocks, "block")
            .sortWithinPartitions("block", F.desc("own"), F.col("doc_id").desc_nulls_last(), "text")
            .withColumn("doc_id", F.col("doc_id").cast("string"))  # pandas has no null in an integer column
            .mapInPandas(_edited, RESULT).withColumn("doc_id", F.col("doc_id").cast("long")))
