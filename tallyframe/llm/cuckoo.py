"""Exact dedup over an index of live digests: cuckoo filters in front of bucketed content.

Texts are equal if they are identical after white space (``[\\x20\\x09-\\x0D]``) is deleted; the digest of a text is
the SHA-256 of what is left. A digest belongs to one of a number of shards that grows with the rows. The index
of a shard is

* a cuckoo filter: buckets of ``SLOTS`` fingerprints of 16 bits, each digest in one of two buckets, where an insertion
  that finds both full moves others to their second bucket;
* the content: the entries by their first bucket, with the whole digest, the number of live rows and the row that stays.

A digest that the filter does not know is new. A hit is verified against the content of its bucket, so a false hit
of the filter is told from a live digest. An insertion that moves ``KICKS`` fingerprints without finding a place
doubles the buckets and builds the filter anew from the stored digests. A digest whose last live row is deleted
leaves filter and content.

``exact_duplicates`` works in three steps, none of which holds a group of copies: each chunk of rows is put into an
index of its own, which leaves one entry per chunk and digest; entries are dealt to the shards and merged in their
index; the rows of a chunk get their answer by the first row of their digest in the chunk. So a text that a third
of all rows share costs one entry per chunk.

``updated_index`` keeps the index as a table between runs and takes batches of insertions and deletions.

Defined results: a null text is an empty one, all empty texts are equal; of equal texts the row with the most code
points stays, then the smallest doc_id, null last, then one of equal rows, always the same for the same files;
repeated rows count each; an empty table gives an empty result; other columns are not read. Long texts are
hashed whole."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.sources.sinks import stored

SLOTS = 4
KICKS = 64
FIRST_BUCKETS = 64
#: Rows for which a shard is made.
SHARD_ROWS = 100_000
SHARDS_AT_LEAST = 16
CHUNK_ROWS = 1 << 13
WHITE_SPACE = b" \t\n\v\f\r"

#: What an entry knows of the row that stays: more code points, smaller doc_id (null last), smaller row.
Best = tuple[int, bool, int, int]


def best_of(chars: int, doc_id: int | None, row: int) -> Best:
    return -chars, doc_id is None, doc_id or 0, row


class CuckooIndex:
    """Live digests (32 bytes) with their number of rows and the best of them."""

    def __init__(self, buckets: int = FIRST_BUCKETS):
        self.digests: list[bytes | None] = []
        self.counts: list[int] = []
        self.best: list[Best] = []
        self.free: list[int] = []
        self.resizes = self.false_hits = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1  # a power of two
        self.slots = array("H", bytes(2 * SLOTS * buckets))  # 0: no fingerprint
        self.content: dict[int, list[int]] = {}

    def __len__(self) -> int:
        return len(self.digests) - len(self.free)

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        """(fingerprint, first bucket, second bucket)"""
        mark = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:8], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995 >> 3) & self.mask)

    def _put(self, bucket: int, mark: int, old: int = 0) -> bool:
        """Write ``mark`` over a slot of the bucket that holds ``old``."""
        for at in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if self.slots[at] == old:
                self.slots[at] = mark
                return True
        return False

    def _settle(self, digest: bytes) -> bool:
        """Give the fingerprint a slot; False if others were moved in vain, which have then lost one."""
        mark, bucket, second = self._place(digest)
        if self._put(bucket, mark) or self._put(second, mark):
            return True
        for kick in range(KICKS):
            at = bucket * SLOTS + (kick + mark) % SLOTS
            mark, self.slots[at] = self.slots[at], mark
            bucket = self._other(bucket, mark)
            if self._put(bucket, mark):
                return True
        return False

    def _rebuild(self, buckets: int) -> None:
        """A filter of so many buckets, or twice, four times, ... as many, from the stored digests."""
        while True:
            self._clear(buckets)
            self.resizes += 1
            live = [i for i, d in enumerate(self.digests) if d is not None]
            if all(self._settle(self.digests[i]) for i in live):
                break
            buckets *= 2
        for i in live:
            self.content.setdefault(self._place(self.digests[i])[1], []).append(i)

    def __contains__(self, digest: bytes) -> bool:
        return self.find(digest) is not None

    def find(self, digest: bytes) -> int | None:
        """The entry of a live digest. Only a hit of the filter looks into the content."""
        mark, first, second = self._place(digest)
        a, b = first * SLOTS, second * SLOTS
        if mark not in self.slots[a:a + SLOTS] and mark not in self.slots[b:b + SLOTS]:
            return None
        for i in self.content.get(first, ()):
            if self.digests[i] == digest:
                return i
        self.false_hits += 1
        return None

    def insert(self, digest: bytes, best: Best, count: int = 1) -> int:
        """Count rows of a digest and keep the best row; returns the entry."""
        i = self.find(digest)
        if i is not None:
            self.counts[i] += count
            self.best[i] = min(self.best[i], best)
            return i
        if self.free:
            i = self.free.pop()
            self.digests[i], self.counts[i], self.best[i] = digest, count, best
        else:
            i = len(self.digests)
            self.digests.append(digest)
            self.counts.append(count)
            self.best.append(best)
        if self._settle(digest):
            self.content.setdefault(self._place(digest)[1], []).append(i)
        else:
            self._rebuild(2 * (self.mask + 1))
        return i

    def delete(self, digest: bytes, count: int = 1) -> bool:
        """Take off so many rows; the digest goes with its last one. False if it is not live."""
        i = self.find(digest)
        if i is None:
            return False
        self.counts[i] -= count
        if self.counts[i] <= 0:
            mark, first, second = self._place(digest)
            if not self._put(first, 0, mark):
                self._put(second, 0, mark)
            self.content[first].remove(i)
            self.digests[i] = None
            self.free.append(i)
        return True

    def live(self) -> Iterator[tuple[bytes, int, Best]]:
        for digest, count, best in zip(self.digests, self.counts, self.best):
            if digest is not None:
                yield digest, count, best

    @classmethod
    def restored(cls, slots: bytes, entries: Iterable[tuple[bytes, int, Best]]) -> "CuckooIndex":
        """The index of a stored filter and its content."""
        out = cls(max(1, len(slots) // (2 * SLOTS)))
        out.slots = array("H", slots)
        for digest, count, best in entries:
            out.content.setdefault(out._place(digest)[1], []).append(len(out.digests))
            out.digests.append(digest)
            out.counts.append(count)
            out.best.append(best)
        return out


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, WHITE_SPACE)


#: lead: the first row of the digest in the chunk, which also carries the chunk's entry (n and best row).
ROW = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("lead", T.LongType()),
    T.StructField("digest", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("best_chars", T.LongType()),
    T.StructField("best_id", T.LongType()), T.StructField("best_row", T.LongType())])


def _chunk_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK_ROWS):
            part = batch.slice(start, CHUNK_ROWS)
            index, leads, rows = CuckooIndex(), {}, []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                text = text.as_py() or ""
                digest = hashlib.sha256(normalised(text)).digest()
                i = index.insert(digest, best_of(len(text), doc_id, row))
                rows.append((row, doc_id, leads.setdefault(i, row), digest, i))
                row += 1
            entries = [(index.counts[i], *index.best[i]) if r == lead else None for r, _, lead, _, i in rows]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            columns += [pa.array([e and f(e) for e in entries], pa.int64()) for f in (
                lambda e: e[0], lambda e: -e[1], lambda e: None if e[2] else e[3], lambda e: e[4])]
            yield pa.RecordBatch.from_arrays(columns, names=ROW.names)


MERGED = T.StructType([
    T.StructField("lead", T.LongType()), T.StructField("keep_id", T.LongType()),
    T.StructField("keep_row", T.LongType()), T.StructField("group_size", T.LongType())])


def _merge_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All entries of a shard: the leads of each digest, with the row that stays."""
    index, leads, entries = CuckooIndex(), array("q"), array("q")
    for batch in batches:
        for lead, digest, n, chars, doc_id, row in zip(*[batch.column(c).to_pylist() for c in (
                "lead", "digest", "n", "best_chars", "best_id", "best_row")]):
            entries.append(index.insert(digest, best_of(chars, doc_id, row), n))
            leads.append(lead)
    for start in range(0, len(leads), 1 << 16):
        own = entries[start:start + (1 << 16)]
        best = [index.best[i] for i in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array(leads[start:start + (1 << 16)], pa.int64()),
             pa.array([None if b[1] else b[2] for b in best], pa.int64()), pa.array([b[3] for b in best], pa.int64()),
             pa.array([index.counts[i] for i in own], pa.int64())], names=MERGED.names)


def _shard(shards: int):
    return F.pmod(F.conv(F.hex(F.substring("digest", 9, 7)), 16, 10).cast("long"), F.lit(shards)).cast("int")


def _entries(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(rows, entries of their chunks, number of shards)"""
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_chunk_entries, ROW))
    entries = rows.where("n is not null")
    shards = max(SHARDS_AT_LEAST, -(-entries.count() // SHARD_ROWS))
    return rows, entries, shards


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, keep_id (of the equal row that stays), group_size, kept, text_sha256 (of the normalised
    text)."""
    rows, entries, shards = _entries(docs)
    merged = entries.repartitionById(shards, _shard(shards)).mapInArrow(_merge_entries, MERGED)
    return rows.select("row", "doc_id", "lead", "digest").join(merged, "lead").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


#: A row with slots is a shard's filter, the others are its content.
INDEX = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("shards", T.IntegerType()),
    T.StructField("slots", T.BinaryType()), T.StructField("digest", T.BinaryType()), T.StructField("n", T.LongType()),
    T.StructField("chars", T.LongType()), T.StructField("doc_id", T.LongType())])


def _changed_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of shards: filter, content, changes; in this order within a shard."""

    def written(shard: int, shards: int, index: CuckooIndex) -> Iterator[pa.RecordBatch]:
        rows = [(shard, shards, index.slots.tobytes(), None, None, None, None)]
        for digest, n, (chars, null, doc_id, _) in index.live():
            rows.append((shard, shards, None, digest, n, -chars, None if null else doc_id))
            if len(rows) >= 1 << 14:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=INDEX.names)

    now, of, index, slots, content = None, 0, None, None, []
    for batch in batches:
        for shard, shards, kind, blob, digest, n, chars, doc_id in zip(*[batch.column(c).to_pylist() for c in (
                "shard", "shards", "kind", "slots", "digest", "n", "chars", "doc_id")]):
            if shard != now:
                if now is not None:
                    yield from written(now, of, index or CuckooIndex.restored(slots, content))
                now, of, index, slots, content = shard, shards, None, bytes(2 * SLOTS * FIRST_BUCKETS), []
            if kind == 0:
                slots = blob
            elif kind == 1:
                content.append((digest, n, best_of(chars, doc_id, 0)))
            else:
                if index is None:
                    index, content = CuckooIndex.restored(slots, content), []
                if kind == 2:
                    index.delete(digest, n)
                else:
                    index.insert(digest, best_of(chars, doc_id, 0), n)
    if now is not None:
        yield from written(now, of, index or CuckooIndex.restored(slots, content))


def updated_index(index: DataFrame | None, inserted: DataFrame | None = None, deleted: DataFrame | None = None,
                  shards: int | None = None) -> DataFrame:
    """The index (INDEX) after documents were deleted from it and others inserted. A deletion takes off a row of its
    text; the doc_id that stays is that of the best row inserted while the text was live. The number of shards is
    set with the first documents."""
    if index is not None and shards is None:
        head = index.select("shards").head()
        shards = head["shards"] if head else None
    parts = []
    for kind, docs in ((2, deleted), (3, inserted)):
        if docs is not None:
            _, entries, wanted = _entries(docs)
            shards = shards or wanted
            parts.append(entries.select(
                _shard(shards).alias("shard"), F.lit(shards).alias("shards"), F.lit(kind).alias("kind"),
                F.lit(None).cast("binary").alias("slots"), "digest", "n", F.col("best_chars").alias("chars"),
                F.col("best_id").alias("doc_id")))
    if index is not None:
        parts.append(index.select("shard", "shards", F.when(F.col("slots").isNotNull(), 0).otherwise(1).alias("kind"),
                                  "slots", "digest", "n", "chars", "doc_id"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "kind").mapInArrow(
        _changed_shard, INDEX)


def live_in(index: DataFrame, docs: DataFrame) -> DataFrame:
    """Per row: doc_id, keep_id of the live row of equal text, or null if the text is new."""
    rows, _, _ = _entries(docs)
    live = index.where("digest is not null").select("digest", F.col("doc_id").alias("keep_id"), F.lit(True).alias("live"))
    leads = rows.where("n is not null").select("lead", "digest").join(live, "digest", "left").drop("digest")
    return rows.select("doc_id", "lead").join(leads, "lead").select(
        "doc_id", "keep_id", F.coalesce("live", F.lit(False)).alias("live"))
