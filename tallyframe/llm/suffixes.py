"""Suffix-array dedup: repeated byte strings over all documents, by bucket-pointer refinement.

Every string of ``LENGTH`` bytes holds ``LENGTH - GRAM + 1`` grams; its anchor is the one with the least
hash (the leftmost of equals), which depends on the string alone. So equal strings meet in the initial
bucket of their anchor's gram, and a document sends one entry per anchor instead of one per byte. The entry
holds the stretch of starts the anchor stands for and a hash of all bytes they cover: in a bucket, a
stretch whose hash also occurs in a smaller document is settled at once. Entries travel in columnar blocks,
some per task and partition of the grams; partitions grow with the bytes of the input.

No task holds all entries of a common passage: a task settles the stretches of its own block first, so that
of one stretch only the least document of each block travels as an entry, and deals grams that are still
crowded in its block out by gram and cover, leaving a mark where the gram belongs, so that the rest of the
bucket is refined with them. Grams with more stretches to refine than one task should hold are refined as
strings: the least document of each is an aggregate combined map-side, joined back.

Stretches that share only the gram are refined: their bytes are fetched, and the starts of a bucket are
sorted by the identifier of the q-gram bucket (q = 8) at offset 0, then at 8, at 16 and so on. Each round
sorts on the identifiers the round before has assigned, and starts alone in their bucket drop out, until
LENGTH bytes are told apart.

Defined results: a null text is an empty one; texts shorter than LENGTH lose nothing; rows with a null
doc_id have no order, so they lose nothing and nothing is lost for them; rows of one doc_id do not count as
smaller than each other; empty tables give empty results; other columns are not read. Long texts are
read in pieces of bounded size that overlap."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyframe.llm.hashing import byte_table, mixed, odd_numbers, powers, prefix_sums
from tallyframe.sources.sinks import stored

LENGTH = 50
GRAM = 16
PIECE = 1 << 20
_BYTES = byte_table(61)
_ROW = odd_numbers(67, 2)
_AT_BITS = np.uint64((1 << 24) - 1)
REFINED_ROWS = 60_000
PART_BYTES = 32 << 20
#: Entries of a partition that are unpacked and sorted at once, those of one gram apart.
RANGE_ENTRIES = 1 << 17
#: Unsettled entries of one gram that a block sends to the gram's partition.
CROWD = 64

BLOCK = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("block", T.BinaryType())])
BLOCK_ANCHORS = 1 << 19
#: Columns of a block and how many bytes of each number travel, from the low end. Grams need no more than
#: tells most of them apart, covers are told apart within their gram.
ENTRY = {"gram": 5, "cover": 6, "row": 4, "start": 5, "ahead": 1, "n": 1}
ROWS = {"doc_id": 8, "tag": 8}
#: Kinds of blocks: entries of whole grams, entries of crowded grams, and stretches settled in their block.
WHOLE, CROWDED, SETTLED = range(3)
SETTLED_ENTRY = {"row": 4, "start": 5, "n": 1}
_LAST = np.iinfo(np.int64).max


def _tag(data: bytes) -> int:
    """Tells rows of one doc_id apart."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _windows_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(out) - (width - have)], out[width - have:]) if width > have else out


def anchor_stretches(blob: np.ndarray, doc_ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(gram hash, cover hash, first start, anchor, number of starts) of all strings of LENGTH bytes that lie
    within one document of the concatenation ``blob``; at most 2**24 bytes."""
    up, down = powers(len(blob) + 1)
    sums = prefix_sums(blob, _BYTES, up)
    n = len(blob) - GRAM + 1
    gram = mixed((sums[GRAM:] - sums[:n]) * down[:n])
    ranked = (gram & ~_AT_BITS) | np.arange(n, dtype=np.uint64)
    least = _windows_min(ranked, LENGTH - GRAM + 1)  # one per start of a string
    anchor = (least & _AT_BITS).astype(np.int64)
    starts = np.arange(len(least))
    doc = np.searchsorted(doc_ends, starts, side="right")
    valid = starts + LENGTH <= doc_ends[doc]
    cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(doc) != 0) | (np.diff(valid.astype(np.int8)) != 0)) + 1
    first = np.concatenate(([0], cut))
    last = np.concatenate((cut, [len(least)])) - 1
    use = valid[first]
    first, last = first[use], last[use]
    at = anchor[first]
    covered = (sums[last + LENGTH] - sums[first]) * down[first]
    shape = ((at - first) * (LENGTH + 1) + (last - first)).astype(np.uint64)
    cover = mixed(covered * _ROW[0] + shape * _ROW[1])
    return gram[at], cover, first, at, last - first + 1


def _pieces(batches: Iterator[pa.RecordBatch]):
    """Lists of (doc_id, tag, offset, bytes) of about PIECE bytes; a long text is cut, overlapping by
    LENGTH - 1, so that each string lies in one piece."""
    held, size = [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            data = (text or "").encode("utf-8", "surrogatepass")
            if doc_id is None or len(data) < LENGTH:
                continue
            tag = _tag(data)
            for offset in range(0, len(data) - LENGTH + 1, PIECE):
                held.append((doc_id, tag, offset, data[offset:offset + PIECE + LENGTH - 1]))
                size += len(held[-1][3])
                if size >= PIECE:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def _pack(columns: dict[str, np.ndarray], widths: dict[str, int]) -> bytes:
    """Byte planes of the columns: bytes of equal weight lie together, so that they compress."""
    return b"".join([np.ascontiguousarray(columns[c].astype("<i8").view(np.uint8).reshape(-1, 8)[:, :w].T).tobytes()
                     for c, w in widths.items()])


def _unpack(data: np.ndarray, n: int, widths: dict[str, int], names: tuple[str, ...] = (),
            use: np.ndarray | slice = slice(None)) -> dict[str, np.ndarray]:
    """Columns (all, or those named) of the entries (all, or those in use) of a block."""
    out, at = {}, 0
    for c, w in widths.items():
        if not names or c in names:
            planes = data[at:at + n * w].reshape(w, n)[:, use]
            wide = np.zeros((planes.shape[1], 8), np.uint8)
            wide[:, :w] = planes.T
            out[c] = wide.view("<i8")[:, 0]
        at += n * w
    return out


def _later(cover: np.ndarray, gram: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which entries have a smaller document under the same cover and gram."""
    order = np.argsort(cover, kind="stable")
    key = cover[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    key = gram[order]
    new[1:] |= key[1:] != key[:-1]
    key = doc[order]
    least = np.minimum.reduceat(key, np.flatnonzero(new))
    out = np.empty(len(order), bool)
    out[order] = key > least[np.cumsum(new) - 1]
    return out


def _crowds(gram: np.ndarray, crowd: int) -> np.ndarray:
    """The grams that occur more than ``crowd`` times, ascending."""
    gram = np.sort(gram)
    heads = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1]))[:len(gram)])
    return gram[heads[np.diff(heads, append=len(gram)) > crowd]]


def _among(gram: np.ndarray, grams: np.ndarray) -> np.ndarray:
    if not len(grams):
        return np.zeros(len(gram), bool)
    return grams[np.minimum(np.searchsorted(grams, gram), len(grams) - 1)] == gram


def _anchors(parts: int, crowd: int = CROWD):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        docs: list[tuple[int, int]] = []
        count = 0

        def emit():
            lists = list(zip(*found))
            found.clear()
            gram, cover, row, start, ahead, n = (np.concatenate(lists.pop(0)) for _ in range(6))
            doc_id, tag = np.array(docs, np.int64).T
            settled = _later(cover, gram, doc_id[row])
            crowds = _crowds(gram[~settled], crowd)
            crowded = ~settled & _among(gram, crowds)
            low = np.uint64((1 << 40) - 1)
            mark_part = (crowds % np.uint64(parts)).astype(np.int64)
            keys, blobs = [], []
            for kind, chosen, widths in ((WHOLE, ~settled & ~crowded, ENTRY), (CROWDED, crowded, ENTRY),
                                         (SETTLED, settled, SETTLED_ENTRY)):
                chosen = np.flatnonzero(chosen)
                if kind == WHOLE:
                    part = gram[chosen]
                elif kind == CROWDED:
                    part = mixed(gram[chosen] ^ cover[chosen])
                else:  # in runs, from a place of the block's own
                    part = gram[0] % np.uint64(parts) + (np.arange(len(chosen), dtype=np.uint64) >> np.uint64(12))
                part = (part % np.uint64(parts)).astype(np.int32)
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                chosen = chosen[order]
                marked = set(mark_part.tolist()) if kind == WHOLE else set()
                for p in sorted(marked | set(np.flatnonzero(np.diff(cuts)).tolist())):
                    use = chosen[cuts[p]:cuts[p + 1]]
                    marks = crowds[mark_part == p] if p in marked else crowds[:0]
                    rows, at = np.unique(row[use], return_inverse=True)
                    rows = rows if len(rows) else row[:1]
                    entry = {"gram": np.concatenate((gram[use], marks)) & low, "cover": cover[use] >> np.uint64(16),
                             "row": at, "start": start[use], "ahead": ahead[use], "n": n[use]}
                    entry = {c: np.concatenate((entry[c], np.zeros(len(marks), entry[c].dtype))) if c != "gram" else entry[c]
                             for c in widths}
                    keys.append(p)
                    blobs.append(np.array([len(use) + len(marks), len(rows), kind], "<i8").tobytes()
                                 + _pack(entry, widths) + _pack({"doc_id": doc_id[rows], "tag": tag[rows]}, ROWS))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())],
                                              names=BLOCK.names)

        for held in _pieces(batches):
            sizes = np.array([len(p[3]) for p in held])
            ends = np.cumsum(sizes)
            blob = np.frombuffer(b"".join(p[3] for p in held), np.uint8)
            gram, cover, first, at, n = anchor_stretches(blob, ends)
            doc = np.searchsorted(ends, first, side="right")
            shift = np.array([p[2] for p in held]) - (ends - sizes)
            found.append((gram, cover, doc + len(docs), first + shift[doc], at - first, n))
            docs += [p[:2] for p in held]
            count += len(gram)
            if count >= BLOCK_ANCHORS:
                yield emit()
                found, docs, count = [], [], 0
        if count:
            yield emit()

    return blocks


JUDGED = T.StructType([
    T.StructField("gram", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("tag", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("ahead", T.IntegerType()),
    T.StructField("n", T.IntegerType()), T.StructField("many", T.IntegerType()),
    T.StructField("settled", T.BooleanType())])


class _Packed:
    """Blocks of entries of one kind as they came, unpacked for a range of grams at a time."""

    def __init__(self):
        self.blocks: list[tuple[np.ndarray, int, dict[str, np.ndarray]]] = []
        self.entries = 0

    def add(self, data: np.ndarray, n: int, of: dict[str, np.ndarray]) -> None:
        self.blocks.append((data, n, of))
        self.entries += n

    def ranges(self, entries: int) -> Iterator[dict[str, np.ndarray]]:
        """All entries, about so many at once, those of a gram together."""
        count = max(1, -(-self.entries // entries))
        # the partition has taken the low part of the hash, so ranges are dealt by a mixture of it
        own = [(mixed(_unpack(data, n, ENTRY, ("gram",))["gram"].view(np.uint64)) % np.uint64(count)).astype(np.uint16)
               for data, n, _ in self.blocks] if count > 1 else None
        for k in range(count):
            parts = []
            for i, (data, n, of) in enumerate(self.blocks):
                entry = _unpack(data, n, ENTRY, (), slice(None) if own is None else np.flatnonzero(own[i] == k))
                row = entry.pop("row")
                entry |= {"doc_id": of["doc_id"][row], "tag": of["tag"][row]}
                entry["doc_id"][entry["n"] == 0] = _LAST  # a mark, smaller than nothing
                for c in ("ahead", "n"):
                    entry[c] = entry[c].astype(np.int8)
                parts.append(entry)
            yield {c: np.concatenate([x.pop(c) for x in parts]) for c in list(parts[0])}


def _judge(batches: Iterator[pa.RecordBatch], many_from: int) -> Iterator[pa.RecordBatch]:
    """All entries of a partition, a range of its grams at a time. Stretches whose bytes also occur in a smaller
    document are settled; others are to be refined if their bucket is crowded or holds several covers and
    documents. Of at least ``many_from`` such entries of a gram, the first has their number in ``many``."""
    arrow = to_arrow_schema(JUDGED)

    def judged(col: dict[str, np.ndarray], use: np.ndarray, settled: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(use), 1 << 16):
            part_use = use[at:at + (1 << 16)]
            columns = [pa.array(col[f.name][part_use].astype(f.type.to_pandas_dtype())) for f in list(arrow)[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(settled[at:at + (1 << 16)])], schema=arrow)

    held: dict[tuple[int, int], _Packed] = {}
    for batch in batches:
        for part, blob in zip(batch.column("part").to_pylist(), batch.column("block")):
            data = np.frombuffer(blob.as_buffer(), np.uint8)
            n, rows, kind = (int(x) for x in data[:24].view("<i8"))
            widths = SETTLED_ENTRY if kind == SETTLED else ENTRY
            of = _unpack(data[24 + n * sum(widths.values()):], rows, ROWS)
            if kind == SETTLED:
                entry = _unpack(data[24:], n, widths)
                row = entry.pop("row")
                entry |= {"doc_id": of["doc_id"][row], "tag": of["tag"][row]}
                none = np.zeros(n, np.int8)
                yield from judged({**entry, "gram": none, "ahead": none, "many": none}, np.arange(n), np.ones(n, bool))
            else:
                own = data[24:24 + n * sum(widths.values())].copy()  # not the whole batch
                held.setdefault((part, kind), _Packed()).add(own, n, of)
    for part, kind in list(held):
        packed = held.pop((part, kind))
        for col in packed.ranges(RANGE_ENTRIES):
            if not len(col["gram"]):
                continue
            order = np.lexsort((col["doc_id"], col["cover"], col["gram"]))
            gram, cover, doc = (col[c][order] for c in ("gram", "cover", "doc_id"))
            new_gram = np.concatenate(([True], gram[1:] != gram[:-1]))
            new_cover = new_gram | np.concatenate(([True], cover[1:] != cover[:-1]))
            heads, covers = np.flatnonzero(new_gram), np.flatnonzero(new_cover)
            bucket, group = np.cumsum(new_gram) - 1, np.cumsum(new_cover) - 1
            low, high = np.minimum.reduceat(doc, heads), np.maximum.reduceat(doc, heads)
            several = np.add.reduceat(new_cover.astype(np.int64), heads) > 1
            mark = col["n"][order] == 0
            open_bucket = (low < high) & several | np.logical_or.reduceat(mark, heads)
            settled = doc > doc[covers][group]
            keep = ~mark & (settled | open_bucket[bucket] | (kind == CROWDED))
            use = np.flatnonzero(keep & ~settled)
            first = np.flatnonzero(np.diff(bucket[use], prepend=-1))
            sizes = np.diff(first, append=len(use))
            col["many"] = np.zeros(len(order), np.int32)
            col["many"][order[use[first]]] = np.where(sizes >= many_from, sizes, 0)
            yield from judged(col, order[keep], settled[keep])


STRETCH = ("gram", "tag", "start", "ahead", "n")
OPEN = T.StructType([
    T.StructField("gram", T.LongType()), T.StructField("doc_id", T.LongType()),
    T.StructField("tag", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("ahead", T.IntegerType()), T.StructField("bytes", T.BinaryType())])


def _fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        columns: list[list] = [[] for _ in OPEN.fields]
        for doc_id, text, *lists in zip(batch["doc_id"], batch["text"], *[batch[f"{c}s"] for c in STRETCH]):
            data = (text or "").encode("utf-8", "surrogatepass")
            gram, tag, start, ahead, n = (np.asarray(x) for x in lists)
            use = np.flatnonzero(tag == _tag(data))
            if len(use):
                found = [data[s:s + k + LENGTH - 1] for s, k in zip(start[use], n[use])]
                for into, values in zip(columns, (gram[use], np.full(len(use), doc_id, np.int64), tag[use],
                                                  start[use], ahead[use], found)):
                    into.append(values)
        if columns[0]:
            blobs = [x for found in columns.pop() for x in found]
            out = pd.DataFrame({f.name: np.concatenate(c) for f, c in zip(OPEN.fields, columns)})
            out["bytes"] = blobs
            yield out


def refine(strings: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Identifiers of the rows of ``strings`` (n x LENGTH bytes) such that rows are equal, bucket included,
    if and only if their identifiers are: bucket-pointer refinement. -1: alone in its bucket."""

    def ids(*keys: np.ndarray) -> np.ndarray:
        order = np.lexsort(keys)
        new = np.zeros(len(order), bool)
        new[:1] = True
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(new) - 1
        return out

    out = np.full(len(strings), -1, np.int64)
    alive = np.arange(len(strings))
    ident = ids(bucket)
    for offset in (0, 8, 16, 24, 32, LENGTH - 16, LENGTH - 8):
        here = np.ascontiguousarray(strings[alive, offset:offset + 8]).view(np.uint64)[:, 0]
        ident = ids(here, ident)  # the bucket so far, refined by the bucket of a later offset
        several = np.bincount(ident)[ident] > 1
        alive, ident = alive[several], ident[several]
        if not len(alive):
            return out
    out[alive] = ident
    return out


DUPLICATE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("tag", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("n", T.IntegerType())])


def _refine_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by gram. Yields the starts whose string also occurs in a smaller document."""

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        gram, doc = rows["gram"].to_numpy(), rows["doc_id"].to_numpy()
        ahead, blobs = rows["ahead"].to_numpy(), rows["bytes"].to_numpy()
        sizes = np.array([len(b) for b in blobs])
        begin = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(blobs), np.uint8)
        strings = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
        row = np.repeat(np.arange(len(rows)), sizes - LENGTH + 1)
        step = np.arange(len(row)) - np.repeat(np.cumsum(sizes - LENGTH + 1) - (sizes - LENGTH + 1), sizes - LENGTH + 1)
        place = ahead[row] - step  # of the anchor in the string: equal in equal strings
        out = []
        for x in range(LENGTH - GRAM + 1):
            mine = np.flatnonzero(place == x)
            if not len(mine):
                continue
            at = begin[row[mine]] + step[mine]
            ident = refine(strings[at], gram[row[mine]])
            mine, ident = mine[ident >= 0], ident[ident >= 0]
            if not len(mine):
                continue
            order = np.lexsort((doc[row[mine]], ident))
            head = np.concatenate(([True], ident[order][1:] != ident[order][:-1]))
            least = doc[row[mine]][order][np.flatnonzero(head)][np.cumsum(head) - 1]
            out.append(mine[order][doc[row[mine]][order] > least])
        found = np.sort(np.concatenate(out)) if out else np.zeros(0, np.int64)
        source = rows.iloc[row[found]]
        return pd.DataFrame({"doc_id": source["doc_id"].to_numpy(), "tag": source["tag"].to_numpy(),
                             "start": source["start"].to_numpy() + step[found],
                             "n": np.ones(len(found), np.int32)})

    held, count = [], 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        count += len(batch)
        if count < REFINED_ROWS:
            continue
        rows = pd.concat(held, ignore_index=True) if len(held) > 1 else batch
        gram = rows["gram"].to_numpy()
        last = int(np.searchsorted(gram, gram[-1], side="left"))
        held, count = [rows.iloc[last:]], len(rows) - last
        if last:
            yield judge(rows.iloc[:last].reset_index(drop=True))
    if held and count:
        yield judge(pd.concat(held, ignore_index=True))


STRING = T.StructType([
    T.StructField("string", T.BinaryType()), T.StructField("doc_id", T.LongType()),
    T.StructField("tag", T.LongType()), T.StructField("start", T.LongType())])


def _strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 1000):
            rows = batch.iloc[at:at + 1000]
            found = [(b[x:x + LENGTH], d, t, s + x) for d, t, s, b in zip(rows["doc_id"], rows["tag"], rows["start"],
                     rows["bytes"]) for x in range(len(b) - LENGTH + 1)]
            yield pd.DataFrame(found, columns=STRING.names)


def _refined_as_strings(opened: DataFrame) -> DataFrame:
    """(doc_id, tag, start, n) of the starts whose string also occurs in a smaller document."""
    strings = stored(opened.mapInPandas(_strings, STRING))
    least = strings.groupBy("string").agg(F.min("doc_id").alias("least"))
    return (strings.join(least, "string").where("doc_id > least")
            .select("doc_id", "tag", "start", F.lit(1).alias("n")))


def _partitions(docs: DataFrame, part_bytes: int) -> int:
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes))


def duplicate_strings(docs: DataFrame, part_bytes: int = PART_BYTES, crowd: int = CROWD,
                      refined_rows: int = REFINED_ROWS) -> DataFrame:
    """(doc_id, tag, start, n): n neighbouring starts of strings of LENGTH bytes that also start in a
    document of smaller doc_id. ``docs`` has doc_id long and text."""
    partitions = _partitions(docs, part_bytes)
    # smaller numbers cannot add up to half of refined_rows over all partitions
    many_from = max(1, refined_rows // (2 * (partitions + 1)))
    judged = stored(docs.mapInArrow(_anchors(partitions, crowd), BLOCK).repartitionById(partitions, F.col("part"))
                    .mapInArrow(lambda batches: _judge(batches, many_from), JUDGED))
    unsettled = judged.where("not settled")
    large = stored(judged.where("many > 0").groupBy("gram").agg(F.sum("many").alias("many"))
                   .where(F.col("many") > refined_rows // 2).select("gram"))

    def opened(stretches: DataFrame) -> DataFrame:
        wanted = stretches.groupBy("doc_id").agg(*[F.collect_list(c).alias(f"{c}s") for c in STRETCH])
        return docs.join(wanted.hint("merge"), "doc_id").mapInPandas(_fetch, OPEN)

    found = judged.where("settled").select("doc_id", "tag", "start", "n")
    if large.isEmpty():
        small = unsettled
    else:
        small = unsettled.join(large, "gram", "left_anti")
        found = found.unionByName(_refined_as_strings(opened(unsettled.join(large, "gram", "left_semi"))))
    refined = (opened(small).repartition(partitions, "gram").sortWithinPartitions("gram")
               .mapInPandas(_refine_buckets, DUPLICATE))
    return found.unionByName(refined)


REMOVED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
    T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
    T.StructField("kept", T.BinaryType())])


def _cut(data: bytes, starts: np.ndarray, ns: np.ndarray) -> tuple[int, int, bytes]:
    """(removed bytes, maximal removed runs, remaining bytes)."""
    change = np.zeros(len(data) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + ns + LENGTH - 1, -1)
    gone = np.cumsum(change[:-1]) > 0
    spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, np.frombuffer(data, np.uint8)[~gone].tobytes()


def without_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the remaining bytes, which
    may cut a character; or, with ``digest``, kept_sha256)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # with the same filter, the texts are dealt out by doc_id once for both joins
    ordered, unordered = docs.where("doc_id is not null"), docs.where("doc_id is null")
    found = (duplicate_strings(ordered).groupBy("doc_id")
             .agg(*[F.collect_list(c).alias(f"{c}s") for c in ("tag", "start", "n")]))
    found = ordered.join(found.hint("merge"), "doc_id", "left")
    found = found.unionByName(unordered, allowMissingColumns=True)
    fields = REMOVED.fields if not digest else [*REMOVED.fields[:-1], T.StructField("kept_sha256", T.StringType())]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, tags, starts, ns in zip(batch["text"], batch["tags"], batch["starts"], batch["ns"]):
                data = (text or "").encode("utf-8", "surrogatepass")
                removed, spans, kept = 0, 0, data
                if tags is not None:
                    use = np.asarray(tags) == _tag(data)
                    removed, spans, kept = _cut(data, np.asarray(starts)[use], np.asarray(ns)[use])
                out.append((len(data), removed, spans, hashlib.sha256(kept).hexdigest() if digest else kept))
            result = pd.DataFrame(out, columns=[f.name for f in fields[1:]])
            result.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield result

    named = [T.StructField("doc_id", T.StringType()), *fields[1:]]  # pandas has no null in an integer column
    return (found.withColumn("doc_id", F.col("doc_id").cast("string"))
            .mapInPandas(cut, T.StructType(named)).withColumn("doc_id", F.col("doc_id").cast("long")))
