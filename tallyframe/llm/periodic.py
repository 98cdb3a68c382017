"""Periodic runs of words, by string synchronising sets.

A run is a stretch of words with smallest period q, at least ``max(MIN_WORDS, CUBE * q)`` words long, that no
neighbouring word extends keeping that period.

Words become numbers, and the texts of a chunk lie one after the other with a number of its own between them,
so no run crosses texts. Periods up to ``DIRECT`` are found by comparing each word with the one q before: these
are the highly periodic regions that the sets below leave out. For each dyadic scale t = 4, 8, 16, ... then

1. position i has the hash of its t words as identifier; positions whose t words lie in a run of a period of
   t / 3 or less, known from the smaller scales, have none;
2. i is in the synchronising set if the least identifier of i ... i + t is that of i or of i + t. This depends on
   the 2 t words from i only, so equal contexts are selected alike, and any t neighbouring positions hold one of
   the set unless 3 t - 1 words there have a period of t / 3 or less;
3. selected positions with equal contexts of C words (C = 5t, 6t, 7t, 8t), each with the next one of its kind,
   propose their distance as a period if it is in (C - t, C].

A run of period q in (4t, 8t] has a selected position s with q + C words of the run after it, where C is q rounded
up to a multiple of t: near its start, or near the end of the periodic region that it starts with. The context
recurs at s + q, and not before, else the run had a smaller period (C >= q, Fine and Wilf). So every run is
proposed at one scale; proposals are extended word by word, so hashes only choose what is compared.

Defined results: a null text is an empty one without words; rows are judged one by one, so repeated rows, ties
and null doc_ids change nothing; an empty table gives an empty result; other columns are not read. A text is
one row and is handled whole; memory of a task grows with the longest text only."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.hashing import mixed, odd_numbers

MIN_WORDS, CUBE = 24, 3
DIRECT = 16
CHUNK_BYTES = 1 << 21
_LEFT, _RIGHT = odd_numbers(71, 2)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                    T.StructField("period", T.LongType())])
FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two strings written one after the other, from theirs."""
    return mixed(left * _LEFT + mixed(right + _RIGHT))


def _short_periods(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all maximal stretches of a period up to DIRECT, CUBE times as long."""
    out = []
    for q in range(1, min(DIRECT, len(words) - 1) + 1):
        breaks = np.flatnonzero(words[:-q] != words[q:])
        breaks = np.concatenate(([-1], breaks, [len(words) - q]))
        long = np.flatnonzero(np.diff(breaks) - 1 >= (CUBE - 1) * q)
        out += [(int(a) + 1, int(b) + q, q) for a, b in zip(breaks[long], breaks[long + 1])]
    return out


def _regions(runs: list[tuple[int, int, int]], scale: int, n: int) -> np.ndarray | None:
    """Which positions start ``scale`` words of a period of a third of it at most."""
    inside = [(a, b - scale + 1) for a, b, q in runs if CUBE * q <= scale <= b - a]
    if not inside:
        return None
    change = np.zeros(n + 1, np.int32)
    for a, b in inside:
        if a < n:
            change[a] += 1
            change[min(b, n)] -= 1
    return np.cumsum(change[:-1]) > 0


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[:len(values) - (width - have)], values[width - have:]) if have < width else values


def synchronising_set(names: np.ndarray, scale: int, periodic: np.ndarray | None) -> np.ndarray:
    """Selected positions; ``names`` are the hashes of ``scale`` words from each position."""
    if periodic is not None:
        names = np.where(periodic[:len(names)], _NONE, names)
    if len(names) <= scale:
        return np.zeros(0, np.int64)
    least = _window_least(names, scale + 1)
    return np.flatnonzero(((names[:len(least)] == least) | (names[scale:] == least)) & (least != _NONE))


def _proposals(chosen: np.ndarray, context: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) of chosen positions whose next one of equal context is in (low, high] words away."""
    order = np.argsort(context, kind="stable")
    at, key = chosen[order], context[order]
    away = at[1:] - at[:-1]
    use = np.flatnonzero((key[1:] == key[:-1]) & (away > low) & (away <= high))
    return at[use], away[use]


def _reach(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements are equal, compared in growing pieces."""
    at, size, n = 0, 64, min(len(a), len(b))
    while at < n:
        to = min(at + size, n)
        differ = a[at:to] != b[at:to]
        if differ.any():
            return at + int(np.argmax(differ))
        at, size = to, size * 2
    return n


def _extended(words: np.ndarray, at: np.ndarray, periods: np.ndarray) -> list[tuple[int, int, int]]:
    """The maximal stretches around the proposals, each once."""
    out = []
    order = np.lexsort((at, periods))
    at, periods = at[order], periods[order]
    cuts = np.flatnonzero(np.diff(periods)) + 1
    for low, high in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(at)]))):
        q = int(periods[low]) if len(at) else 0
        while low < high:
            s = int(at[low])
            right = s + q + _reach(words[s:], words[s + q:])
            left = s - _reach(words[:s][::-1], words[:s + q][::-1][:s])
            if right - left >= CUBE * q:
                out.append((left, right, q))
            low += max(1, int(np.searchsorted(at[low:high], right - q)))  # those inside are this stretch
    return out


def periodic_stretches(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(start, end, smallest period) rows, sorted, of the maximal stretches of CUBE periods or more.

    ``words`` holds texts of ``lengths`` words, longest first, each followed by a number that occurs once."""
    runs = _short_periods(words)
    ends = np.cumsum(lengths + 1)
    scale = DIRECT // 4
    names = {1: mixed(words.astype(np.uint64) + np.uint64(1))}
    while True:
        # texts too short for three periods of more than 4 * scale words are done
        active = int(np.searchsorted(-lengths, -CUBE * (4 * scale + 1), side="right"))
        if not active:
            break
        n = int(ends[active - 1])
        size = max(names)
        while size < 4 * scale:
            names[2 * size] = _joined(names[size][:-size], names[size][size:])
            size *= 2
        names = {k: v[:max(0, n - k + 1)] for k, v in names.items() if k >= scale}
        one, two, four = (names[k * scale] for k in (1, 2, 4))
        chosen = synchronising_set(one, scale, _regions(runs, scale, n))
        chosen = chosen[chosen + 5 * scale <= n]
        found = []
        for times in (5, 6, 7, 8):
            chosen = chosen[chosen + times * scale <= n]
            rest = chosen + 4 * scale
            if times == 5:
                context = _joined(four[chosen], one[rest])
            elif times == 6:
                context = _joined(four[chosen], two[rest])
            elif times == 7:
                context = _joined(_joined(four[chosen], two[rest]), one[rest + 2 * scale])
            else:
                context = _joined(four[chosen], four[rest])
            found.append(_proposals(chosen, context, (times - 1) * scale, times * scale))
        at, periods = (np.concatenate(x) for x in zip(*found))
        if len(at):
            runs += _extended(words, at, periods)
        scale *= 2
    if not runs:
        return np.zeros((0, 3), np.int64)
    table = np.array(sorted(runs), np.int64)  # of the periods of one stretch the smallest comes first
    return table[np.concatenate(([True], (np.diff(table[:, :2], axis=0) != 0).any(axis=1)))]


def runs_of_texts(texts: list[list[bytes]]) -> list[np.ndarray]:
    """For each list of words its runs, rows (start, length, period) by start and period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order], np.int64)
    flat = [w for i in order for w in texts[i]]
    codes, values = pd.factorize(np.array(flat, dtype=object)) if flat else (np.zeros(0, np.int64), [])
    ends = np.cumsum(lengths + 1)
    words = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    between = ends - 1
    own = np.ones(len(words), bool)
    own[between] = False
    words[own] = codes
    words[between] = len(values) + np.arange(len(between))
    table = periodic_stretches(words, lengths)
    table = table[table[:, 1] - table[:, 0] >= MIN_WORDS]
    text = np.searchsorted(ends, table[:, 0], side="right")
    table = np.stack((table[:, 0] - (ends - lengths - 1)[text], table[:, 1] - table[:, 0], table[:, 2]), axis=1)
    cuts = np.searchsorted(text, np.arange(len(order) + 1))
    out: list = [None] * len(texts)
    for k, i in enumerate(order):
        mine = table[cuts[k]:cuts[k + 1]]
        out[i] = mine[np.lexsort((mine[:, 2], mine[:, 0]))]
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


def periodic_runs(docs: DataFrame, edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per row: doc_id, n_words, runs (start, length, period; by start, then period), collapsed (the text without
    what runs repeat). ``edit`` may change the words of a text beforehand."""

    def judged(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = runs_of_texts(texts)
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
        flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
        fields = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)],
                                            names=RUN.names)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets), fields),
             pa.array([collapsed(t, r) for t, r in zip(texts, runs)], pa.binary()).cast(pa.string())],
            names=FOUND.names)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                words = data.split()  # on space, tab, line feed, VT, FF and CR
                ids.append(doc_id.as_py())
                texts.append(edit(ids[-1], words) if edit else words)
                size += len(data)
                if size >= CHUNK_BYTES:
                    yield judged(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield judged(ids, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(found, FOUND)


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The planted repetition of one text in ten: from some word on, a stretch of words over and over."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli of the run of greatest exponent (ties: smallest start,
    then period), runs_sha256, collapsed_sha256."""
    runs = F.col("runs")
    # kept if its exponent is at least the other's; runs come by start and period, so the first of equals stays
    best = F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, F.lit(0)), lambda a, b: F.when(
        a["length"] * b["period"] >= b["length"] * a["period"], a).otherwise(b))
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                    r["period"].cast("string")))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))
    return (found.select("doc_id", "runs", "collapsed", best.alias("best"))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.floor(F.expr("1000 * best.length div best.period")).alias("exponent_milli"),
                    F.sha2(text, 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256")))
