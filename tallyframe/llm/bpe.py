"""BPE encoding and decoding with a pair occurrence index.

The vocabulary file (a public one, its path is a parameter) names merges by rank. Text is cut at white
space into chunks; what a chunk encodes to depends on the chunk alone, so each distinct chunk of a batch is
encoded once. All new words are laid out in one symbol array with links to the neighbours; an index maps
each pair to all its positions; the active ranks are applied in ascending order, all positions at once,
and the lists of the pairs that appear are updated. Decoding maps identifiers back to their tokens.

Defined results: a null text is an empty one and has no tokens; special tokens are recognised in the text,
as the library does; texts of any length are encoded whole; repeated rows stay; an empty table gives an
empty result."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Characters of chunks that are remembered, and of texts that are learned and encoded together.
CACHE_CHARS = 1 << 21
BATCH_CHARS = 1 << 21
OUTPUT_CHUNKS = 1 << 17
# White space of Unicode, and the control characters that Python's split takes as well
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_MORE_SPACE = re.compile("[\x1c-\x1f]")
# Fixed value: the pattern of the vocabulary file, used where the file's own is the same
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable Latin-1 for itself, the rest from 256 up."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Identifiers, merges by rank, and special tokens of a word-end BPE file."""

    def __init__(self, text: str):
        import regex

        spec = json.loads(text)
        model = spec["model"]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        if pattern != _WORDS or model["end_of_word_suffix"] != "</w>":
            raise ValueError("not a vocabulary of the supported kind")
        vocab = model["vocab"]
        self.words = regex.compile(pattern)
        self.words_and_gaps = regex.compile(pattern + "| ")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        # each token's text with a space behind it, all in a row
        spaced = [(t + " ").encode() for t in self.tokens]
        self.text = np.frombuffer(b"".join(spaced), np.uint8)
        self.text_sizes = np.array([len(t) for t in spaced])
        self.text_starts = np.cumsum(self.text_sizes) - self.text_sizes
        letters = _byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.final = np.array([vocab[x + "</w>"] for x in letters], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        pairs = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.left, self.right = pairs >> 32, pairs & 0xFFFFFFFF  # by rank
        self.ranks = np.argsort(pairs, kind="stable")
        self.pairs = pairs[self.ranks]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it does not merge."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where((self.pairs[at] == keys) & (left >= 0) & (right >= 0), self.ranks[at], -1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of all words (their UTF-8 bytes) in a row, and where each word's begin and the last
        ends: merges by ascending rank over all words at once."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        sizes = np.array([len(w) for w in words])
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(words), np.uint8)
        n = len(data)
        # symbol n is a wall that merges with nothing; walls also stand before and after each word
        symbol = np.append(self.inner[data], -1)
        symbol[ends - 1] = self.final[data[ends - 1]]
        after = np.arange(1, n + 2)
        after[n] = n
        after[ends - 1] = n
        before = np.arange(-1, n)
        before[ends - sizes] = n
        before = np.append(before, n)[:n + 1]
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def post(at: np.ndarray) -> None:
            """Add positions to the lists of the pairs that start there."""
            if not len(at):
                return
            rank = self.rank_of(symbol[at], symbol[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            heads = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1])))
            for r, part in zip(rank[heads].tolist(), np.split(at, heads[1:])):
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(part)

        post(np.arange(n))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            at = np.sort(at[(symbol[at] == self.left[r]) & (symbol[after[at]] == self.right[r])])
            if not len(at):
                continue
            at = at[np.concatenate(([True], at[1:] != at[:-1]))]
            chained = after[at[:-1]] == at[1:]  # overlapping occurrences of one symbol twice: every other one
            if chained.any():
                run = np.concatenate(([True], ~chained))
                step = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
                at = at[step % 2 == 0]
            gone = after[at]
            symbol[at] = self.merged[r]
            symbol[gone] = -1
            follow = after[gone]
            after[at] = follow
            real = follow < n
            before[follow[real]] = at[real]
            left = before[at]
            post(np.concatenate((at, left[left < n])))
        left = np.flatnonzero(symbol[:n] >= 0)
        return symbol[left], np.searchsorted(left, np.concatenate(([0], ends)))


def _plain(text: str) -> str:
    # lower-cased letter by letter: a final sigma like any other
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start .. start + size - 1 of each range, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Encodes texts; remembers the words and chunks it has seen, a bounded number of them."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        """Words and chunks by number; the identifiers of all words, and of all chunks, in a row."""
        self.words: dict[str | int, int] = {" ": -1}
        self.word_ids, self.word_cuts = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.known: dict[str, int] = {}
        self.chars = 0
        self.ids, self.cuts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    @staticmethod
    def chunks(text: str) -> list[str]:
        if _MORE_SPACE.search(text):
            return [c for c in _SPACE.split(text) if c]
        return text.split()

    def _words_of(self, chunks: list[str]) -> list[str | int]:
        """Words of the chunks, special tokens as identifiers, with " " after each chunk."""
        special = self.vocabulary.special
        out: list[str | int] = []
        marked = [c for c in chunks if "<" in c and any(t in c for t in special)]
        if marked:
            rest = set(marked)
            chunks[:] = [c for c in chunks if c not in rest] + marked
            for chunk in marked:
                for part in self.vocabulary.split_special.split(chunk):
                    out += [special[part]] if part in special else self.vocabulary.words.findall(_plain(part))
                out.append(" ")
        plain = " ".join(chunks[:len(chunks) - len(marked)])
        return (self.vocabulary.words_and_gaps.findall(_plain(plain)) + [" "] if plain else []) + out

    def learn(self, chunks: set[str]) -> None:
        if self.chars > CACHE_CHARS:
            self.forget()
        new = [c for c in chunks if c not in self.known]
        self.chars += sum(map(len, new))
        if not new:
            return
        found = self._words_of(new)
        missing = [w for w in set(found) if w not in self.words]
        plain = [w for w in missing if w.__class__ is str]
        ids, cuts = self.vocabulary.encode_words([w.encode("utf-8", "surrogatepass") for w in plain])
        marks = [w for w in missing if w.__class__ is int]
        ids = np.concatenate((ids, np.array(marks, np.int64))).astype(np.uint32)
        cuts = np.concatenate((cuts, cuts[-1] + 1 + np.arange(len(marks))))
        self.words.update(zip(plain + marks, range(len(self.words) - 1, len(self.words) + len(missing))))
        self.word_cuts = np.concatenate((self.word_cuts, self.word_cuts[-1] + cuts[1:]))
        self.word_ids = np.concatenate((self.word_ids, ids))
        at = np.fromiter(map(self.words.__getitem__, found), np.int64, len(found))
        gaps = np.flatnonzero(at < 0)
        sizes = np.where(at < 0, 0, (self.word_cuts[1:] - self.word_cuts[:-1])[at])
        ends = np.cumsum(sizes)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.cuts = np.concatenate((self.cuts, self.cuts[-1] + ends[gaps]))
        self.ids = np.concatenate((self.ids, self.word_ids[_ranges(self.word_cuts[:-1][at], sizes)]))

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """(identifiers as little-endian unsigned 32-bit integers, decoded text) of each text."""
        split = [self.chunks(t) for t in texts]
        self.learn(set().union(*split))
        start = 0
        while start < len(split):
            stop, size = start, 0
            while stop < len(split) and (stop == start or size < OUTPUT_CHUNKS):
                size += len(split[stop])
                stop += 1
            yield from self._assemble(split[start:stop])
            start = stop

    def _assemble(self, split: list[list[str]]) -> Iterator[tuple[bytes, str]]:
        sizes = [len(c) for c in split]
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, sum(sizes))
        lengths = self.cuts[at + 1] - self.cuts[at]
        ids = self.ids[_ranges(self.cuts[at], lengths)]
        doc_cuts = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(sizes)))]
        widths = self.vocabulary.text_sizes[ids]
        text = self.vocabulary.text[_ranges(self.vocabulary.text_starts[ids], widths)].tobytes()
        text_cuts = np.concatenate(([0], np.cumsum(widths)))[doc_cuts].tolist()
        packed, doc_cuts = ids.astype("<u4").tobytes(), doc_cuts.tolist()
        for a, b, c, d in zip(doc_cuts[:-1], doc_cuts[1:], text_cuts[:-1], text_cuts[1:]):
            yield packed[4 * a:4 * b], text[c:max(c, d - 1)].decode()


def decode(vocabulary: Vocabulary, ids: bytes) -> str:
    """The library's decoding without a decoder: tokens with one space between."""
    return " ".join([vocabulary.tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _batches(texts: pa.Array, limit: int = BATCH_CHARS) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


_encoders: dict[str, Encoder] = {}


def _encoder_of(text: str) -> Encoder:
    """One per Python worker: tasks that follow each other share what it remembers."""
    if text not in _encoders:
        _encoders.clear()
        _encoders[text] = Encoder(Vocabulary(text))
    return _encoders[text]


def _encoded_rows(docs: DataFrame, vocabulary_path: str, fields: list[T.StructField], row) -> DataFrame:
    """doc_id and the fields that ``row`` makes of (identifiers, decoded text), a part of a batch at a time."""
    with open(vocabulary_path, encoding="utf-8") as file:  # a vocabulary, read by the driver
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = T.StructType([T.StructField("doc_id", T.LongType()), *fields])
    arrow = to_arrow_schema(kind)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder_of(shared.value)
        for batch in batches:
            start = 0
            for texts in _batches(batch.column("text")):
                out = [row(*found) for found in encoder.encode(texts)]
                ids = batch.column("doc_id").slice(start, len(out))
                start += len(out)
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array(c, f.type) for c, f in zip(zip(*out), list(arrow)[1:])]], schema=arrow)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, kind)


def encoded(docs: DataFrame, vocabulary_path: str, decoded: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and, if wanted, decoded per row."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
              T.StructField("decoded", T.StringType())][:3 if decoded else 2]
    return _encoded_rows(docs, vocabulary_path, fields, lambda ids, text: (len(ids) // 4, ids, text)[:len(fields)])


def encoded_digests(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row: the same without carrying ids and texts."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    return _encoded_rows(docs, vocabulary_path, fields, lambda ids, text: (
        len(ids) // 4, hashlib.sha256(ids).hexdigest(),
        hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()))
