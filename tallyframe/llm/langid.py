"""Language ID: multinomial naive Bayes over hashed character n-grams.

Fitted on a bounded, documented sample of labelled rows: of each language, rows are kept whose hash of
doc_id lies below ``sample_per_language`` / rows of that language, so at most about that many whole
texts are read by the fit at any corpus size. Every text is scored whole. Counts are summed by Spark;
the log-probability matrix (``BUCKETS`` x languages) is broadcast, and batches are scored as a sparse
product in numpy, in windows of bounded size. Every label is a language, however rare: the matrix takes
64 KB for each, on the driver and on every executor.

Defined results: ``und`` with score 0 for a null text, a text without letters, or when nothing could be
learned; rows with a null lang are never learned from; repeated rows are learned as often as they occur;
ties go to the language first by code point; lang, source and doc_id are no inputs of a prediction."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
SAMPLE_PER_LANGUAGE = 4000
SMOOTHING = 0.5
WINDOW = 1 << 18
SCORES = 1 << 23
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_FACTORS = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _codes(text: str | None) -> np.ndarray | None:
    """Code points of the lower-case letters, other runs as one space; None without any letter."""
    if not text or not any(map(str.isalpha, text)):
        return None
    plain = " " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " "
    return np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32)


def _windows(texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(n-gram buckets, index of the text of each), in windows of bounded size."""
    held, size = [], 0
    for i, text in enumerate(texts):
        codes = _codes(text)
        if codes is None:
            continue
        for start in range(0, len(codes), WINDOW):
            held.append((i, codes[start:start + WINDOW + max(ORDERS) - 1], min(WINDOW, len(codes) - start)))
            size += len(held[-1][1])
            if size >= WINDOW:
                yield _grams(held)
                held, size = [], 0
    if held:
        yield _grams(held)


def _grams(held) -> tuple[np.ndarray, np.ndarray]:
    codes = np.concatenate([c for _, c, _ in held])
    sizes = np.array([len(c) for _, c, _ in held])
    own = np.array([n for _, _, n in held])
    owner = np.repeat(np.array([i for i, _, _ in held]), sizes)
    at = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left = np.repeat(sizes, sizes) - at
    begins = at < np.repeat(own, sizes)  # grams of the overlap belong to the next window
    buckets, owners = [], []
    mixed = np.zeros(len(codes), np.uint32)
    for k in range(max(ORDERS)):
        n = len(codes) - k
        mixed = mixed[:n] * np.uint32(31) + codes[k:] * _FACTORS[k]
        if k + 1 in ORDERS:
            use = begins[:n] & (left[:n] > k)
            hashed = mixed[use] ^ (mixed[use] >> np.uint32(15))
            hashed = hashed * _FACTORS[0] + np.uint32(k)
            buckets.append((hashed >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32))
            owners.append(owner[:n][use])
    return np.concatenate(buckets), np.concatenate(owners)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Dense counts per language of one task: bounded by languages x BUCKETS."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            into = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for buckets, _ in _windows(texts):
                into += np.bincount(buckets, minlength=BUCKETS)
    for lang, counts in sums.items():
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": lang, "bucket": at, "n": counts[at]})


class Model:
    """languages (by code point) and log probabilities, BUCKETS x languages."""

    def __init__(self, languages: list[str], log_p: np.ndarray):
        self.languages, self.log_p = languages, log_p

    def score(self, texts) -> tuple[list[str], np.ndarray]:
        n, k = len(texts), len(self.languages)
        rows = max(1, SCORES // max(k, 1))
        if n > rows:  # a bounded number of scores at once, for any number of languages
            parts = [self.score(texts[at:at + rows]) for at in range(0, n, rows)]
            return [x for told, _ in parts for x in told], np.concatenate([x for _, x in parts])
        sums, seen = np.zeros((n, max(k, 1))), np.zeros(n, bool)
        if k:
            for buckets, owners in _windows(texts):
                lo = int(owners.min())
                local = owners - lo
                width = int(local.max()) + 1
                for j in range(k):  # the sparse batch times one column of the matrix
                    sums[lo:lo + width, j] += np.bincount(local, self.log_p[j][buckets], width)
                seen[np.unique(owners)] = True
        best = sums.argmax(axis=1)
        odds = np.exp(sums - sums.max(axis=1, keepdims=True))
        score = np.where(seen, 1.0 / odds.sum(axis=1), 0.0)
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best, seen)], score


def fit(docs: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learn from text and non-null lang of rows that are not held out."""
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("of_lang"))
    share = F.least(F.lit(1.0), F.lit(float(sample_per_language)) / F.col("of_lang"))
    unit = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.join(F.broadcast(sizes), "lang").where(unit < share).select("text", "lang")
    found = (sample.mapInPandas(_count, "lang string, bucket int, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(found["lang"].unique().tolist())
    log_p = np.zeros((len(languages), BUCKETS), np.float32)
    for j, lang in enumerate(languages):
        mine = found[found["lang"] == lang]
        counts = np.full(BUCKETS, SMOOTHING)
        counts[mine["bucket"].to_numpy()] += mine["n"].to_numpy()
        log_p[j] = np.log(counts / counts.sum())
    return Model(languages, log_p)


def _predictor(docs: DataFrame, model: Model):
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_p))

    @F.pandas_udf(T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]))
    def predict(texts: pd.Series) -> pd.DataFrame:
        languages, score = Model(*shared.value).score(texts.tolist())
        return pd.DataFrame({"lang": languages, "score": score})

    return predict


def predict_languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row."""
    predict = _predictor(docs, model or fit(docs))
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score")))


def keep_identified(docs: DataFrame, min_score: float = 0.5, model: Model | None = None) -> DataFrame:
    """The rows, with their columns, whose language is told with at least ``min_score``; the others go."""
    predict = _predictor(docs, model or fit(docs))
    told = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), predict("text").alias("p"))
    return told.where((F.col("p.lang") != UNKNOWN) & (F.col("p.score") >= min_score)).select("row.*")
