"""MinHash near-duplicates: an inverted join over signature coordinates.

A document's set holds its distinct word shingles. A signature has ``COORDINATES`` coordinates, each the
combined minima of ``ROWS`` hash functions over the set, so two sets of similarity J agree in a coordinate
with probability J**ROWS. Documents are posted under each pair of coordinate and value, but for the last
MATCHES - 1 coordinates (prefix: a pair that agrees in MATCHES of them meets without those). At J = 0.8 a
pair agrees in fewer than MATCHES with probability 1.4e-7. Pairs above the threshold are confirmed on the
full sets.

Equal sets are one class from the start. Then

1. each list is merged with two of its members only: the smallest id and the hub, the one that shares most
   posts with others; confirmed links make components;
2. lists whose members lie in one component are skipped. In the others, pairs from different components
   are counted over all lists of at most ``SHORT`` members, and those with MATCHES collisions are confirmed;
3. members of longer open lists are compared among each other by an exact prefix join on their sets: rarest
   shingles first, a pair meets only under a shingle early enough in both for the overlap that is needed.
   A pair with one collision in a short list and the other in a long one is met here.

So no link that joins two components is lost, while a list of many near copies does not cost its square.

Defined results: a text that is null or has no word has the empty set and is linked with nothing; with
fewer words than a shingle, the whole sequence is the one shingle; rows with a null doc_id are linked
through equal texts only and always kept; rows repeated under one doc_id are documents of their own that
share its name; empty tables give empty results; other columns are not read."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.components import components
from tallyframe.llm.hashing import byte_table, mixed, odd_numbers, words
from tallyframe.sources.sinks import cleared, stored

WORDS = 5
SIMILARITY_PERCENT = 80
COORDINATES, ROWS, MATCHES = 48, 5, 2
SHORT = 32
_BYTES = byte_table(31)
_PIECE = 1 << 21
_HASHES = odd_numbers(37, COORDINATES * ROWS).astype(np.uint32)
_SHIFTS = odd_numbers(41, COORDINATES * ROWS).astype(np.uint32)
_COMBINE = odd_numbers(43, ROWS)
_NAMES = odd_numbers(47, COORDINATES)
_KEYS = odd_numbers(53, 2)

SIGNATURE = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
    T.StructField("posts", T.ArrayType(T.LongType()))])


def shingle_sets(texts, size: int):
    """The sorted distinct shingle hashes of each text, A-Z lower-cased."""
    factors = odd_numbers(59, size)
    held: list[bytes] = []

    def results():
        data = np.frombuffer(b"\n".join(held) + b"\n", np.uint8)
        data = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
        found, starts = words(data, _BYTES)
        ends = np.cumsum([len(b) + 1 for b in held])
        cuts = np.concatenate(([0], np.searchsorted(starts, ends)))
        n = len(found)
        shingles = np.zeros(n, np.uint64)
        for k in range(size):
            shingles[:max(0, n - k)] += found[k:] * factors[k]
        shingles = mixed(shingles)
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a >= size:
                yield np.unique(shingles[a:b - size + 1])
            elif b > a:
                yield mixed((found[a:b] * factors[:b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a))
            else:
                yield found[:0]

    total = 0
    for text in texts:
        held.append((text or "").encode("utf-8", "surrogatepass"))
        total += len(held[-1])
        if total >= _PIECE:
            yield from results()
            held, total = [], 0
    if held:
        yield from results()


def _posts(values: np.ndarray) -> np.ndarray:
    """One number per pair of coordinate and value."""
    low = np.full(len(_HASHES), np.iinfo(np.uint32).max, np.uint32)
    short = (values >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), 256):
        part = short[start:start + 256, None] * _HASHES + _SHIFTS
        np.minimum(low, part.min(axis=0), out=low)
    combined = (low.astype(np.uint64).reshape(COORDINATES, ROWS) * _COMBINE).sum(axis=1, dtype=np.uint64)
    return mixed(combined + _NAMES).view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """The columns but text, n (set size), k1, k2 (128-bit key of the set), posts."""

    @F.pandas_udf(SIGNATURE)
    def sign(texts: pd.Series) -> pd.DataFrame:
        out = []
        for values in shingle_sets(texts, size):
            keys = [int(mixed(values * k).sum(dtype=np.uint64).astype(np.int64)) for k in _KEYS]
            posts = _posts(values)[:COORDINATES - MATCHES + 1] if len(values) else None
            out.append((len(values), *keys, posts))
        return pd.DataFrame(out, columns=SIGNATURE.names)

    others = [c for c in docs.columns if c != "text"]
    return docs.select(*others, sign("text").alias("s")).select(*others, "s.*")


def _sets(docs: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """(doc_id, set) of the documents needed (doc_id)."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def shingles(texts: pd.Series) -> pd.Series:
        return pd.Series([v.view(np.int64) for v in shingle_sets(texts, size)])

    # the number of documents needed grows with the corpus: never a broadcast
    return stored(docs.select("doc_id", "text").join(needed.distinct().hint("merge"), "doc_id", "left_semi")
                  .select("doc_id", shingles("text").alias("set")))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b) those that reach the similarity on full sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("set").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    linked = 100 * common >= SIMILARITY_PERCENT * (F.size("sa") + F.size("sb") - common)
    return (pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").where(linked)
            .select("a", "b").distinct())


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))


def _prefix_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of members (rep, component) of different components that can reach the similarity.

    Shingles of a set are numbered from the rarest up. Two sets that overlap enough have a first common
    shingle, and what follows it in either set, with it, must make up the overlap needed."""
    rows = (members.join(sets, members["rep"] == sets["doc_id"])
            .select("rep", "component", F.size("set").alias("n"), F.explode("set").alias("shingle")))
    rows = rows.withColumn("found", F.count(F.lit(1)).over(Window.partitionBy("shingle")))
    by_rarity = Window.partitionBy("rep").orderBy("found", "shingle")
    early = rows.withColumn("place", F.row_number().over(by_rarity)).where(
        (F.col("found") > 1) & (100 * (F.col("n") - F.col("place") + 1) >= SIMILARITY_PERCENT * F.col("n")))
    early = stored(early.select("shingle", "rep", "component", "n", "place"))
    a, b = early.alias("a"), early.alias("b")
    left = 1 + F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"))
    enough = (100 + SIMILARITY_PERCENT) * left >= SIMILARITY_PERCENT * (F.col("a.n") + F.col("b.n"))
    return (a.join(b, (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.rep") < F.col("b.rep"))
                   & (F.col("a.component") != F.col("b.component")) & enough)
            .select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).distinct())


def _grouped(docs: DataFrame, size: int) -> DataFrame:
    """One row per document: the columns but text, n, k1, k2, component (the smallest doc_id linked with it; null
    if its links have none)."""
    signed = stored(signatures(docs, size))
    classes = stored(signed.where("n > 0").groupBy("k1", "k2")
                     .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("posts").alias("posts")))
    posts = classes.where("rep is not null").select("rep", "n", F.explode("posts").alias("post"))
    lists = (posts.groupBy("post").agg(F.count(F.lit(1)).alias("m"), F.min("rep").alias("low"),
                                       F.max("rep").alias("high")).where("low < high").drop("high"))
    members = stored(posts.join(lists, "post"))
    # 1. every list with its smallest id and its hub
    shared = members.groupBy("rep").agg(F.sum("m").alias("shared"))
    hubs = members.join(shared, "rep").groupBy("post").agg(F.max(F.struct("shared", "rep"))["rep"].alias("hub"))
    ends = (members.join(hubs, "post").select("rep", F.explode(F.array_distinct(F.array("low", "hub"))).alias("end"))
            .where("rep <> end"))
    met = ends.groupBy(F.least("rep", "end").alias("a"), F.greatest("rep", "end").alias("b")).agg(
        F.count(F.lit(1)).alias("met"))
    first = stored(met.where(F.col("met") >= MATCHES).select("a", "b"))
    links = stored(_confirmed(first, _sets(docs, _ends(first), size)))
    found = components(links).withColumnRenamed("node", "rep")
    # 2. pairs of different components in the other lists, by their collisions in short lists
    told = stored(members.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    mixed_lists = (told.groupBy("post").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                   .where("lo < hi").select("post"))
    told = stored(told.join(mixed_lists, "post"))
    short = told.where(F.col("m") <= SHORT)
    a, b = short.alias("a"), short.alias("b")
    rest = a.join(b, (F.col("a.post") == F.col("b.post")) & (F.col("a.rep") < F.col("b.rep"))
                  & (F.col("a.component") != F.col("b.component"))
                  & (F.greatest("a.n", "b.n") * SIMILARITY_PERCENT <= F.least("a.n", "b.n") * 100))
    rest = rest.groupBy(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).agg(F.count(F.lit(1)).alias("met"))
    rest = stored(rest.where(F.col("met") >= MATCHES).select("a", "b").join(first, ["a", "b"], "left_anti"))
    # 3. members of long lists by their sets
    crowded = stored(told.where(F.col("m") > SHORT).select("rep", "component").distinct())
    sets = _sets(docs, _ends(rest).unionByName(crowded.select(F.col("rep").alias("doc_id"))), size)
    rest = rest.unionByName(_prefix_pairs(crowded, sets)).distinct()
    links = stored(links.unionByName(_confirmed(rest, sets)))
    found = components(links)
    named = classes.select("k1", "k2", "rep").join(found, classes["rep"] == found["node"], "left").select(
        "k1", "k2", F.coalesce("component", "rep").alias("component"))
    return signed.drop("posts").join(named, ["k1", "k2"], "left")


def near_duplicates(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable over links of
    similarity 0.8 or more), kept (doc_id = component_id)."""
    own = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return (_grouped(docs, size).select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_one(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """The rows, with their columns, less near duplicates: of each component one row stays, that of the smallest
    doc_id (null last), then one of those. Rows without a word are linked with nothing and all stay.

    The rows are written with a number each, by which they are linked, so rows of one doc_id or of none are told
    apart."""
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("number"),
                                  F.struct(*[docs[c] for c in docs.columns]).alias("row")))
    first = F.min(F.struct(F.col("own_id").isNull().alias("unnamed"), "own_id", F.col("doc_id").alias("number")))
    group = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    with cleared() as kept:
        found = _grouped(numbered.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text"),
                                         F.col("row.doc_id").cast("long").alias("own_id")), size)
        staying = stored(found.groupBy(group.alias("group")).agg(first.alias("first")).select("first.number"))
        kept.append(staying)
    return numbered.join(staying, "number", "left_semi").select("row.*")
