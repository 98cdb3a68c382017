"""Line dedup: a segment-partition edit join in DataFrame expressions only.

A line is a run between line feeds, stripped of spaces, tabs and carriage returns at its ends. Exact repeats
are told of lines of every length but empty ones. Only lines of at least ``MIN_CHARS`` characters take part
in the edit join: two edits make another line of a shorter one. Lines meet in buckets of their length, and those that
end at most EDITS before a bucket visit it, so that lines of near lengths share one. EDITS + 1 zones lie in
the least length of a bucket, the earlier ones counted from the start of a line, the later ones from its end. Of two
lines within EDITS edits, some zone of the one is whole in the other, with exactly as many edits before it as there are
zones before it (count edits less zones along the line: it starts at nought, ends below and falls by one at most); so
the zone is shifted by no more than the zones before it, counted from the start, and than those after it, counted from
the end. A zone is longer than what is compared by the lesser of the two, and posted once for each place in it: then
both lines have posted the same string. With two edits these are four hashes per line, and four more where it visits. The
join itself refuses pairs whose lengths or letter counts are too far apart, so that most pairs of variants of one line
that share a zone never become rows; the others are verified with Spark's banded edit distance. Hashes and counts are
taken where the text is read, and only they are shuffled and kept; texts are read again for lines in pairs.

A line is removed where it occurred before (in the order of doc_id, then of lines), and where a
different line within EDITS edits first occurred before it; decisions are made on the input, not on what
is left, so a line may be removed for one that goes itself. Repeats of lines under ``MIN_CHARS`` characters
are reported on their own. As prose and programs repeat short lines too, a text loses such a line only if it is
page furniture: at least two words with a letter, and no end of a sentence; and not if nothing else is left of it.

Rows are told apart by doc_id and a hash of the text (36 bits; within one doc_id only), rows that are equal in both
get equal answers. Lines are told apart by 64-bit hashes.

Defined results: a null text has no lines and stays null; rows with a null doc_id are left alone; equal rows
repeated under one doc_id count as one document, each keeping its first occurrences; rows of one doc_id with other
texts are documents of their own, in the order of their hashes; an empty table gives an empty result; other columns
may have any name; texts of any length are split whole, and the work grows with the number of their lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.sources.sinks import cleared, stored

MIN_CHARS = 20
EDITS = 2
SENTENCE_END = r"[.!?…。！？‥।؟:;,\"'”’»)）」』]$"
WORDS_WITH_LETTER = r"(?s)^(?=.*\p{L}).*\S\s+\S"
#: Bits of a spot that number the line, above them is the hash of the text.
SPOT_BITS = 28
#: The most frequent letters of English, in that order; other scripts are compared by segments and distance alone.
LETTERS = "etaoinsrhldcumfp"
#: Widths of the buckets of lengths, up to 16 of the narrow ones and beyond.
SHORT_BUCKET, LONG_BUCKET = 4, 16


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda x: F.trim(x, F.lit(" \t\r")))


def _line_key(line: Column) -> Column:
    return F.xxhash64(line)


def _sketched(lines: DataFrame) -> DataFrame:
    """The lines with their counts (modulo 16) of sixteen letters, four bits each. Each letter is taken out of
    what the ones before have left."""
    names = lines.columns
    lines, sketch = lines.withColumn("_rest0", F.col("line")), F.lit(0).cast("long")
    for lane, letter in enumerate(LETTERS):
        lines = lines.withColumn(f"_rest{lane + 1}", F.replace(f"_rest{lane}", F.lit(letter)))
        count = (F.octet_length(f"_rest{lane}") - F.octet_length(f"_rest{lane + 1}")).bitwiseAND(15)
        sketch = sketch.bitwiseOR(F.shiftleft(count.cast("long"), 4 * lane))
    return lines.select(*names, sketch.alias("sketch"))


def _sketches_near(a: Column, b: Column, edits: int) -> Column:
    """What holds of any two lines within the edits: an edit changes the counts by two in sum at most. Counts
    modulo 16 are compared the shorter way round."""
    apart = F.lit(0)
    for lane in range(len(LETTERS)):
        x, y = (F.shiftright(sketch, 4 * lane).bitwiseAND(15).cast("int") for sketch in (a, b))
        ahead = (x - y).bitwiseAND(15)
        apart = apart + F.least(ahead, F.lit(16) - ahead)
    return apart <= 2 * edits


def _zones(edits: int) -> list[tuple[int, int, bool]]:
    """(number, room, counted from the end) of each zone; room is the shift it allows, and its spare length."""
    return [(i, min(i, edits - i), i > edits - i) for i in range(edits + 1)]


def _bucket(n: Column, edits: int) -> tuple[Column, Column]:
    """(least length, length after its last) of the bucket of a length: narrow ones where zones are short."""
    unit = max(1, -(-edits // SHORT_BUCKET))
    step = F.when(n < 16 * SHORT_BUCKET * unit, SHORT_BUCKET * unit).otherwise(LONG_BUCKET * unit)
    least = (F.floor(n / step) * step).cast("int")
    return least, (least + step).cast("int")


def _posted(line: Column, n: Column, bucket: Column, edits: int) -> list[Column]:
    """Hashes of what a line posts in a bucket: equal ones let two lines meet."""
    zones = _zones(edits)
    size = F.greatest(F.lit(0), F.floor((bucket - edits - sum(room for _, room, _ in zones)) / len(zones))).cast("int")
    out = []
    for i, room, at_end in zones:
        spare = sum(r for j, r, _ in zones if (j >= i if at_end else j < i))
        start = n - (size * (len(zones) - i) + spare) + 1 if at_end else size * i + spare + 1
        out += [F.xxhash64(F.lit(i), bucket, F.substring(line, (start + place).cast("int"), size))
                for place in range(room + 1)]
    return out


def _met(lines: DataFrame, edits: int) -> DataFrame:
    """The lines (line, n) with the hashes they post, at0 and so on: those of the own bucket, then those of the next
    one, NULL where a line does not visit it."""
    own, after = _bucket(F.col("n"), edits)
    lines = lines.withColumn("_own", own).withColumn("_after", after)
    here = _posted(F.col("line"), F.col("n"), F.col("_own"), edits)
    visits = F.col("n") >= F.col("_after") - edits
    there = [F.when(visits, at) for at in _posted(F.col("line"), F.col("n"), F.col("_after"), edits)]
    return lines.withColumns({f"at{i}": at for i, at in enumerate(here + there)}).drop("_own", "_after")


def _posts(lines: DataFrame) -> list[str]:
    return [c for c in lines.columns if c[:2] == "at" and c[2:].isdigit()]


def candidate_pairs(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """(a, b) keys of different lines (key, n characters, sketch, posted hashes) that have posted an equal hash, and
    whose lengths and sketches are as near as they must be; each pair once."""
    posts = F.explode(F.array_compact(F.array(*_posts(lines))))
    rows = lines.select("key", F.col("n").cast("int").alias("n"), "sketch", posts.alias("at"))
    a, b = (rows.select(*[F.col(c).alias(f"{side}_{c}") for c in rows.columns]) for side in "ab")
    near = (F.abs(F.col("a_n") - F.col("b_n")) <= edits) & _sketches_near(F.col("a_sketch"), F.col("b_sketch"), edits)
    met = a.join(b, (F.col("a_at") == F.col("b_at")) & (F.col("a_key") < F.col("b_key")) & near)
    return met.select(F.col("a_key").alias("a"), F.col("b_key").alias("b")).distinct()


def near_line_pairs(lines: DataFrame, at: DataFrame, edits: int = EDITS) -> DataFrame:
    """(a, b) keys of different lines (key, place, n, sketch, posted hashes) within ``edits`` edits, each pair once, with
    their places. ``at`` (doc_id, spot, key, line) has the lines where they stand: it is read for the lines that occur
    in pairs, at their place."""
    met = stored(candidate_pairs(lines, edits))
    keys = met.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    places = stored(lines.join(keys, "key", "left_semi").select("key", "place.doc_id", "place.spot"))
    # a merge join at any size: lines that occur in pairs grow with the table, so they are not for a broadcast. By their
    # place, a frequent line is dealt over all tasks; equal rows under one doc_id have equal places
    found = stored(at.join(places.hint("merge"), ["key", "doc_id", "spot"]).dropDuplicates(["key"]))
    for side in ("a", "b"):
        met = met.join(found.select(F.col("key").alias(side), F.struct("doc_id", "spot").alias(f"{side}_place"),
                                    F.col("line").alias(f"{side}_line")), side)
    return met.where(F.levenshtein("a_line", "b_line", edits) >= 0).drop("a_line", "b_line")


def _text_key(text: Column) -> Column:
    return F.shiftright(F.xxhash64(text), SPOT_BITS)


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, edits: int = EDITS, every: bool = False) -> DataFrame:
    """(doc_id, text_key, idx, short, furniture) of every line occurrence that occurred before. idx numbers the
    distinct lines of the text or, with ``every``, all of them. ``short``: the line has under ``min_chars``
    characters, so that only exact repeats count; ``furniture``: see above, NULL for lines that are not short.

    What is taken from the distinct lines is written once, with the place where they first occur, but without their
    text; only the keys of lines that lose an occurrence meet the occurrences again."""
    lines = _lines(F.col("text"))
    at = docs.where("doc_id is not null").select("doc_id", _text_key(F.col("text")).alias("text_key"), F.posexplode(
        lines if every else F.array_distinct(lines)).alias("idx", "line")).where("line <> ''")
    spot = F.shiftleft(F.col("text_key"), SPOT_BITS).bitwiseOR(F.col("idx").cast("long"))
    at = at.select("doc_id", spot.alias("spot"), "line", _line_key(F.col("line")).alias("key"))
    sized = _sketched(at.withColumn("n", F.char_length("line").cast("int")))
    posting, short = F.col("n") >= min_chars, F.col("n") < min_chars
    furniture = F.col("line").rlike(WORDS_WITH_LETTER) & ~F.col("line").rlike(SENTENCE_END)
    sized = sized.withColumn("furniture", F.when(short, furniture))
    if edits > 0:
        sized = _met(sized, edits)
    # occurrences of a line agree in all that is taken from its text
    taken = ["n", "sketch", "furniture", *_posts(sized)]
    lines = sized.groupBy("key").agg(F.min(F.struct("doc_id", "spot")).alias("place"), F.count("*").alias("times"),
                                     *[F.max(c).alias(c) for c in taken])
    lines = stored(lines.where(posting | (F.col("times") > 1)))
    later = lines.select("key").limit(0)
    if edits > 0:
        pairs = near_line_pairs(lines.where(posting), at, edits)
        earlier = F.struct("a_place", "a") < F.struct("b_place", "b")
        later = pairs.select(F.when(earlier, F.col("b")).otherwise(F.col("a")).alias("key")).distinct()
    later = stored(later.withColumn("near", F.lit(True)))
    losing = stored(lines.join(later, "key", "left").where("near or times > 1")
                    .select("key", "place", "near", short.alias("short"), "furniture"))
    goes = F.col("near").isNotNull() | (F.struct("doc_id", "spot") != F.col("place"))
    return (at.select("doc_id", "spot", "key").join(losing, "key").where(goes)
            .select("doc_id", F.shiftright("spot", SPOT_BITS).alias("text_key"),
                    F.col("spot").bitwiseAND((1 << SPOT_BITS) - 1).cast("int").alias("idx"), "short", "furniture"))


def line_report(docs: DataFrame, min_chars: int = MIN_CHARS, edits: int = EDITS) -> DataFrame:
    """Per document: doc_id, n_lines (distinct ones), n_dropped, dropped (their numbers, ascending), and
    repeated_short: the numbers of shorter lines that occurred before, ascending."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    numbers = lambda which: F.sort_array(F.collect_set(F.when(which, F.col("idx"))))
    gone = (repeated_lines(docs, min_chars, edits).groupBy("doc_id", "text_key")
            .agg(numbers(~F.col("short")).alias("dropped"), numbers(F.col("short")).alias("repeated_short")))
    sized = docs.select("doc_id", _text_key(F.col("text")).alias("text_key"), F.coalesce(
        F.size(F.array_distinct(_lines(F.col("text")))), F.lit(0)).cast("long").alias("n_lines"))
    none = F.array().cast("array<int>")
    return (sized.join(gone, ["doc_id", "text_key"], "left")
            .select("doc_id", "n_lines", F.coalesce("dropped", none).alias("dropped"),
                    F.coalesce("repeated_short", none).alias("repeated_short"))
            .withColumn("n_dropped", F.size("dropped").cast("long")))


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, edits: int = EDITS) -> DataFrame:
    """The rows, with their columns, whose text has lost the lines that go, later repeats within the row among
    them: lines of at least ``min_chars`` characters, and shorter ones by the rule above; others stay as
    they are. A text that had lines and lost them all goes as a row. A text that loses nothing is not touched.

    A row travels as one structure, its text as the array of its lines, so that what is left is picked by
    position."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    which = lambda short: F.collect_set(F.when(short, F.col("idx")))
    with cleared() as kept:
        gone = repeated_lines(narrow, min_chars, edits, every=True).where("not short or furniture")
        gone = stored(gone.groupBy("doc_id", "text_key").agg(which(~F.col("short")).alias("gone"),
                                                             which(F.col("short")).alias("furniture")))
        kept.append(gone)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _text_key(F.col("text")).alias("text_key"),
        F.split("text", "\n").alias("lines"), F.struct(*[docs[n] for n in docs.columns if n != "text"]).alias("row"))
    joined = rows.join(gone, ["doc_id", "text_key"], "left")
    picked = lambda at: F.array_join(F.transform(at, lambda i: F.get(F.col("lines"), i)), "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    joined = joined.withColumn("text", F.when(F.col("gone").isNull(), F.array_join("lines", "\n")).otherwise(
        picked(F.array_except(left, "furniture"))))
    # a text that would be nothing without its furniture keeps it
    bare = F.col("gone").isNotNull() & (F.col("text") == "")
    joined = joined.withColumn("text", F.when(bare, picked(left)).otherwise(F.col("text"))).where("gone is null or text <> ''")
    return joined.select(*[F.col("text") if n == "text" else F.col("row").getField(n).alias(n) for n in docs.columns])
