"""Chat formatting by columnar byte assembly.

A conversation becomes ``<turn ROLE>TEXT</turn>`` and a line feed per turn, in order. Inside roles and texts a
backslash goes before ``\\``, ``<`` and ``>``, so the control strings occur only where the template puts
them, and the escape is undone exactly. The loss mask is a list of spans of code points that cover the
texts of assistant turns.

A batch of turns is formatted at once: the lengths of all segments (header, role, header end, text, footer)
are computed, their cumulative offsets give the place of each in one preallocated buffer, and headers and
contents are copied by scatter indices; the buffer and the offsets of conversations are the Arrow column.

Defined results: a null text or role is an empty one; a null conv_id is a conversation of its own; rows
of equal turn are ordered by role and text, null turns first; repeated rows are turns of their own; an empty
table gives an empty result; other columns are not read. A conversation is one output row, so it is
held whole; batches of turns are formatted as they come."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, MIDDLE, CLOSE = b"<turn ", b">", b"</turn>\n"
TRAINED_ROLE = "assistant"
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>((?:[^\\<>]|\\.)*)</turn>\n", re.S)

FORMATTED = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("formatted", T.StringType()),
    T.StructField("loss_starts", T.ArrayType(T.LongType())), T.StructField("loss_ends", T.ArrayType(T.LongType()))])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]] if len(column) else data[:0], offsets - offsets[0]


def _escaped(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    special = (data == 92) | (data == 60) | (data == 62)
    shift = np.cumsum(special)
    out = np.full(len(data) + int(special.sum()), 92, np.uint8)
    out[np.arange(len(data)) + shift] = data
    return out, offsets + np.concatenate(([0], shift))[offsets]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, n + 1 offsets of the turns, n x 2 byte offsets of their texts in the buffer)."""
    role, role_at = _escaped(*_flat(roles))
    text, text_at = _escaped(*_flat(texts))
    n = len(roles)
    fixed = [np.frombuffer(x, np.uint8) for x in (OPEN, MIDDLE, CLOSE)]
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = (len(x) for x in fixed)
    lengths[:, 1], lengths[:, 3] = np.diff(role_at), np.diff(text_at)
    begins = np.concatenate(([0], np.cumsum(lengths.ravel())))
    buffer = np.empty(begins[-1], np.uint8)
    place = begins[:-1].reshape(n, 5)
    for segment, data in zip((0, 2, 4), fixed):
        buffer[place[:, segment, None] + np.arange(len(data))] = data
    for segment, data, at in ((1, role, role_at), (3, text, text_at)):
        buffer[np.repeat(place[:, segment] - at[:-1], np.diff(at)) + np.arange(len(data))] = data
    return buffer, begins[::5], np.stack((place[:, 3], place[:, 3] + lengths[:, 3]), axis=1)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns sorted by conversation and turn; a conversation at the end of a batch waits for the next."""
    held: list[pa.RecordBatch] = []
    pending = 0

    def results(rows: pa.Table) -> pa.RecordBatch:
        ids = rows.column("conv_id").combine_chunks()
        roles = rows.column("role").combine_chunks()
        buffer, turn_at, spans = assemble(roles, rows.column("text").combine_chunks())
        heads = _heads(ids)
        cuts = turn_at[np.append(heads, len(ids))]
        characters = np.concatenate(([0], np.cumsum((buffer & 0xC0) != 0x80)))
        trained = np.asarray(roles.fill_null("").to_numpy(zero_copy_only=False) == TRAINED_ROLE, bool)
        conversation = np.searchsorted(heads, np.flatnonzero(trained), side="right") - 1
        base = characters[cuts[:-1]][conversation]
        of_conversation = pa.array(np.concatenate(([0], np.cumsum(np.bincount(conversation, minlength=len(heads))))),
                                   pa.int32())
        marks = [pa.ListArray.from_arrays(of_conversation, pa.array(characters[spans[trained, k]] - base))
                 for k in (0, 1)]
        formatted = pa.LargeStringArray.from_buffers(
            len(heads), pa.py_buffer(np.ascontiguousarray(cuts)), pa.py_buffer(buffer))
        return pa.RecordBatch.from_arrays([ids.take(pa.array(heads)), formatted.cast(pa.string()), *marks],
                                          names=FORMATTED.names)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        pending += batch.num_rows
        if held[0].column("conv_id")[0].as_py() == batch.column("conv_id")[-1].as_py():
            continue  # still the one conversation
        rows = pa.Table.from_batches(held)
        last = int(_heads(rows.column("conv_id").combine_chunks())[-1])
        yield results(rows.slice(0, last))
        held, pending = rows.slice(last).to_batches(), rows.num_rows - last
    if pending:
        yield results(pa.Table.from_batches(held))


def _heads(ids: pa.Array) -> np.ndarray:
    """Rows at which another conversation begins."""
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    null = ids.is_null().to_numpy(zero_copy_only=False)
    new = np.ones(len(ids), bool)
    new[1:] = (values[1:] != values[:-1]) | (null[1:] != null[:-1])
    return np.flatnonzero(new)


def formatted_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_starts, loss_ends (spans of code points of ``formatted``), one row each."""
    turns = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         "role", "text")
    partitions = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (turns.repartition(partitions, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(_format, FORMATTED))


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of each turn."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("not a formatted conversation")
        out.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("not a formatted conversation")
    return out


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted conversations gets back, as digests."""
    kind = T.StructType([
        T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType())])

    @F.pandas_udf(kind)
    def read(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        out = []
        for text, begin, end in zip(texts, starts, ends):
            turns = read_back(text)
            whole = "".join([f"{role}\n{content}\n" for role, content in turns])
            loss = "".join([unescaped(text[a:b]) for a, b in zip(begin, end)])
            out.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                        hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        return pd.DataFrame(out, columns=kind.names)

    return (formatted.select("conv_id", read("formatted", "loss_starts", "loss_ends").alias("d"))
            .select("conv_id", "d.*"))
