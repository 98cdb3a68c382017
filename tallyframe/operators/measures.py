"""Measures: typed summaries of expressions over one table, fused into few passes.

A column profile and a catalogued variable are the same thing: an expression, an
optional scope predicate, and the statistics wanted.  All measures of a table share
one aggregate for counts, ranges and moments (chunked so that generated code stays
within method limits), one for value counts and one for distinct subjects.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallyframe.functions.labels import label
from tallyframe.operators.quantiles import QUARTILES, SORT_LIMIT, order_statistics
from tallyframe.sources.registry import Table
from tallyframe.sources.sinks import materialize

CHUNK = 50
# From this many rows on, counts are taken first and what they settle is not scanned for again.
COUNT_FIRST_ROWS = 200_000

TOP_VALUES = T.ArrayType(T.StructType([
    T.StructField("value", T.StringType()), T.StructField("n", T.LongType())]))
NUMERIC_FIELDS = ("min_num", "max_num", "mean", "std", "q1", "median", "q3")
STATISTICS = T.StructType(
    [T.StructField("table", T.StringType()), T.StructField("key", T.StringType()),
     T.StructField("n_scope", T.LongType()), T.StructField("n_nonnull", T.LongType())]
    + [T.StructField(f, T.DoubleType()) for f in NUMERIC_FIELDS]
    + [T.StructField("min_date", T.StringType()), T.StructField("max_date", T.StringType()),
       T.StructField("subject_count", T.LongType()), T.StructField("top_values", TOP_VALUES)])


@dataclass(frozen=True)
class Measure:
    key: str
    value: Column
    data_type: T.DataType
    scope: Column | None = None
    counts: bool = True
    spread: bool = False
    quartiles: bool = False
    dates: bool = False
    top: int = 0
    subjects: bool = False

    @property
    def scoped(self) -> Column:
        """The value where the row is in scope, NULL elsewhere."""
        return self.value if self.scope is None else F.when(self.scope, self.value)


def _row(table: str, key: str, **fields: str) -> str:
    """SQL struct of the STATISTICS shape; fields not given are NULL."""
    parts = [f"{_quoted(table)} as `table`", f"{key} as key"]
    for f in STATISTICS.fields[2:]:
        parts.append(f"cast({fields.get(f.name, 'null')} as {f.dataType.simpleString()}) as {f.name}")
    return f"struct({', '.join(parts)})"


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(value: float | None) -> str:
    return "null" if value is None else f"double('{value!r}')"


def _interpolated(values: str, p: float) -> str:
    """Quantile of a sorted array: the two neighbours of its position, joined linearly."""
    position = f"({p}D * (size({values}) - 1))"
    low, high = (f"get({values}, int({f}({position})))" for f in ("floor", "ceil"))
    return f"if({low} = {high}, {low}, {low} + ({high} - {low}) * ({position} - floor({position})))"


def projected(table: Table, measures: Sequence[Measure], extra: Sequence[Column] = ()) -> DataFrame:
    """The table reduced to the measures: m0, m1, … (value in scope) and s0, s1, … (scope)."""
    columns = list(extra)
    for i, m in enumerate(measures):
        columns.append(m.scoped.alias(f"m{i}"))
        if m.scope is not None:
            columns.append(m.scope.alias(f"s{i}"))
    return table.data.select(*columns)


def statistics(table: Table, measures: Sequence[Measure], row_count: int,
               row_limit: int | None = None) -> list[DataFrame]:
    """Counts, range, moments, quartiles and date range; one aggregate per chunk of measures.

    Quartiles are found now, in two scans; a table of at most ``row_limit`` rows (as many as a bracket of the
    two scans may hold) sorts its values within the aggregate instead, which stays lazy. Chunks read disjoint columns of a columnar source, so splitting costs no extra input."""
    limit = SORT_LIMIT if row_limit is None else row_limit
    wanted = [m for m in measures if m.counts or m.spread or m.quartiles or m.dates]
    large = [m for m in wanted if m.quartiles] if row_count > limit else []
    found = order_statistics(table.data, {m.key: m.scoped for m in large}) if large else {}
    wanted = [m for m in wanted if m.counts or m.spread or m.dates or not large or m.key in found]
    out = []
    for start in range(0, len(wanted), CHUNK):
        chunk = wanted[start:start + CHUNK]
        aggregates, rows = ["count(1) as n_rows"], []
        for i, m in enumerate(chunk):
            terms = {}
            if m.counts:
                if m.scope is not None:
                    terms["n_scope"] = f"count_if(s{i})"
                terms["n_nonnull"] = f"count(m{i})"
            if m.spread:
                number = f"double(m{i})"
                terms.update(min_num=f"min({number})", max_num=f"max({number})",
                             mean=f"avg({number})", std=f"stddev_samp({number})")
            if m.quartiles and not large:
                terms["q"] = f"sort_array(collect_list(double(m{i})))"
            if m.dates:
                terms.update(min_date=f"min(m{i})", max_date=f"max(m{i})")
            aggregates += [f"{term} as {name}_{i}" for name, term in terms.items()]
            fields = {name: f"{name}_{i}" for name in terms if name != "q"}
            if m.counts and m.scope is None:
                fields["n_scope"] = "n_rows"
            if "q" in terms:
                fields.update(zip(("q1", "median", "q3"), [_interpolated(f"q_{i}", p) for p in QUARTILES]))
            elif m.quartiles:
                fields.update(zip(("q1", "median", "q3"), map(_number, found.get(m.key, [None] * 3))))
            rows.append(_row(table.name, _quoted(m.key), **fields))
        summary = projected(table, chunk).selectExpr(*aggregates)
        out.append(summary.selectExpr(f"inline(array({', '.join(rows)}))"))
    return out


def _by_slot(measures: Sequence[Measure], result) -> str:
    """SQL map from slot name to a literal per measure."""
    return "map(" + ", ".join(f"'m{i}', {result(m)}" for i, m in enumerate(measures)) + ")[slot]"


def _group_type(data_type: T.DataType) -> T.DataType:
    """Type to group by: numbers as they are, everything else by its label."""
    if isinstance(data_type, T.IntegralType):
        return T.LongType()
    return data_type if isinstance(data_type, T.DoubleType) else T.StringType()


def value_counts(table: Table, measures: Sequence[Measure]) -> DataFrame:
    """(slot, value, n) of the non-null scoped labels; one pass per value type.

    Numbers are counted as numbers and labelled once per distinct value.  The count is
    combined map-side, so a hot value costs one row per task."""
    out = []
    for group_type in (T.StringType(), T.LongType(), T.DoubleType()):
        own = [(i, m) for i, m in enumerate(measures) if _group_type(m.data_type) == group_type]
        if not own:
            continue
        values = [label(m.scoped, m.data_type) if group_type == T.StringType() else m.scoped.cast(group_type)
                  for _, m in own]
        wide = table.data.select(*[v.alias(f"m{i}") for v, (i, _) in zip(values, own)])
        long = wide.unpivot([], wide.columns, "slot", "value").where("value is not null")
        counted = long.groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n"))
        out.append(counted.select("slot", label(F.col("value"), group_type).alias("value"), "n"))
    return union_all(out)


def ranked_values(table: Table, measures: Sequence[Measure]) -> DataFrame:
    """(slot, rank, value, n): the most frequent labels per measure, ties by label.

    The rank filter becomes a per-partition group limit before the final shuffle."""
    limits = _by_slot(measures, lambda m: m.top)
    order = Window.partitionBy("slot").orderBy(F.desc("n"), "value")
    ranked = value_counts(table, measures).withColumn("rank", F.row_number().over(order))
    return ranked.where(f"rank <= {max(m.top for m in measures)}").where(f"rank <= {limits}")


def top_values(table: Table, measures: Sequence[Measure]) -> DataFrame:
    """(table, key, rank, value, n) of the measures that ask for top values."""
    wanted = [m for m in measures if m.top > 0]
    keys = _by_slot(wanted, lambda m: _quoted(m.key))
    return ranked_values(table, wanted).selectExpr(
        f"{_quoted(table.name)} as `table`", f"{keys} as key", "rank", "value", "n")


def top_values_part(table: Table, measures: Sequence[Measure]) -> DataFrame:
    wanted = [m for m in measures if m.top > 0]
    # at most ``top`` rows per measure reach the list
    listed = ranked_values(table, wanted).groupBy("slot").agg(
        F.expr("sort_array(collect_list(struct(rank, value, n)))").alias("t"))
    keys = _by_slot(wanted, lambda m: _quoted(m.key))
    values = "transform(t, x -> struct(x.value as value, x.n as n))"
    return listed.selectExpr(f"inline(array({_row(table.name, keys, top_values=values)}))")


def subject_flags(table: Table, measures: Sequence[Measure]) -> DataFrame:
    """One row per subject with a 0/1 flag per measure: the subject has a value in scope.

    One shuffle for any number of distinct counts; a hot subject is combined map-side."""
    rows = projected(table, measures, extra=[F.col(table.subject_key).alias("subject")])
    flags = [F.expr(f"max(int(m{i} is not null))").alias(f"f{i}") for i in range(len(measures))]
    return rows.where("subject is not null").groupBy("subject").agg(*flags)


def subjects_part(table: Table, measures: Sequence[Measure], filled: Mapping[str, int] | None = None,
                  row_count: int = 0) -> list[DataFrame]:
    """Distinct subjects per measure.

    ``filled`` gives the non-null rows per measure where they are known already: a measure that
    is never NULL has the table's subjects and one that is always NULL has none, so only columns
    with some NULLs are read again."""
    filled = filled or {}
    wanted = [m for m in measures if m.subjects]
    full = [m for m in wanted if filled.get(m.key) == row_count > 0]
    none = [m for m in wanted if filled.get(m.key) == 0]
    open_measures = [m for m in wanted if m not in full and m not in none]
    if full:
        subject = table.data.schema[table.subject_key].dataType
        open_measures.append(Measure("", F.col(table.subject_key), subject))
    out = []
    for start in range(0, len(open_measures), CHUNK):
        chunk = open_measures[start:start + CHUNK]
        counted = subject_flags(table, chunk).selectExpr(
            *[f"coalesce(sum(f{i}), 0) as s{i}" for i in range(len(chunk))])
        rows = []
        for i, m in enumerate(chunk):
            for key in [m.key] if m.key else [x.key for x in full]:
                rows.append(_row(table.name, _quoted(key), subject_count=f"s{i}"))
        out.append(counted.selectExpr(f"inline(array({', '.join(rows)}))"))
    if none:
        rows = [_row(table.name, _quoted(m.key), subject_count="0") for m in none]
        out.append(table.data.sparkSession.range(1).selectExpr(f"inline(array({', '.join(rows)}))"))
    return out


def measure_parts(table: Table, measures: Sequence[Measure], row_count: int,
                  row_limit: int | None = None) -> list[DataFrame]:
    """Every statistic asked for, as frames of the STATISTICS shape.  No scan of an empty table.

    For a large table the counts are taken first; what they settle is not scanned for again."""
    if row_count == 0 or not measures:
        return []
    parts = statistics(table, measures, row_count, row_limit)
    limit = COUNT_FIRST_ROWS if row_limit is None else row_limit
    filled: dict[str, int] = {}
    if parts and row_count > limit and table.subject_key and any(m.subjects for m in measures):
        parts = [materialize(union_all(parts))]
        # one row per measure
        filled = {r["key"]: r["n_nonnull"] for r in parts[0].where("n_nonnull is not null").collect()}
    listed = [m for m in measures if m.top > 0 and filled.get(m.key) != 0]
    if listed:
        parts.append(top_values_part(table, listed))
    if table.subject_key and any(m.subjects for m in measures):
        parts.extend(subjects_part(table, measures, filled, row_count))
    return parts


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames with equal columns, paired up so that the plan stays shallow."""
    frames = list(frames)
    while len(frames) > 1:
        frames = [frames[i].union(frames[i + 1]) if i + 1 < len(frames) else frames[i]
                  for i in range(0, len(frames), 2)]
    return frames[0]


def combine(parts: Sequence[DataFrame], skeleton: DataFrame | None = None,
            extra: Sequence[str] = ()) -> DataFrame | None:
    """Merge parts of the same measures: union and one group-by instead of a join per part.

    ``skeleton`` lists (table, key, *extra) rows that must appear whether measured or not."""
    parts = list(parts)
    if not parts and skeleton is None:
        return None
    if parts:
        both = union_all(parts)
        if skeleton is not None:
            both = both.unionByName(skeleton, allowMissingColumns=True)
    else:
        both = skeleton.sparkSession.createDataFrame([], STATISTICS).unionByName(
            skeleton, allowMissingColumns=True)
    fields = [f.name for f in STATISTICS.fields[2:]] + list(extra)
    return both.groupBy("table", "key").agg(*[F.expr(f"max({f})").alias(f) for f in fields])
