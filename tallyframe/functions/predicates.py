"""Row predicates: free-form SQL fragments and configured value sets."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# Above this many values a set is matched by a join instead of an IN list.
IN_LIST_LIMIT = 1000
# A longer set is broadcast up to this size, which is measured first.
BROADCAST_BYTES = 32 * 1024 * 1024

_QUOTED = re.compile(r"('(?:[^']|'')*')")


def to_spark_sql(fragment: str) -> str:
    """Spark spelling of a warehouse SQL fragment: casts to text, double-quoted
    identifiers, and backslashes that are plain characters inside literals."""
    parts = _QUOTED.split(fragment)
    for i, part in enumerate(parts):
        if i % 2:
            parts[i] = part.replace("\\", "\\\\")
        else:
            part = re.sub(r"::\s*(text|varchar)\b", "::string", part, flags=re.IGNORECASE)
            parts[i] = re.sub(r'"([^"]+)"', r"`\1`", part)
    return "".join(parts)


def condition(fragment: str | None) -> Column | None:
    """The fragment as one parenthesised condition; None when there is none."""
    fragment = (fragment or "").strip()
    return F.expr(f"({to_spark_sql(fragment)})") if fragment else None


def expression(fragment: str) -> Column:
    return F.expr(to_spark_sql(fragment))


def column(name: str) -> Column:
    return F.col(f"`{name}`")


# Fixed value: what counts as white space at the ends of a text, Unicode's and the separators 1C to 1F.
BLANKS = r"[\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


def unicode_pattern(pattern: str) -> str:
    r"""The pattern with ``\s``, ``\b``, ``\w`` and the case of letters as Unicode has them, and ``.`` stopping at a
    line feed only, so that a no-break space or an accented letter counts as what it looks like."""
    spaced = re.sub(r"(?<!\\)((?:\\\\)*)\\s", lambda m: m.group(1) + r"[\s\x1C-\x1F]", pattern)
    return "(?U)(?d)" + spaced


def blank(c: Column) -> Column:
    """NULL, empty, or nothing but white space."""
    return stripped(c) == ""


def stripped(c: Column) -> Column:
    """Text without surrounding white space, empty instead of NULL."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), rf"\A{BLANKS}+|{BLANKS}+\z", "")


# ---- value sets as catalogue columns: struct<column, name_column, values, values_file, concept_ids>

def configured_ids(match: Column) -> Column:
    """Integer ids in first-seen order; entries that are no integers are dropped."""
    ids = F.transform(F.coalesce(match["concept_ids"], F.array().cast("array<string>")),
                      lambda x: stripped(x).try_cast("bigint"))
    return F.array_distinct(F.filter(ids, lambda x: x.isNotNull()))


def configured_values(match: Column) -> Column:
    """String values in first-seen order (values of a file are merged in by the catalogue)."""
    return F.array_distinct(F.coalesce(match["values"], F.array().cast("array<string>")))


def match_sql(match: Column) -> Column:
    """Displayed predicate of a value set, ``"col" IN (…)``; empty when it does not compile.

    A non-empty id list takes precedence and never falls back to the strings."""
    name = stripped(match["column"])
    ids, values = configured_ids(match), configured_values(match)
    has_ids = F.coalesce(F.size(match["concept_ids"]), F.lit(0)) > 0
    quoted = F.transform(values, lambda v: F.concat(F.lit("'"), F.replace(v, F.lit("'"), F.lit("''")), F.lit("'")))

    def in_list(items: Column) -> Column:
        return F.concat(F.lit('"'), name, F.lit('" IN ('), F.array_join(items, ", "), F.lit(")"))

    return (
        F.when(match.isNull() | (name == ""), "")
        .when(has_ids, F.when(F.size(ids) > 0, in_list(ids.cast("array<string>"))).otherwise(""))
        .when(F.size(values) > 0, in_list(quoted))
        .otherwise("")
    )


def in_values(c: Column, values: list) -> Column:
    return c.isin(list(dict.fromkeys(values)))


def value_keys(values: DataFrame, name: str = "__value") -> DataFrame:
    """Distinct non-null values of a one-column frame, broadcast when counted to be small."""
    column_name = values.columns[0]
    keys = values.select(F.col(f"`{column_name}`").alias(name)).where(F.col(name).isNotNull()).distinct()
    size = keys.agg(F.coalesce(F.sum(F.octet_length(F.col(name).cast("string")) + 16), F.lit(0))).first()[0]
    return F.broadcast(keys) if size <= BROADCAST_BYTES else keys


def with_membership(df: DataFrame, name: str, values: DataFrame, flag: str) -> DataFrame:
    """Add a flag "``name`` is in ``values``" (one-column frame) for sets too long for IN.

    A left join on distinct values.  Beyond the broadcast size both sides are shuffled, where
    adaptive execution splits a hot value."""
    joined = df.join(value_keys(values), column(name) == F.col("__value"), "left")
    return joined.withColumn(flag, F.col("__value").isNotNull()).drop("__value")


def match_filter(df: DataFrame, name: str, values: list | DataFrame) -> DataFrame:
    """Rows whose column is in the set: IN list when short, semi join when long."""
    if isinstance(values, list) and len(values) <= IN_LIST_LIMIT:
        return df.where(in_values(column(name), values))
    if isinstance(values, list):
        kind = df.schema[name].dataType
        values = df.sparkSession.createDataFrame([(v,) for v in dict.fromkeys(values)], "value string")
        values = values.select(F.col("value").cast(kind).alias("value"))
    return df.join(value_keys(values), column(name) == F.col("__value"), "left_semi")
