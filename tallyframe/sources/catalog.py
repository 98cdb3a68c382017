"""The variable catalogue: rows of (table, column, predicate, expression) in layers.

Catalogue operators are plain DataFrame transforms, so a catalogue may be any table of
the CATALOG shape.  Only the planner of ``plans.variables`` reads rows on the driver,
because a variable *is* a piece of the plan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyframe.functions import predicates as pr

MATCH = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("name_column", T.StringType()),
    T.StructField("values", T.ArrayType(T.StringType())),
    T.StructField("values_file", T.StringType()),
    T.StructField("concept_ids", T.ArrayType(T.StringType())),
])

TEXT_FIELDS = (
    "category", "variable", "description", "table", "column", "expression", "criteria",
    "inclusion_criteria", "extraction_type", "notes", "coding_schema", "data_source", "proposal",
)
CATALOG = T.StructType(
    [T.StructField("layer", T.StringType()), T.StructField("layer_rank", T.IntegerType()),
     T.StructField("position", T.LongType())]
    + [T.StructField(f, T.StringType()) for f in TEXT_FIELDS]
    + [T.StructField("match", MATCH)])


def catalog_frame(spark: SparkSession, rows: Sequence[Mapping[str, Any]], layer: str = "",
                  layer_rank: int = 0) -> DataFrame:
    """Catalogue rows given as dicts, in order; missing fields are NULL."""
    out = []
    for i, row in enumerate(rows):
        match = row.get("match")
        if isinstance(match, Mapping):
            listed = {k: [str(x) for x in (match.get(k) or [])] for k in ("values", "concept_ids")}
            match = (match.get("column"), match.get("name_column"), listed["values"],
                     match.get("values_file"), listed["concept_ids"])
        else:
            match = None
        out.append((layer, layer_rank, i, *[row.get(f) for f in TEXT_FIELDS], match))
    return spark.createDataFrame(out, CATALOG)


def merge_layers(layers: DataFrame, keys: Sequence[str] = ("category", "variable"),
                 rank: str = "layer_rank", position: str = "position") -> DataFrame:
    """The last layer that defines a key wins; the row keeps the first occurrence's place.

    ``layers`` holds the rows of all layers.  One group-by whose state is one row per key,
    combined map-side, so a key repeated in millions of rows costs one row per task.
    Result: the winning rows plus ``first_rank`` and ``first_position`` to order by."""
    row = F.struct(*[F.col(f"`{c}`") for c in layers.columns])
    order = F.struct(F.col(rank), F.col(position))
    best = layers.groupBy(*[pr.stripped(F.col(k)).alias(f"__{k}") for k in keys]).agg(
        F.max_by(row, order).alias("row"), F.min(order).alias("first"))
    return best.select("row.*", F.col(f"first.{rank}").alias("first_rank"),
                       F.col(f"first.{position}").alias("first_position"))


def resolve_includes(includes: Mapping[str, Sequence[str]], name: str) -> list[str]:
    """Layer names below ``name``, depth first, each once, the layer itself last.

    Missing and circular references are errors."""
    done: list[str] = []

    def visit(layer: str, path: tuple[str, ...]) -> None:
        if layer in path:
            raise ValueError(f"circular include: {' > '.join((*path, layer))}")
        if layer not in includes:
            raise KeyError(f"unknown layer: {layer}")
        if layer in done:
            return
        for below in includes[layer]:
            visit(below, (*path, layer))
        done.append(layer)

    visit(name, ())
    return done


def layered_catalog(spark: SparkSession, layers: Mapping[str, Mapping[str, Any]], name: str) -> DataFrame:
    """Catalogue of a layer with its includes: {name: {include: […], variables: […]}}."""
    order = resolve_includes({k: v.get("include") or [] for k, v in layers.items()}, name)
    frames = [catalog_frame(spark, layers[n].get("variables") or [], n, i) for i, n in enumerate(order)]
    merged = merge_layers(reduce(DataFrame.unionByName, frames))
    return merged.orderBy("first_rank", "first_position")


# ---- value sets

def read_value_list(spark: SparkSession, path: str) -> DataFrame:
    """(value, position) of a value file: text with one value per line, or JSON holding
    a list of strings or an object with a ``values`` list."""
    if not path.endswith(".json"):
        lines = spark.read.text(path).withColumn("position", F.monotonically_increasing_id())
        return lines.select(pr.stripped(F.col("value")).alias("value"), "position").where("value <> ''")
    whole = spark.read.text(path, wholetext=True)
    bare = F.from_json("value", "array<string>")
    keyed = F.from_json("value", "struct<values: array<string>>")["values"]
    values = F.when(F.trim("value").startswith("["), bare).otherwise(keyed)
    return whole.select(F.posexplode(values).alias("position", "value")).select(
        "value", F.col("position").cast("long").alias("position"))


def ordered_union(sources: Sequence[DataFrame]) -> DataFrame:
    """Distinct values of (value, position) lists in first-seen order.

    Result: value, source_rank, position of the first sighting, to order by.  The state is one
    number per source and value, combined map-side: no group ever holds the copies of a hot value."""
    tagged = [s.select("value", F.lit(i).alias("source"), F.col("position").cast("long").alias("position"))
              for i, s in enumerate(sources)]
    both = reduce(DataFrame.unionByName, tagged).where(F.col("value").isNotNull())
    places = [f"p{i}" for i in range(len(sources))]
    first = both.groupBy("value").agg(*[
        F.min(F.when(F.col("source") == i, F.col("position"))).alias(p) for i, p in enumerate(places)])
    rank = F.coalesce(*[F.when(F.col(p).isNotNull(), i) for i, p in enumerate(places)])
    return first.select("value", rank.alias("source_rank"), F.coalesce(*places).alias("position"))


def inline_value_files(spark: SparkSession, catalog: DataFrame, root: str) -> DataFrame:
    """Merge the values of ``match.values_file`` behind the inline values, duplicates dropped."""
    paths = [r["p"] for r in catalog.select(F.col("match.values_file").alias("p"))
             .where("p is not null and trim(p) <> ''").distinct().collect()]
    if not paths:
        return catalog
    files = reduce(DataFrame.unionByName, [
        read_value_list(spark, f"{root.rstrip('/')}/{p}").select(F.lit(p).alias("__path"), "value", "position")
        for p in paths])
    listed = files.groupBy("__path").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("position", "value"))), lambda x: x["value"])
        .alias("__values"))
    joined = catalog.join(listed, F.col("match.values_file") == F.col("__path"), "left")
    empty = F.array().cast("array<string>")
    values = F.array_distinct(F.concat(F.coalesce("match.values", empty), F.coalesce("__values", empty)))
    return joined.withColumn("match", F.when(F.col("match").isNotNull(), F.col("match").withField("values", values)
                                                .withField("values_file", F.lit(None).cast("string")))
                             ).drop("__path", "__values")


def require_inlined(catalog: DataFrame) -> DataFrame:
    """The catalogue; an error if a value set still names a file that nobody has read: measured as it is,
    it would match everything."""
    unread = catalog.where(~pr.blank(F.col("match.values_file"))).select("match.values_file").first()
    if unread:
        raise ValueError(f"values_file {unread[0]!r} is not read: call inline_value_files first")
    return catalog


# ---- resolution of catalogue rows

def effective_criteria(criteria: Column, match: Column) -> Column:
    """Displayed and measured predicate: the value set when it compiles, else the free-form text."""
    strict = pr.match_sql(match)
    return F.when(strict != "", strict).otherwise(pr.stripped(criteria))


def has_scope(criteria: Column, match: Column) -> Column:
    return (pr.stripped(criteria) != "") | (pr.match_sql(match) != "")


# Columns that hold values rather than the concept a row is about.
VALUE_COLUMNS = (
    "value_as_number", "value_as_string", "value_as_concept_id", "value_as_concept_name",
    "value_as_datetime", "value_as_date", "range_low", "range_high", "unit_concept_id",
    "unit_source_value", "quantity", "days_supply", "refills",
)
VALUE_SUFFIXES = ("_date", "_datetime")
NAME_SUFFIX = "_concept_name"
ID_SUFFIX = "_concept_id"
# Fixed value: a concept-name column on the left of a comparison.
COMPARED_NAME = r"(?i)\b([a-z_]+_concept_name)\b\s*(?:ILIKE\b|=|IN\b)"

NO_TABLE = "missing table"
NO_COLUMN = "missing column"
NO_SCOPE = "neither criteria nor a value set: cannot scope a search without changing the variable"


def resolve_scope(catalog: DataFrame, value_columns: Iterable[str] = VALUE_COLUMNS,
                  value_suffixes: Iterable[str] = VALUE_SUFFIXES) -> DataFrame:
    """Add what discovery needs: matcher column, scope, displayed criteria, skip reason.

    Matcher: the value set's column, else, for a row that names a column, the concept name compared in
    the criteria, else the variable's own column unless that holds values or dates.  Scope: the broad criteria before
    the value set, so that values not yet configured can be seen; display is the other way round."""
    own = pr.stripped(F.col("column"))
    explicit = pr.stripped(F.col("match.column"))
    compared = F.regexp_extract(F.coalesce("criteria", F.lit("")), pr.unicode_pattern(COMPARED_NAME), 1)
    is_value = F.lower(own).isin(*value_columns)
    for suffix in value_suffixes:
        is_value = is_value | F.lower(own).endswith(suffix)
    matcher = (F.when(explicit != "", explicit).when(own == "", "").when(compared != "", compared)
               .when(is_value, "").otherwise(own))
    strict, broad = pr.match_sql(F.col("match")), pr.stripped(F.col("criteria"))
    scope = F.when(broad != "", broad).otherwise(strict)
    no_matcher = F.when(own == "", NO_COLUMN).otherwise(F.concat(
        F.lit("column `"), own, F.lit("` is a value/date column; configure `match.column`")))
    skip = (F.when(pr.blank(F.col("table")), NO_TABLE)
            .when(matcher == "", no_matcher)
            .when(scope == "", NO_SCOPE)
            .otherwise(""))
    return (catalog.withColumn("matcher_column", matcher).withColumn("scope_sql", scope)
            .withColumn("displayed_criteria", F.when(strict != "", strict).otherwise(broad))
            .withColumn("skip_reason", skip))


def id_and_name_columns(matcher: Column, display: Column, override: Column) -> tuple[Column, Column]:
    """(id column, name column) of a matcher; both empty when it is neither.

    A display column names an id matcher only when it shares its prefix."""
    override, display = pr.stripped(override), pr.stripped(display)
    matcher = F.coalesce(matcher, F.lit(""))
    from_name = F.regexp_replace(matcher, f"{NAME_SUFFIX}$", "")
    from_id = F.regexp_replace(matcher, f"{ID_SUFFIX}$", "")
    by_name, by_id = matcher.endswith(NAME_SUFFIX), matcher.endswith(ID_SUFFIX)
    # a display column with the matcher's prefix is exactly the derived name
    id_column = F.when(by_name, F.concat(from_name, F.lit(ID_SUFFIX))).when(by_id, matcher).otherwise("")
    name_column = (
        F.when((by_name | by_id) & (override != ""), override)
        .when(by_name, matcher)
        .when(by_id, F.concat(from_id, F.lit(NAME_SUFFIX)))
        .otherwise(""))
    return id_column, name_column
