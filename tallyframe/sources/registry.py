"""Table registry: the set of tables of one schema and what is known about them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyframe.functions import kinds

INVENTORY = T.StructType([
    T.StructField("schema", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("ordinal", T.IntegerType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("nullable", T.BooleanType()),
    T.StructField("row_count", T.LongType()),
])


@dataclass(frozen=True)
class Table:
    name: str
    data: DataFrame
    subject_key: str | None = None
    kinds: Mapping[str, str] = field(default_factory=dict)
    object_type: str = "TABLE"

    def kind(self, column: str) -> str:
        return kinds.field_kind(self.data.schema[column], self.kinds.get(column))

    def has_column(self, column: str) -> bool:
        return column in self.data.columns


class Registry:
    """Tables by name.  ``subject_table`` holds one row per subject of the cohort."""

    def __init__(self, spark: SparkSession, schema_name: str, tables: Iterable[Table],
                 subject_table: str | None = None,
                 key_suffixes: Iterable[str] = kinds.KEY_SUFFIXES,
                 key_names: Iterable[str] = kinds.KEY_NAMES):
        self.spark = spark
        self.schema_name = schema_name
        self.tables = {t.name: t for t in sorted(tables, key=lambda t: t.name)}
        self.subject_table = subject_table
        self.key_suffixes = tuple(key_suffixes)
        self.key_names = tuple(key_names)
        self._row_counts: dict[str, int] = {}

    @classmethod
    def from_parquet(cls, spark: SparkSession, schema_name: str, directory: str,
                     names: Iterable[str], subject_keys: Mapping[str, str] | None = None,
                     kind_overrides: Mapping[str, Mapping[str, str]] | None = None,
                     **options) -> "Registry":
        subject_keys, kind_overrides = subject_keys or {}, kind_overrides or {}
        return cls(spark, schema_name, [
            Table(n, spark.read.parquet(f"{directory}/{n}.parquet"),
                  subject_keys.get(n), kind_overrides.get(n, {}))
            for n in names
        ], **options)

    @classmethod
    def from_database(cls, spark: SparkSession, database: str, subject_key: str | None = None,
                      kind_overrides: Mapping[str, Mapping[str, str]] | None = None,
                      **options) -> "Registry":
        """All tables and views of a database; a table has subjects iff it has the key column."""
        kind_overrides = kind_overrides or {}
        tables = []
        for entry in spark.catalog.listTables(database):
            if entry.isTemporary:
                continue
            data = spark.table(f"`{database}`.`{entry.name}`")
            tables.append(Table(
                entry.name, data,
                subject_key if subject_key in data.columns else None,
                kind_overrides.get(entry.name, {}),
                "VIEW" if entry.tableType == "VIEW" else "TABLE",
            ))
        return cls(spark, database, tables, **options)

    def select(self, names: Iterable[str]) -> list[Table]:
        return [self.tables[n] for n in sorted(names)]

    def row_counts(self, names: Iterable[str] | None = None) -> dict[str, int]:
        """Row count per table, one job for all tables not yet counted.

        Parquet answers this from file footers, without reading a column."""
        names = sorted(self.tables if names is None else names)
        missing = [n for n in names if n not in self._row_counts]
        if missing:
            counts = reduce(DataFrame.unionAll, [
                self.tables[n].data.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("t"), "n")
                for n in missing
            ])
            self._row_counts.update({r["t"]: r["n"] for r in counts.collect()})
        return {n: self._row_counts[n] for n in names}

    def subject_total(self) -> int | None:
        """Rows of the subject table; None when the schema has none."""
        if self.subject_table is None or self.subject_table not in self.tables:
            return None
        return self.row_counts([self.subject_table])[self.subject_table]

    def is_surrogate_key(self, column: str) -> bool:
        return kinds.name_is_surrogate_key(column, self.key_suffixes, self.key_names)

    def list_tables(self) -> DataFrame:
        """(schema, table, object_type, column_count, row_count), by table name."""
        counts = self.row_counts()
        rows = [(self.schema_name, t.name, t.object_type, len(t.data.columns), counts[t.name])
                for t in self.tables.values()]
        return self.spark.createDataFrame(
            rows, "schema string, table string, object_type string, column_count int, row_count long")

    def inventory(self, names: Iterable[str] | None = None, counted: bool = True) -> DataFrame:
        """One row per column, in ordinal order: the skeleton of every profile. Without ``counted`` no table
        is read and the row count is NULL."""
        names = sorted(self.tables if names is None else names)
        counts = self.row_counts(names) if counted else dict.fromkeys(names)
        rows = []
        for n in counts:
            t = self.tables[n]
            for i, f in enumerate(t.data.schema.fields, start=1):
                rows.append((self.schema_name, n, f.name, i, f.dataType.simpleString(),
                             t.kind(f.name), f.nullable, counts[n]))
        return self.spark.createDataFrame(rows, INVENTORY)


def schema_object_counts(spark: SparkSession, registries: Iterable[Registry | str]) -> DataFrame:
    """Tables and views per schema; a plain name stands for a schema without objects."""
    registries = list(registries)
    schemas = spark.createDataFrame(
        [(r if isinstance(r, str) else r.schema_name,) for r in registries], "schema string")
    listed = [r.list_tables() for r in registries if not isinstance(r, str)]
    objects = reduce(DataFrame.unionByName, listed) if listed else spark.createDataFrame(
        [], "schema string, object_type string, row_count long")
    return (
        schemas.join(objects, "schema", "left")
        .groupBy("schema")
        .agg(F.count_if(F.col("object_type") == "TABLE").alias("table_count"),
             F.count_if(F.col("object_type") == "VIEW").alias("view_count"),
             F.coalesce(F.sum("row_count"), F.lit(0).cast("long")).alias("row_count"))
    )


# Schemas that belong to the warehouse itself.
SYSTEM_SCHEMAS = ("information_schema", "pg_catalog", "sys")


def database_object_counts(spark: SparkSession) -> DataFrame:
    """The same listing for the databases of the session catalog (metadata only)."""
    names = [d.name for d in spark.catalog.listDatabases() if d.name not in SYSTEM_SCHEMAS]
    objects = [(n, "VIEW" if t.tableType == "VIEW" else "TABLE")
               for n in names for t in spark.catalog.listTables(n) if not t.isTemporary]
    schemas = spark.createDataFrame([(n,) for n in names], "schema string")
    listed = spark.createDataFrame(objects, "schema string, object_type string")
    return (
        schemas.join(listed, "schema", "left").groupBy("schema")
        .agg(F.count_if(F.col("object_type") == "TABLE").alias("table_count"),
             F.count_if(F.col("object_type") == "VIEW").alias("view_count"))
    )
