"""Inputs of the queries: tables, derived views, configuration.

Derived views are lists of expressions valid in Spark and in ANSI SQL, so that both
sides start from the same rows; everything after that is written twice, independently."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.sources.registry import Registry, Table

# table: [(column, Spark type, kind)]
SCHEMA = {
    "region": [("r_regionkey", "int", "continuous"), ("r_name", "string", "categorical")],
    "nation": [("n_nationkey", "int", "continuous"), ("n_name", "string", "categorical"),
               ("n_regionkey", "int", "continuous")],
    "customer": [("c_custkey", "bigint", "continuous"), ("c_name", "string", "categorical"),
                 ("c_nationkey", "int", "continuous"), ("c_acctbal", "double", "continuous"),
                 ("c_mktsegment", "string", "categorical")],
    "supplier": [("s_suppkey", "bigint", "continuous"), ("s_name", "string", "categorical"),
                 ("s_nationkey", "int", "continuous"), ("s_acctbal", "double", "continuous")],
    "part": [("p_partkey", "bigint", "continuous"), ("p_name", "string", "categorical"),
             ("p_brand", "string", "categorical"), ("p_type", "string", "categorical"),
             ("p_size", "int", "continuous"), ("p_retailprice", "double", "continuous")],
    "orders": [("o_orderkey", "bigint", "continuous"), ("o_custkey", "bigint", "continuous"),
               ("o_orderstatus", "string", "categorical"), ("o_totalprice", "double", "continuous"),
               ("o_orderdate", "timestamp_ntz", "date"), ("o_orderpriority", "string", "categorical")],
    "lineitem": [("l_orderkey", "bigint", "continuous"), ("l_partkey", "bigint", "continuous"),
                 ("l_suppkey", "bigint", "continuous"), ("l_linenumber", "int", "continuous"),
                 ("l_quantity", "double", "continuous"), ("l_extendedprice", "double", "continuous"),
                 ("l_discount", "double", "continuous"), ("l_tax", "double", "continuous"),
                 ("l_returnflag", "string", "categorical"), ("l_linestatus", "string", "categorical"),
                 ("l_shipdate", "timestamp_ntz", "date")],
    "events": [("event_id", "bigint", "continuous"), ("ts", "timestamp_ntz", "date"),
               ("user_id", "bigint", "continuous"), ("event_type", "string", "categorical"),
               ("value", "double", "continuous"), ("props", "string", "unstructured")],
    "documents": [("doc_id", "bigint", "continuous"), ("text", "string", "unstructured"),
                  ("lang", "string", "categorical"), ("source", "string", "categorical"),
                  ("n_chars", "bigint", "continuous")],
    "embeddings": [("vec_id", "bigint", "continuous"), ("embedding", "array<float>", "unstructured"),
                   ("label", "int", "continuous")],
    "pages": [("page_id", "bigint", "continuous"), ("url", "string", "categorical"),
              ("html", "string", "unstructured")],
    "benchmark": [("item_id", "bigint", "continuous"), ("text", "string", "unstructured")],
    "labels": [("doc_id", "bigint", "continuous"), ("quality", "int", "continuous"),
               ("toxic", "int", "continuous")],
    "conversations": [("conv_id", "bigint", "continuous"), ("turn", "bigint", "continuous"),
                      ("role", "string", "categorical"), ("text", "string", "unstructured")],
}
TABLES = tuple(SCHEMA)
SUBJECT_KEYS = {"customer": "c_custkey", "orders": "o_custkey", "orders_n": "o_custkey",
                "events": "user_id", "events_n": "user_id", "events_c": "user_id"}
KEY_SUFFIXES = ("key", "_id")

# view: (base table, expressions)
VIEWS = {
    "events_n": ("events", [
        "event_id", "ts", "user_id", "nullif(event_type, 'error') as event_type",
        "case when value < 5 then null else value end as value", "props"]),
    "orders_n": ("orders", [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        "case when o_totalprice < 20000 then null else o_orderdate end as o_orderdate",
        "nullif(o_orderpriority, '5-LOW') as o_orderpriority"]),
    "events_c": ("events", [
        "event_id", "user_id", "event_type as event_concept_name",
        "case event_type when 'click' then 101 when 'error' then 102 when 'purchase' then 103 "
        "when 'signup' then 104 else 105 end as event_concept_id",
        "value as value_as_number", "ts as event_date"]),
    "notes": ("documents", ["doc_id", "text as note_text", "source as origin_note", "lang"]),
    "nobody": ("region", ["r_regionkey", "r_name"]),
}
VIEW_FILTERS = {"nobody": "r_regionkey < 0"}
VIEW_SCHEMA = {
    "events_n": SCHEMA["events"],
    "orders_n": SCHEMA["orders"],
    "nobody": SCHEMA["region"],
    "notes": [("doc_id", "bigint", "continuous"), ("note_text", "string", "unstructured"),
              ("origin_note", "string", "unstructured"), ("lang", "string", "categorical")],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    base, expressions = VIEWS[name]
    out = spark.read.parquet(f"{sf_dir}/{base}.parquet")
    if name in VIEW_FILTERS:
        out = out.where(VIEW_FILTERS[name])
    return out.selectExpr(*expressions)


def columns(name: str) -> list[tuple[str, str, str]]:
    return VIEW_SCHEMA.get(name) or SCHEMA[name]


def retail(spark: SparkSession, sf_dir: str, *names: str, schema_name: str = "retail") -> Registry:
    """Registry of the named tables and views; the customers are the subjects."""
    tables = []
    for n in names:
        base = VIEWS[n][0] if n in VIEWS else n
        kinds = {c: k for c, _, k in SCHEMA[base] if k == "unstructured"} if n != "notes" else {}
        tables.append(Table(n, table(spark, sf_dir, n), SUBJECT_KEYS.get(n), kinds,
                            "VIEW" if n in VIEWS else "TABLE"))
    return Registry(spark, schema_name, tables, subject_table="customer", key_suffixes=KEY_SUFFIXES)


def with_views(sql: str) -> str:
    """Prefix a statement with the derived views it mentions."""
    import re
    used = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql
    ctes = []
    for n in used:
        base, expressions = VIEWS[n]
        where = f" where {VIEW_FILTERS[n]}" if n in VIEW_FILTERS else ""
        ctes.append(f"{n} as (select {', '.join(expressions)} from {base}{where})")
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {', '.join(ctes)}, {body[5:]}"
    return f"with {', '.join(ctes)} {body}"


def union(parts) -> str:
    return " union all ".join(parts)


def is_key(column: str) -> bool:
    return column.endswith(KEY_SUFFIXES)
