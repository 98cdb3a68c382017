"""Display text, computed over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from showcase.inputs import retail, table, with_views
from tallyframe.functions import text
from tallyframe.plans import profile as pf


def number_sql(v: str) -> str:
    return (f"(case when {v} is null then '—' when {v} = floor({v}) and abs({v}) < 1e15 "
            f"then cast(cast({v} as bigint) as varchar) else format('{{:.3g}}', {v}) end)")


def percent_sql(v: str) -> str:
    return f"(case when {v} is null then '—' else format('{{:.1f}}%', {v}) end)"


def format_numbers(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rows.select(
        "l_orderkey", "l_linenumber", F.expr(text.numbers(
            "l_extendedprice", "l_extendedprice * l_discount / 7", "l_tax / 1000", "l_quantity")).alias("t")
    ).selectExpr("l_orderkey", "l_linenumber", "t[0] as price", "t[1] as share", "t[2] as small", "t[3] as quantity")


FORMAT_NUMBERS = (
    f"select l_orderkey, l_linenumber, {number_sql('l_extendedprice')} as price, "
    f"{number_sql('(l_extendedprice * l_discount / 7)')} as share, {number_sql('(l_tax / 1000)')} as small, "
    f"{number_sql('l_quantity')} as quantity from lineitem")


def format_percent(spark, sf):
    rows = table(spark, sf, "events_n")
    return rows.selectExpr("event_id", f"{text.percent('value')} as value_pct",
                           f"{text.percent('(100D * value / 640D)')} as share_pct")


FORMAT_PERCENT = (f"select event_id, {percent_sql('value')} as value_pct, "
                  f"{percent_sql('(100.0::double * value / 640.0::double)')} as share_pct from events_n")


def numeric_summary_text(spark, sf):
    found = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.min("l_extendedprice").alias("a"), F.max("l_extendedprice").alias("b"),
        F.round(F.avg("l_extendedprice"), 4).alias("c"), F.round(F.stddev_samp("l_extendedprice"), 4).alias("d"))
    return found.selectExpr("l_suppkey", f"{text.numeric_summary('a', 'b', 'c', 'd')} as summary")


NUMERIC_SUMMARY = (
    "select l_suppkey, 'Min: ' || " + number_sql("a") + " || ', Max: ' || " + number_sql("b")
    + " || ', Mean: ' || " + number_sql("c") + " || ' (std: ' || " + number_sql("d") + " || ')' as summary from ("
    "select l_suppkey, min(l_extendedprice) as a, max(l_extendedprice) as b, round(avg(l_extendedprice), 4) as c, "
    "round(stddev_samp(l_extendedprice), 4) as d from lineitem group by l_suppkey) as g")


def _median(spark, sf, render):
    found = pf.column_profile(retail(spark, sf, "orders", "lineitem", "customer"), parts={"quartiles"})
    # rounded, because engines join the two neighbours of a position with different last bits
    found = found.where("median is not null").withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})
    return found.selectExpr("table", "column", f"{render('q1', 'median', 'q3')} as median_iqr")


def median_iqr_text(spark, sf):
    return _median(spark, sf, text.median_iqr)


def variable_median_text(spark, sf):
    return _median(spark, sf, text.variable_median)


def _median_sql(show, dash) -> str:
    out = []
    for t, cs in (("orders", ["o_totalprice"]), ("customer", ["c_acctbal"]),
                  ("lineitem", ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"])):
        for c in cs:
            a, b, d = (show(f"round(quantile_cont({c}, {p})::double, 4)") for p in (0.25, 0.5, 0.75))
            out.append(f"select '{t}' as \"table\", '{c}' as \"column\", 'Median: ' || {b} || ' (IQR: ' || {a} || "
                       f"'{dash}' || {d} || ')' as median_iqr from {t}")
    return " union all ".join(out)


def _plain_sql(v: str) -> str:
    return (f"(case when {v} = floor({v}) and abs({v}) < 1e15 then cast(cast({v} as bigint) as varchar) "
            f"else cast({v} as varchar) end)")


def date_range_text(spark, sf):
    found = table(spark, sf, "orders_n").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("string").alias("a"), F.max("o_orderdate").cast("string").alias("b"))
    return found.selectExpr("o_custkey", f"{text.date_range('a', 'b')} as dates")


DATE_RANGE = ("select o_custkey, coalesce('Min: ' || min(o_orderdate)::varchar || ', Max: ' || "
              "max(o_orderdate)::varchar, '') as dates from orders_n group by o_custkey")

# a label longer than the cut-off, from the text itself
LONG = "case when p_size > 40 then p_name || ' ' || p_type || ' ' || p_brand || ' of the collection of rare items of the year' else p_name end"


def _named_parts(spark, sf):
    return table(spark, sf, "part").selectExpr("p_brand", f"{LONG} as label").groupBy("p_brand", "label").agg(
        F.count(F.lit(1)).alias("n"))


def _label_lists(spark, sf, limit):
    """Most frequent labels per brand as (value, n) lists, with the brand's row count."""
    from pyspark.sql import Window
    counts = _named_parts(spark, sf)
    order = Window.partitionBy("p_brand").orderBy(F.desc("n"), "label")
    totals = counts.groupBy("p_brand").agg(F.sum("n").alias("total"))
    listed = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit).groupBy("p_brand").agg(
        F.sort_array(F.collect_list(F.struct("rank", F.col("label").alias("value"), "n"))).alias("l"))
    listed = listed.withColumn("top", F.expr("transform(l, x -> struct(x.value as value, x.n as n))"))
    return listed.join(totals, "p_brand").select("p_brand", "top", "total")


def _label_sql(limit: int, cell: str, joiner: str = "; ") -> str:
    return (
        f"select p_brand, string_agg({cell}, '{joiner}' order by n desc, label) as cell from ("
        f"select p_brand, label, n, sum(n) over (partition by p_brand) as total, "
        f"row_number() over (partition by p_brand order by n desc, label) as rank from ("
        f"select p_brand, {LONG} as label, count(*) as n from part group by 1, 2) as c) as r "
        f"where rank <= {limit} group by p_brand")


CUT = "case when length(label) <= 60 then label else substring(label, 1, 57) || '...' end"
SHARE = "' (' || format('{:.1f}%', 100.0::double * n / total) || ')'"


def value_distribution_text(spark, sf):
    return _label_lists(spark, sf, 5).selectExpr("p_brand", f"{text.value_distribution('top', 'total')} as cell")


def variable_distribution_text(spark, sf):
    return _label_lists(spark, sf, 10).selectExpr(
        "p_brand", f"{text.variable_distribution('top', 'total')} as cell")


def distribution_cell(spark, sf):
    """Half of the brands have no distribution text and fall back to value and count."""
    lists = _label_lists(spark, sf, 5)
    given = f"if(p_brand < 'Brand#2', {text.value_distribution('top', 'total')}, '')"
    return lists.selectExpr("p_brand", f"{text.distribution_cell(given, 'top')} as cell")


def values_cell(spark, sf):
    return _label_lists(spark, sf, 20).selectExpr("p_brand", f"{text.values_cell('top')} as cell")


def observed_values_cell(spark, sf):
    return _label_lists(spark, sf, 20).selectExpr(
        "p_brand", f"{text.observed_values(text.top_labels('top'))} as cell")


def example_value(spark, sf):
    from tallyframe.plans.model import column_display
    found = column_display(pf.column_profile(
        retail(spark, sf, "orders_n", "events_n"), parts={"spread", "dates", "top"}))
    return found.select("table", "column", "example")


def _example_sql() -> str:
    from showcase.inputs import columns, is_key
    out = []
    for t in ("orders_n", "events_n"):
        for c, _, k in columns(t):
            if k == "continuous" and not is_key(c):
                v = number_sql(f"min({c})")
            elif k == "date":
                v = f"cast(min({c}) as varchar)"
            elif k == "categorical":
                v = (f"(select {c} from {t} where {c} is not null group by {c} "
                     f"order by count(*) desc, {c} limit 1)")
            else:
                v = "''"
            out.append(f"select '{t}' as \"table\", '{c}' as \"column\", {v} as example from "
                       + (t if v != "''" and k != "categorical" else "(select 1) as one"))
    return " union all ".join(out)


def clean_array_map(spark, sf):
    given = "map('lang', concat('  ', lang, ' '), 'source', concat(source, '  '))"
    found = table(spark, sf, "documents").selectExpr(
        "doc_id", f"{text.clean_list('split(text, \'[.]\')')} as items", f"{text.clean_map(given)} as m")
    return found.select("doc_id", F.size("items").cast("long").alias("n_items"),
                        F.md5(F.array_join("items", "|")).alias("items_md5"),
                        F.col("m")["lang"].alias("lang"), F.col("m")["source"].alias("source"))


CLEAN = r"""
select doc_id, len(items) as n_items, md5(array_to_string(items, '|')) as items_md5, lang, source from (
  select doc_id, list_filter(list_transform(string_split(text, '.'),
           lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') as items,
         trim('  ' || lang || ' ') as lang, trim(source || '  ') as source
  from documents) as d"""

QUERIES = {
    "format_numbers": (format_numbers, FORMAT_NUMBERS),
    "format_percent": (format_percent, FORMAT_PERCENT),
    "numeric_summary_text": (numeric_summary_text, NUMERIC_SUMMARY),
    "median_iqr_text": (median_iqr_text, _median_sql(number_sql, "–")),
    "variable_median_text": (variable_median_text, _median_sql(_plain_sql, "-")),
    "date_range_text": (date_range_text, DATE_RANGE),
    "value_distribution_text": (value_distribution_text, _label_sql(5, f"{CUT} || ': ' || n || {SHARE}")),
    "variable_distribution_text": (variable_distribution_text, _label_sql(10, f"label || ': ' || n || {SHARE}")),
    "distribution_cell": (distribution_cell, _label_sql(
        5, f"{CUT} || ': ' || n || case when p_brand < 'Brand#2' then {SHARE} else '' end")),
    "values_cell": (values_cell, _label_sql(10, "label", ", ")),
    "observed_values_cell": (observed_values_cell, _label_sql(10, "label", "\n")),
    "example_value": (example_value, _example_sql()),
    "clean_array_map": (clean_array_map, CLEAN),
}
QUERIES = {k: (f, with_views(s)) for k, (f, s) in QUERIES.items()}
