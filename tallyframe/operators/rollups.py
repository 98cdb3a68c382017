"""Roll-ups of measured variables: by category, per cohort, over a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions.predicates import stripped

HIGH_DROP_PCT = 25.0
UNCATEGORIZED = "Uncategorized"


def implemented() -> Column:
    return F.col("implemented") == "Yes"


def coverage_rollup(variables: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Variables, implemented variables and mean completeness of the implemented ones per category."""
    category = stripped(F.coalesce(F.expr("nullif(category, '')"), F.lit(UNCATEGORIZED)))
    known = F.when(implemented(), F.col("completeness_pct"))
    return (
        variables.groupBy(*by, category.alias("category"))
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(implemented()).alias("implemented"),
             F.avg(known).alias("avg_completeness"))
        .withColumn("implemented_pct", F.lit(100.0) * F.col("implemented") / F.col("total"))
        .select(*by, "category", "total", "implemented", "implemented_pct", "avg_completeness")
        .orderBy(*by, F.lower("category"), "category")
    )


def hero_stats(summary: DataFrame, variables: DataFrame) -> DataFrame:
    """The headline numbers of a cohort: one row."""
    counted = variables.agg(
        F.count(F.lit(1)).alias("variables_total"),
        F.count_if(implemented()).alias("variables_implemented")).withColumn("__one", F.lit(1))
    pct = F.when(F.col("variables_total") > 0,
                 F.lit(100.0) * F.col("variables_implemented") / F.col("variables_total")).otherwise(0.0)
    return (
        summary.select(F.lit(1).alias("__one"), F.col("patient_count").alias("patients"), "years_of_data")
        .join(counted, "__one")
        .withColumn("variables_implemented_pct", pct)
        .select("patients", "years_of_data", "variables_total", "variables_implemented",
                "variables_implemented_pct"))


def category_counts(catalog: DataFrame) -> DataFrame:
    category = F.coalesce("category", F.lit(""))
    return catalog.groupBy(category.alias("category")).agg(F.count(F.lit(1)).alias("n"))


def with_shares(results: DataFrame) -> DataFrame:
    """Implemented and dropped share of a batch row; NULL without variables."""
    some = F.col("variables_total") > 0
    return (
        results
        .withColumn("implemented_pct", F.when(some, F.lit(100.0) * F.col("variables_implemented") / F.col("variables_total")))
        .withColumn("drop_pct", F.when(some, F.lit(100.0) * (F.col("variables_total") - F.col("variables_implemented"))
                                       / F.col("variables_total"))))


def high_drop(results: DataFrame, dry_run: bool = False, at_least: float = HIGH_DROP_PCT) -> DataFrame:
    """Cohorts with many variables without data, worst first; none in a dry run."""
    if dry_run:
        return results.limit(0)
    return (results.where((F.col("status") == "ok") & (F.col("drop_pct") >= at_least))
            .orderBy(F.desc("drop_pct"), "cohort"))


def batch_totals(results: DataFrame) -> DataFrame:
    return results.agg(F.count(F.lit(1)).alias("cohorts"),
                       F.count_if(F.col("status") == "ok").alias("ok"),
                       F.count_if(F.col("status") == "error").alias("errors"))


def profile_drift(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("table", "column")) -> DataFrame:
    """Change of completeness between two profiles: added, removed, changed or same."""
    a = before.select(*keys, F.col("completeness_pct").alias("before_pct"), F.lit(1).alias("__a"))
    b = after.select(*keys, F.col("completeness_pct").alias("after_pct"), F.lit(1).alias("__b"))
    change = F.col("after_pct") - F.col("before_pct")
    status = (F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed")
              .when(F.coalesce(change, F.lit(0.0)) != 0, "changed").otherwise("same"))
    return (a.join(b, list(keys), "full_outer")
            .select(*keys, "before_pct", "after_pct", change.alias("delta_pct"), status.alias("status")))
