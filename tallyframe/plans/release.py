"""Releasing a model: its sections are written as a version, and hard rules decide whether readers get to see it.

The rules are decided by metrics that Spark gathers while the sections are written (``observe``), so they cost no
second scan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyframe.functions import predicates as pr
from tallyframe.operators.checks import ERROR
from tallyframe.plans import audience as au
from tallyframe.plans.model import Model
from tallyframe.sources import sinks

#: A cohort with this status may lack its descriptive fields.
UNFINISHED = "wip"
FINDING = "severity string, rule string, key string, message string"


def _observed(model: Model) -> tuple[Model, Mapping[str, Observation]]:
    seen = {name: Observation(name) for name in ("summary", "tables", "columns")}
    named = lambda field: F.count_if(~pr.blank(F.col(field))).alias(field)
    summary = model.summary.observe(seen["summary"], F.coalesce(F.max("patient_count"), F.lit(0)).alias("patient_count"),
                                    named("provider"), named("disease"))
    sized = {name: frame.observe(seen[name], F.count(F.lit(1)).alias("rows"))
             for name, frame in (("tables", model.tables), ("columns", model.columns))}
    return replace(model, summary=summary, **sized), seen


def failed_rules(model: Model, metrics: Mapping[str, Mapping[str, int]]) -> list[tuple[str, str, str, str]]:
    """Findings of the hard rules: subjects, tables and columns there, provider and disease told."""
    out = []

    def check(good: bool, rule: str, message: str) -> None:
        if not good:
            out.append((ERROR, rule, model.spec.slug or model.spec.cohort, message))

    check(metrics["summary"]["patient_count"] > 0, "no_patients", "patient_count must be above 0")
    for name in ("tables", "columns"):
        check(metrics[name]["rows"] > 0, "empty_section", f"section {name} has no rows")
    if model.spec.status != UNFINISHED:
        for field in ("provider", "disease"):
            check(metrics["summary"][field] > 0, "blank_field", f"{field} must be told")
    return out


def release(model: Model, directory: str, audience: str = "technical", fmt: str = "parquet",
            layout: dict | None = None) -> tuple[dict[str, str], DataFrame]:
    """(paths, findings). The sections become the current version only if no hard rule fails; otherwise the paths
    are those of the version that stays unseen."""
    observed, seen = _observed(model)
    # the audience's view may leave tables out; what it is made from is what counts
    counted = {name: getattr(observed, name) for name in seen}
    schema, spark = model.spec.schema_name, model.summary.sparkSession
    kept = replace(observed, **{name: sinks.materialize(frame) for name, frame in counted.items()})
    paths = sinks.write_version(au.sections(kept, audience, layout), directory, schema, audience, fmt)
    failed = failed_rules(model, {name: seen[name].get for name in seen})
    if not failed:
        sinks.commit(spark, paths, directory, schema, audience, fmt)
    return paths, spark.createDataFrame(failed, FINDING)
