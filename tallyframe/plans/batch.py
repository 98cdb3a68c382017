"""Many cohorts or schemas in one run; a bad one does not stop the rest."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.functions.errors import is_data_error, isolated
from tallyframe.operators import rollups
from tallyframe.operators.measures import union_all
from tallyframe.plans import audience as au, model as md, profile as pf, variables as vb
from tallyframe.plans.model import CohortSpec, Enrichment, Model
from tallyframe.sources import sinks
from tallyframe.sources.registry import Registry

RESULT = ("cohort string, schema_name string, status string, error string, patient_count long, "
          "table_count int")
RESULT_COLUMNS = ("cohort", "schema_name", "status", "error", "patient_count", "table_count",
                  "variables_total", "variables_implemented", "implemented_pct", "drop_pct",
                  "warning_count")


@dataclass(frozen=True)
class Job:
    """One cohort of a batch.  ``open`` returns its registry and catalogue and may fail."""
    spec: CohortSpec
    open: Callable[[SparkSession], tuple[Registry, DataFrame]]


def _reason(error: Exception) -> str:
    lines = [x for x in str(error).splitlines() if x.strip()]
    return f"{type(error).__name__}: {lines[0] if lines else ''}"


def build_models(spark: SparkSession, jobs: Iterable[Job], config: Enrichment | None = None,
                 dry_run: bool = False) -> tuple[dict[str, Model], dict[str, str]]:
    """Model per cohort slug, and the error of each cohort that could not be planned."""
    models, errors = {}, {}
    for job in jobs:
        try:
            registry, catalog = job.open(spark)
            models[job.spec.slug] = md.build_model(job.spec, registry, catalog, config, dry_run)
        except Exception as e:
            errors[job.spec.slug] = _reason(e)
    return models, errors


def _failed(job: Job, error: Exception) -> tuple:
    return job.spec.slug, job.spec.schema_name, "error", _reason(error), None, 0


def _implemented_counts(slug: str, found: DataFrame) -> DataFrame:
    return found.agg(
        F.count(F.lit(1)).alias("variables_total"),
        F.count_if(rollups.implemented()).alias("variables_implemented"),
        F.count_if(F.col("error") != "").alias("warning_count"),
    ).select(F.lit(slug).alias("cohort"), "*")


def _count_cohorts(spark: SparkSession, planned: dict, jobs: dict, rows: dict) -> DataFrame:
    """Count all cohorts in one run; if that fails, one by one, recording the failing ones."""
    if not planned:
        return spark.createDataFrame(
            [], "cohort string, variables_total long, variables_implemented long, warning_count long")
    try:
        return sinks.materialize(union_all([counts for _, _, counts in planned.values()]))
    except Exception as e:
        if not is_data_error(e):
            raise
        kept = []
        for slug, (registry, catalog, _) in planned.items():
            try:
                found = vb.variable_profile(registry, catalog, parts={"counts"}, isolate=True)
                kept.append(sinks.materialize(_implemented_counts(slug, found)))
            except Exception as e:
                if not is_data_error(e):
                    raise
                rows[slug] = _failed(jobs[slug], e)
        return _count_cohorts(spark, {}, jobs, rows) if not kept else union_all(kept)


def batch_results(spark: SparkSession, jobs: Sequence[Job], dry_run: bool = False) -> DataFrame:
    """One row per cohort: subjects, tables, variables, implemented share, dropped share, warnings.

    Counts come from the unfiltered model.  All cohorts are measured in one union."""
    planned = {}
    rows = {}
    for job in jobs:
        slug = job.spec.slug
        try:
            registry, catalog = job.open(spark)
            found = vb.dry_run(catalog) if dry_run else vb.variable_profile(registry, catalog, parts={"counts"})
            patients = None if dry_run else registry.subject_total()
            rows[slug] = (slug, job.spec.schema_name, "ok", "", patients, 0 if dry_run else len(registry.tables))
            planned[slug] = (registry, catalog, _implemented_counts(slug, found))
        except Exception as e:
            rows[slug] = _failed(job, e)
    counted = _count_cohorts(spark, planned, {job.spec.slug: job for job in jobs}, rows)
    cohorts = spark.createDataFrame(list(rows.values()), RESULT)
    zero = F.lit(0).cast("long")
    joined = cohorts.join(counted, "cohort", "left").withColumns({
        c: F.coalesce(c, zero) for c in ("variables_total", "variables_implemented", "warning_count")})
    return rollups.with_shares(joined).select(*RESULT_COLUMNS).orderBy("cohort")


def write_batch(spark: SparkSession, jobs: Iterable[Job], directory: str,
                audiences: Sequence[str] = ("technical",), config: Enrichment | None = None,
                fmt: str = "parquet", dry_run: bool = False) -> tuple[dict[str, list[str]], dict[str, str]]:
    """Measure each cohort once, write every audience's sections from the same model.

    Returns the written paths and the errors, both by cohort slug."""
    paths, errors = {}, {}
    layout = (config or Enrichment()).layout
    for job in jobs:
        slug = job.spec.slug
        try:
            registry, catalog = job.open(spark)
            model = md.build_model(job.spec, registry, catalog, config, dry_run)
            written = []
            for audience in audiences:
                written += sinks.write_sections(au.sections(model, audience, layout), directory,
                                                job.spec.schema_name, audience, fmt).values()
                path = sinks.write_model_json(md.document(au.view(model, audience, layout)), directory,
                                              job.spec.schema_name, audience)
                written += [path] if path else []
            paths[slug] = written
        except Exception as e:
            errors[slug] = _reason(e)
    return paths, errors


def schema_sweep(spark: SparkSession, schemas: Mapping[str, Callable[[], Registry]],
                 parts: Iterable[str] = pf.ALL_PARTS) -> tuple[DataFrame | None, dict[str, str]]:
    """Basic profile of several schemas as one frame, computed and kept; a schema that cannot be opened, or that
    fails while its rows are read, is skipped with the reason.

    All schemas are profiled in one run; only if it fails they are isolated."""
    planned, skipped = {}, {}
    for name, opened in schemas.items():
        try:
            planned[name] = pf.column_profile(opened(), parts=frozenset(parts), basic=True)
        except Exception as e:
            skipped[name] = _reason(e)
    found, faults = isolated(list(planned), lambda some: sinks.materialize(union_all([planned[n] for n in some])))
    skipped.update(faults)
    return (union_all(found) if found else None), skipped


def combined(profiles: Mapping[str, DataFrame]) -> DataFrame:
    """Profiles of several schemas side by side, with a source flag."""
    return union_all([f.withColumn("source", F.lit(n)) for n, f in profiles.items()])
