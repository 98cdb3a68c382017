"""Writing results, and cutting lineage of intermediate ones."""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

# Audiences that never receive the full model.
NO_JSON_AUDIENCES = ("customer", "sales")


#: Frames that ``stored`` has written for each open ``cleared`` block.
_written: list[list[DataFrame]] = []


def work_folder(spark: SparkSession) -> str:
    """Folder of intermediate tables: ``spark.checkpoint.dir``, or where that is unset a folder of the warehouse. On
    a cluster, a warehouse in a folder of one machine is refused."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and (warehouse.startswith("file:") or ":" not in warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse}/_work"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(work_folder(spark))


def materialize(df: DataFrame) -> DataFrame:
    """Computed once and kept in reliable storage, so that a lost executor costs no rescan."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Written once as Parquet in the work folder and read from there: lineage ends here."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    if _written:
        _written[-1].append(out)
    return out


@contextlib.contextmanager
def cleared() -> Iterator[list[DataFrame]]:
    """What ``stored`` writes inside the block is deleted at its end, but for the frames put in the list."""
    kept: list[DataFrame] = []
    _written.append([])
    try:
        yield kept
    finally:
        made, staying = _written.pop(), {f.stored_path for f in kept}
        discard(*[f for f in made if f.stored_path not in staying])
        if _written:
            _written[-1].extend(kept)


def discard(*frames: DataFrame) -> None:
    """Delete what ``stored`` wrote for frames that nothing reads any more."""
    for frame in frames:
        context = frame.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(frame.stored_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def dictionary_name(schema_name: str, audience: str = "technical") -> str:
    suffix = "" if audience == "technical" else f"_{audience}"
    return f"{schema_name}_dictionary{suffix}"


def _folder(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a folder."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(context._jsc.hadoopConfiguration()), at


def _manifest_folder(directory: str, schema_name: str, audience: str) -> str:
    return f"{directory.rstrip('/')}/{dictionary_name(schema_name, audience)}.manifests"


def _manifests(spark: SparkSession, folder: str) -> list[int]:
    system, at = _folder(spark, folder)
    if not system.exists(at):
        return []
    names = [f.getPath().getName() for f in system.listStatus(at)]
    return sorted(int(n) for n in names if n.isdigit())


def write_version(sections: Mapping[str, DataFrame], directory: str, schema_name: str,
                  audience: str = "technical", fmt: str = "parquet") -> dict[str, str]:
    """Write each section to ``<dir>/_versions/<new>/<schema>_dictionary[_<audience>]/<section>``. Readers see them
    only after ``commit``."""
    stem = f"{directory.rstrip('/')}/_versions/{uuid.uuid4().hex}/{dictionary_name(schema_name, audience)}"
    paths = {}
    for name, frame in sections.items():
        paths[name] = f"{stem}/{name}"
        writer = frame.write
        if fmt == "csv":
            writer = writer.option("header", True).option("quoteAll", True).option("escape", '"')
        writer.format(fmt).save(paths[name])
    return paths


def commit(spark: SparkSession, paths: Mapping[str, str], directory: str, schema_name: str,
           audience: str = "technical", fmt: str = "parquet") -> int:
    """Make a written version the current one: a manifest with the next number. The manifest appears by a rename
    that fails if another writer took the number, so a reader sees one version or the other, never a mixture."""
    folder = _manifest_folder(directory, schema_name, audience)
    system, at = _folder(spark, folder)
    system.mkdirs(at)
    text = json.dumps({"format": fmt, "sections": dict(paths)})
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    draft = hadoop.Path(at, f"draft-{uuid.uuid4().hex}")
    out = system.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    number = (_manifests(spark, folder) or [0])[-1]
    while True:
        number += 1
        target = hadoop.Path(at, f"{number:012d}")
        if not system.exists(target) and system.rename(draft, target):
            return number


def current_version(spark: SparkSession, directory: str, schema_name: str, audience: str = "technical") -> dict:
    """{"format", "sections": {name: path}} of the last manifest; empty if there is none."""
    folder = _manifest_folder(directory, schema_name, audience)
    numbers = _manifests(spark, folder)
    if not numbers:
        return {}
    return json.loads(spark.read.text(f"{folder}/{numbers[-1]:012d}", wholetext=True).first()[0])


def read_sections(spark: SparkSession, directory: str, schema_name: str,
                  audience: str = "technical") -> dict[str, DataFrame]:
    """The sections of the current version."""
    version = current_version(spark, directory, schema_name, audience)
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return {name: reader.format(version["format"]).load(path) for name, path in version.get("sections", {}).items()}


def write_sections(sections: Mapping[str, DataFrame], directory: str, schema_name: str,
                   audience: str = "technical", fmt: str = "parquet") -> dict[str, str]:
    """Write all sections as a version and make it the current one; returns the path of each. A failure on the way
    leaves the version before it current."""
    paths = write_version(sections, directory, schema_name, audience, fmt)
    spark = next(iter(sections.values())).sparkSession
    commit(spark, paths, directory, schema_name, audience, fmt)
    return paths


def write_model_json(document: DataFrame, directory: str, schema_name: str,
                     audience: str = "technical") -> str | None:
    """Write the one-row JSON document of a model; None for audiences that must not have it."""
    if audience in NO_JSON_AUDIENCES:
        return None
    path = f"{directory.rstrip('/')}/{dictionary_name(schema_name, audience)}/model"
    document.select("json").write.mode("overwrite").text(path)
    return path
