"""Reading a cohort from a relational warehouse through Spark's JDBC source."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Connection defaults.
DEFAULT_PORT = "5432"
DEFAULT_SSLMODE = "require"


def jdbc_options(settings: Mapping[str, str | None] | None = None,
                 env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')``: explicit setting, else PG* variable, else default."""
    settings = settings or {}
    env = os.environ if env is None else env

    def pick(name: str, variable: str, default: str | None = None) -> str | None:
        return settings.get(name) or env.get(variable) or default

    found = {
        "host": pick("host", "PGHOST"),
        "port": pick("port", "PGPORT", DEFAULT_PORT),
        "database": pick("database", "PGDATABASE"),
        "user": pick("user", "PGUSER"),
        "password": pick("password", "PGPASSWORD"),
        "sslmode": pick("sslmode", "PGSSLMODE", DEFAULT_SSLMODE),
    }
    missing = [k for k, v in found.items() if not v]
    if missing:
        raise ValueError(f"missing connection settings: {', '.join(missing)}")
    return {
        "url": f"jdbc:postgresql://{found['host']}:{found['port']}/{found['database']}"
               f"?sslmode={found['sslmode']}",
        "user": found["user"],
        "password": found["password"],
        "driver": "org.postgresql.Driver",
    }


def read_table(spark: SparkSession, options: Mapping[str, str], schema: str, table: str,
               partition_column: str | None = None, bounds: tuple[int, int] | None = None,
               partitions: int = 64) -> DataFrame:
    """A warehouse table; with a numeric partition column the read is split over the executors."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", f'"{schema}"."{table}"')
    if partition_column and bounds:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(bounds[0])).option("upperBound", str(bounds[1]))
                  .option("numPartitions", str(partitions)))
    return reader.load()
