"""State tables laid out in buckets of their keys, so that joining and upserting moves the new rows only.

A table is a folder of Parquet files; keys and number of buckets belong to it as its schema does, and whoever
reads it names them.  Nothing is kept in a catalog beyond the session.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from leafwright.operators.state import upsert

BUCKETS = 64


def _name() -> str:
    return f"state_{uuid.uuid4().hex}"


def write_state(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """Write a state table in buckets to a new path; an existing one is an error."""
    name, spark = _name(), df.sparkSession
    rows = df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    rows.option("path", path).mode("errorifexists").saveAsTable(name)
    # The files stay where they are.
    spark.sql(f"DROP TABLE {name}")


def read_state(spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """A state table that :func:`write_state` left, its buckets known to the planner."""
    name = _name()
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def upsert_state(state: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The rows of a bucketed state with ``new`` put in: only new rows are shuffled, to the buckets of the state.

    Keys are never null here; a new row without one is left out.
    """
    return upsert(state, new.dropna(subset=list(keys)), keys, order, null_safe=False)
