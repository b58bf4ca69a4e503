"""Result logs of streams: one folder per micro-batch, so that a retried batch replaces its own rows.

A log that keeps the newest row of each key can be compacted.  A base is a folder with the newest rows of all batches up
to its number; it counts from the moment Spark has marked it as whole.  A reader takes the newest base and the
batches after it, so what a batch reads does not grow with the number of batches.  Batches that the last base but one
holds are removed, and bases before it: the batch that runs again after a failure finds all that it read before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafwright.operators.groups import last_by

BATCH = "batch"
BASE = "base"


def write_batch(df: DataFrame, log_path: str, batch_id: int) -> None:
    """Write the rows of one micro-batch."""
    df.write.mode("overwrite").parquet(f"{log_path}/{BATCH}={batch_id}")


def read_log(spark: SparkSession, log_path: str, schema: str, before: int | None = None) -> DataFrame:
    """Rows of a log that is not compacted, with their ``batch``; with ``before``, those of earlier batches only."""
    log = spark.read.schema(f"{schema}, {BATCH} bigint").parquet(log_path)
    return log if before is None else log.filter(F.col(BATCH) < before)


def latest(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key, the batch dropped."""
    return last_by(log, list(keys), [BATCH]).drop(BATCH)


def _files(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, log_path: str, kind: str) -> list[int]:
    """Numbers of the whole bases or batches of a log, in order."""
    path, fs = _files(spark, log_path)
    if not fs.exists(path):
        return []
    found = []
    for entry in fs.listStatus(path):
        name = entry.getPath().getName()
        if name.startswith(f"{kind}=") and fs.exists(_files(spark, f"{log_path}/{name}/_SUCCESS")[0]):
            found.append(int(name.partition("=")[2]))
    return sorted(found)


def read_state(spark: SparkSession, log_path: str, schema: str, keys: Sequence[str], before: int | None = None) -> DataFrame:
    """The newest row of each key; with ``before``, of the batches before that one."""
    ended = lambda n: before is None or n < before
    base = max((n for n in folders(spark, log_path, BASE) if ended(n)), default=None)
    newer = [n for n in folders(spark, log_path, BATCH) if ended(n) and (base is None or n > base)]
    rows = spark.createDataFrame([], f"{schema}, {BATCH} bigint")
    parts = [f"{BATCH}={n}" for n in newer]
    if base is not None:
        parts.insert(0, f"{BASE}={base}")
    read = [
        spark.read.schema(schema).parquet(f"{log_path}/{p}").withColumn(BATCH, F.lit(int(p.partition("=")[2])).cast("bigint"))
        for p in parts
    ]
    return latest(reduce(DataFrame.unionByName, read, rows), keys)


def compact(spark: SparkSession, log_path: str, schema: str, keys: Sequence[str], every: int = 10) -> bool:
    """Make a new base once ``every`` batches are newer than the last one; tells if it did."""
    bases, batches = folders(spark, log_path, BASE), folders(spark, log_path, BATCH)
    newer = [n for n in batches if not bases or n > bases[-1]]
    if len(newer) < every:
        return False
    state = read_state(spark, log_path, schema, keys)
    state.write.mode("overwrite").parquet(f"{log_path}/{BASE}={newer[-1]}")
    # The base before this one stays, with all after it.
    for kind, numbers in ((BASE, [n for n in bases if n < bases[-1]]), (BATCH, [n for n in batches if bases and n <= bases[-1]])):
        for n in numbers:
            path, fs = _files(spark, f"{log_path}/{kind}={n}")
            fs.delete(path, True)
    return True


def run_to_log(
    stream: DataFrame,
    log_path: str,
    checkpoint: str,
    mode: str = "update",
    each: Callable[[DataFrame, int], DataFrame] | None = None,
    trigger: dict | None = None,
    after: Callable[[int], object] | None = None,
) -> StreamingQuery:
    """Start a stream that writes each micro-batch to a log.

    By default it takes what is there and ends.  ``each`` may turn a batch to
    the rows to be written, ``after`` is called when they are.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch if each is None else each(batch, batch_id), log_path, batch_id)
        if after is not None:
            after(batch_id)

    writer = stream.writeStream.outputMode(mode).foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
