"""Whole files of a folder tree as rows, however many there are.

Tasks list the folders, level by level, into narrow tables of the work folder, and tasks read the files that are dealt out from
there.  The driver holds the number of files and of their bytes, not their names.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Callable, Iterator
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.session import settle
from leafwright.sources.page_files import file_system, is_staging

# What a task reads at most, single large files aside.
FILES_PER_TASK = 2000
BYTES_PER_TASK = 64 << 20
# Rows of a listing and bytes of contents that go to Spark at once.
LISTED = 10_000
READ = 16 << 20

ENTRY = "root string, below string, folder boolean, length long"
FILE = "value binary, file_path string, name string"
ENTRY_ROWS = pa.schema([("root", pa.string()), ("below", pa.string()), ("folder", pa.bool_()), ("length", pa.int64())])
FILE_ROWS = pa.schema([("value", pa.binary()), ("file_path", pa.string()), ("name", pa.string())])

# True for the name of a file or, with True, of a folder that is passed by.
Hidden = Callable[[str, bool], bool]

# Signs that Spark writes percent-encoded in the paths of files.
_ENCODED = re.compile(r"""[\x00-\x20"#%<>?\[\\\]^`{|}\x7f-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]""")


def _encoded(path: str) -> str:
    return _ENCODED.sub(lambda m: quote(m[0]), path)


def _opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Hadoop writes it, and the path in it."""
    return file_system(root if root.startswith("file:") else _encoded(root))


def hidden(name: str, folder: bool) -> bool:
    """Names that Spark's readers pass by."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def hidden_from_pages(name: str, folder: bool) -> bool:
    """The same but for files whose names begin with ``_``, as home pages do."""
    return hidden(name, folder) and (folder or not name.startswith("_"))


def hidden_from_exports(name: str, folder: bool) -> bool:
    """Folders of files that are not in their place yet."""
    return folder and is_staging(name)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, fs.FileSystem, str]]:
    """``root, below`` of each row, with the file system and the path in it."""
    systems: dict[str, tuple[fs.FileSystem, str]] = {}
    for batch in batches:
        for root, below in zip(batch.column("root").to_pylist(), batch.column("below").to_pylist(), strict=True):
            if root not in systems:
                systems[root] = _opened(root)
            system, base = systems[root]
            yield root, below, system, posixpath.join(base, below) if below else base


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _list(batches: Iterator[pa.RecordBatch], kept: Callable[[str, bool, int], bool]) -> Iterator[pa.RecordBatch]:
    """What is right below the folders of the rows."""
    for root, below, system, path in _places(batches):
        found = [f for f in system.get_file_info(fs.FileSelector(path)) if f.type in (fs.FileType.Directory, fs.FileType.File)]
        for i in range(0, len(found), LISTED):
            rows = [
                (root, posixpath.join(below, f.base_name), f.type == fs.FileType.Directory, f.size or 0)
                for f in found[i : i + LISTED]
                if kept(f.base_name, f.type == fs.FileType.Directory, f.size or 0)
            ]
            if rows:
                yield _batch(rows, ENTRY_ROWS)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple[bytes, str, str]] = []
    size = 0
    for root, below, system, path in _places(batches):
        with system.open_input_stream(path, compression=None) as f:
            value = f.read()
        rows.append((value, _encoded(f"{root.rstrip('/')}/{below}"), _encoded(posixpath.basename(below))))
        size += len(value)
        if size >= READ or len(rows) >= LISTED:
            yield _batch(rows, FILE_ROWS)
            rows, size = [], 0
    if rows:
        yield _batch(rows, FILE_ROWS)


def _roots(spark: SparkSession, path: str) -> list[tuple[str, str, bool, int]] | None:
    """The folders and files that a path or its pattern names, as entries; None where only Spark can tell."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    roots = []
    for f in found or []:
        root, folder = f.getPath().toString(), f.isDirectory()
        try:
            _opened(root)
        except (pa.ArrowException, OSError):
            return None
        roots.append((root, "", True, 0) if folder else (f.getPath().getParent().toString(), f.getPath().getName(), False, f.getLen()))
    return roots or None


def list_files(spark: SparkSession, roots: list[tuple[str, str, bool, int]], glob: str, passed: Hidden, empty: bool) -> DataFrame:
    """The files below the roots: ``root, below, folder, length``; ``below`` is the path from the root on."""
    names = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()

    def kept(name: str, folder: bool, size: int) -> bool:
        return not passed(name, folder) and (folder or re.fullmatch(names, name) is not None and (empty or size > 0))

    files = [r for r in roots if not r[2] and kept(r[1], False, r[3])]
    levels = [spark.createDataFrame(files, ENTRY)]
    folders = spark.createDataFrame([r for r in roots if r[2]], ENTRY)
    tasks = 4 * spark.sparkContext.defaultParallelism
    while n := folders.count():
        level = settle(folders.repartition(min(n, tasks)).mapInArrow(lambda rows: _list(rows, kept), ENTRY), "listing")
        levels.append(level.filter("NOT folder"))
        folders = level.filter("folder")
    return reduce(DataFrame.unionAll, levels)


def whole_files(spark: SparkSession, path: str, glob: str, passed: Hidden = hidden, empty: bool = False) -> DataFrame:
    """Files of a folder tree whose names fit: ``value, file_path, name``, path and name percent-encoded as Spark gives them.

    Folders and files that ``passed`` names are passed by, and empty files unless ``empty`` is set.  A path that Arrow has no
    file system for is read by Spark's own reader, which lists on the driver and passes by all hidden and all empty files.
    """
    roots = _roots(spark, path)
    if roots is None:
        read = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
        rows = read.select(F.col("content").alias("value"), "_metadata.file_path", F.col("_metadata.file_name").alias("name"))
    else:
        files = list_files(spark, roots, glob, passed, empty)
        n, size = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
        tasks = max(n // FILES_PER_TASK, size // BYTES_PER_TASK, min(n, 4 * spark.sparkContext.defaultParallelism), 1)
        rows = files.repartition(tasks).mapInArrow(_read, FILE)
    return rows.withColumn("value", F.col("value").cast("string"))
