"""A Spark data source that writes rows as files: ``spark.dataFrameWriter.format("page_files")``.

Tasks write below a staging folder, in a folder of their own for each attempt, and a list of what they wrote; the driver's
commit keeps the lists of the attempts that count and drops the rest.  Nothing is in its place yet: a job over the lists
moves the files there, in parallel, and a move that ran before is passed by.  So a task that is killed, or a write
that is given up, leaves no file behind.  Files go through the file system that the path names.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "page_files"
LIST = "files.txt"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it; ``file:/x`` is one too."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path[len("file:") :]
    return fs.FileSystem.from_uri(path)


def is_staging(name: str) -> bool:
    """True for the name of a folder of files that are not in their place yet."""
    return re.fullmatch(r"_staging-[0-9a-f]{32}", name) is not None


@dataclass
class Written(WriterCommitMessage):
    """Where one attempt of a task has its files; None if it had no rows."""

    folder: str | None


class PageFilesWriter(DataSourceWriter):
    """Writes (folder, name, content) rows below ``path/staging``."""

    def __init__(self, staging: str):
        self.staging = staging

    def write(self, iterator: Iterator[Row]) -> Written:
        system, base = file_system(self.staging)
        folder, names = posixpath.join(base, "attempts", uuid.uuid4().hex), []
        made = set()
        for row in iterator:
            target = posixpath.normpath(posixpath.join(row["folder"], row["name"]))
            if target.startswith(("../", "/")) or "\n" in target:
                raise ValueError(f"not below the folder: {target!r}")
            if (parent := posixpath.dirname(target)) not in made:
                system.create_dir(posixpath.join(folder, parent), recursive=True)
                made.add(parent)
            with system.open_output_stream(posixpath.join(folder, target)) as f:
                f.write(row["content"].encode())
            names.append(target)
        if not names:
            return Written(None)
        with system.open_output_stream(posixpath.join(folder, LIST)) as f:
            f.write("".join(f"{posixpath.basename(folder)}\t{n}\n" for n in names).encode())
        return Written(folder)

    def commit(self, messages: list[Written | None]) -> None:
        """Put the lists of the attempts that count together; a name per task."""
        system, base = file_system(self.staging)
        system.create_dir(posixpath.join(base, "lists"), recursive=True)
        for m in messages:
            if m is not None and m.folder is not None:
                system.move(posixpath.join(m.folder, LIST), posixpath.join(base, "lists", f"{posixpath.basename(m.folder)}.txt"))

    def abort(self, messages: list[Written | None]) -> None:
        system, base = file_system(self.staging)
        if system.get_file_info(base).type != fs.FileType.NotFound:
            system.delete_dir(base)


class PageFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "folder string, name string, content string"

    def writer(self, schema, overwrite: bool) -> PageFilesWriter:
        return PageFilesWriter(self.options["path"])


def _move(batches: Iterator[pd.DataFrame], staging: str, folder: str) -> Iterator[pd.DataFrame]:
    system, base = file_system(staging)
    _, target = file_system(folder)
    missing, made = fs.FileType.NotFound, set()
    for rows in batches:
        for line in rows["value"]:
            attempt, name = line.split("\t", 1)
            source, end = posixpath.join(base, "attempts", attempt, name), posixpath.join(target, name)
            if (parent := posixpath.dirname(end)) not in made:
                system.create_dir(parent, recursive=True)
                made.add(parent)
            if system.get_file_info(source).type != missing:
                system.move(source, end)
            elif system.get_file_info(end).type == missing:
                raise FileNotFoundError(end)
        yield pd.DataFrame({"n": [len(rows)]})


def write_files(df: DataFrame, folder: str) -> int:
    """Write rows (folder, name, content) as files below ``folder``; gives their number."""
    spark: SparkSession = df.sparkSession
    spark.dataSource.register(PageFiles)
    staging = f"{folder.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    df.select("folder", "name", "content").write.format(FORMAT).mode("append").option("path", staging).save()
    system, base = file_system(staging)
    if not system.get_file_info(fs.FileSelector(posixpath.join(base, "lists"))):
        n = 0
    else:
        moved = spark.read.text(f"{staging}/lists").mapInPandas(lambda rows: _move(rows, staging, folder), "n long")
        n = moved.groupBy().sum("n").first()[0] or 0
    system.delete_dir(base)
    return n
