"""Headers of many CSV files in one job.

A CSV scan matches columns by position, so files may share a scan only if they share a
header.  The files are listed by Spark, and tasks read the first block of each, however
long it is; a longer first line takes as many blocks as it needs.  Stores that Arrow cannot
open take a text scan instead, of which the first lines are kept.  The driver gets the
distinct headers of each group of files (an export, a table folder), and single file names
only for a group whose files differ.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.session import materialised

# Bytes of a file that are read at a time until its first line ends.
BLOCK = 1 << 16
# Files that a task opens; each costs a request or two.
FILES_PER_TASK = 64
# Stores that Arrow opens with nothing but the path.
RANGED = ("file",)


@dataclass(frozen=True)
class Part:
    """A file, or a folder of files, with one header."""

    group: str
    path: str
    header: tuple[str, ...]


def parse_header(line: str) -> tuple[str, ...]:
    """Names in a header line; an empty one gets the name that CSV readers make up."""
    names = next(csv.reader([line.removeprefix("﻿")]), [])
    return tuple(name if name.strip() else f"_c{i}" for i, name in enumerate(names))


def _head_reader(block: int = BLOCK) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reads first lines in tasks.  It is shipped whole, so tasks need no package but Arrow."""

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import urlsplit

        import pyarrow as pa
        from pyarrow import fs

        def head(path: str) -> str | None:
            # The path is percent-coded; Arrow unpacks by the file's ending, as Spark does.
            store, place = fs.FileSystem.from_uri(urlsplit(path)._replace(netloc="").geturl())
            read = b""
            with store.open_input_stream(place, buffer_size=None) as file:
                while b"\n" not in read and (more := file.read(block)):
                    read += more
            return read.split(b"\n")[0].rstrip(b"\r").decode("utf-8", "replace") if read else None

        for batch in batches:
            paths = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([head(p) for p in paths], pa.string())], ["path", "line"])

    return heads


def listed(spark: SparkSession, *patterns: str) -> DataFrame:
    """(path, length) of the files behind globs or folders; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(patterns))
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"))


def first_lines(spark: SparkSession, *patterns: str) -> DataFrame:
    """(path, line) of every file that is not empty."""
    files = listed(spark, *patterns).filter("length > 0")
    scheme = F.regexp_extract("path", "^([a-zA-Z0-9+.-]+):", 1)
    n, elsewhere = files.agg(F.count(F.lit(1)), F.count_if(~scheme.isin(*RANGED, ""))).first()
    if RANGED and not elsewhere:
        return files.select("path").repartition(-(-n // FILES_PER_TASK) or 1).mapInArrow(_head_reader(), "path string, line string").filter("line IS NOT NULL")
    lines = spark.read.option("recursiveFileLookup", True).text(list(patterns))
    first = lines.filter("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"), "value"
    )
    return first.groupBy("path").agg(F.min_by("value", "at").alias("line"))


def parts(spark: SparkSession, *patterns: str, group: Callable[[Column], Column]) -> list[Part]:
    """The groups of files behind globs or folders, by header; every file is opened once."""
    heads = materialised(first_lines(spark, *patterns), "headers").withColumn("group", group(F.col("path")))
    found = heads.groupBy("group").agg(F.collect_set("line").alias("lines")).orderBy("group").collect()
    same = [Part(unquote(r.group), unquote(r.group), parse_header(r.lines[0])) for r in found if len(r.lines) == 1]
    mixed = [r.group for r in found if len(r.lines) > 1]
    if mixed:
        rows = heads.filter(F.col("group").isin(mixed)).orderBy("path").collect()
        same += [Part(unquote(r.group), unquote(r.path), parse_header(r.line)) for r in rows]
    return same


def scan(spark: SparkSession, header: tuple[str, ...], paths: list[str]) -> DataFrame:
    """Text columns of files that are known to have this header."""
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in header)
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    return reader.schema(schema).option("recursiveFileLookup", True).csv(paths)
