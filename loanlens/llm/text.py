"""Shared pieces of the text operators: words, scratch tables and session settings."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import loanlens
from loanlens.session import configure, shared_dir

# The six white-space characters that separate words.
BLANKS = " \t\n\x0b\f\r"
BLANK_CLASS = "[ \\t-\\r]"
WORD_CLASS = "[^ \\t-\\r]"

# Rows per Arrow batch: texts can be long, and a batch is held in memory whole.
BATCH_ROWS = "500"

PACKAGE = "loanlens-package.zip"


def ship_package(spark: SparkSession) -> None:
    """Give the package to Python workers, which may not find it where the driver did.

    It goes through the shared folder, once for an application; a package that came as a file
    with the job is there already.
    """
    context, folder = spark.sparkContext, Path(loanlens.__file__).parent
    if PACKAGE in context._python_includes or not folder.is_dir():
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as file:
        for module in sorted(folder.rglob("*.py")):
            file.write(module, module.relative_to(folder.parent))
    path = context._jvm.org.apache.hadoop.fs.Path(shared_dir(spark, "package"), PACKAGE)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    out = files.create(path)
    out.write(packed.getvalue())
    out.close()
    context.addPyFile(files.makeQualified(path).toString())


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings that the operators rely on, and the package on its workers."""
    configure(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for a null, empty or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{BLANK_CLASS}+"))


def n_words(text: Column) -> Column:
    """Number of words, without building them: what is left of each word is one letter."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), f"{WORD_CLASS}+", "x")
    return F.length(F.regexp_replace(marks, f"{BLANK_CLASS}+", "")).cast("long")


def point(key: Column, digits: int) -> Column:
    """The first hexadecimal digits of a key's MD5 as a number (15 digits at most); null counts as empty."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, digits), 16, 10).cast("long")


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have (case apart)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
