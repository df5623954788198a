"""File access shared by the readers: exact paths, headers by name, folders of a job."""

from __future__ import annotations

import csv
import re
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Doubled quotes and quoted newlines, as spreadsheet tools and pandas write them.
CSV_READ = {"header": True, "multiLine": True, "escape": '"'}
CSV_WRITE = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
#: Files of one tree may come with so many different headers.
HEADERS = 100


def fresh(root: str, name: str) -> str:
    """A path under ``root`` that nothing else uses."""
    return f"{root}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object of ``path``."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(context._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file that may not be there."""
    files, at = file_system(spark, path)
    files.delete(at, True)


def move_over(spark: SparkSession, source: str, target: str) -> None:
    """Give a file the name of another, which it replaces; readers see the one or the other."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    option = context._gateway.new_array(hadoop.Options.Rename, 1)
    option[0] = hadoop.Options.Rename.OVERWRITE
    files, at = file_system(spark, source)
    hadoop.FileContext.getFileContext(files.getUri(), context._jsc.hadoopConfiguration()).rename(
        at, hadoop.Path(target), option)


def read_existing(read: Callable[[str], DataFrame], root: str, names: list[str]) -> DataFrame | None:
    """``read`` the given paths under ``root`` that exist; None when none does.

    All names go into one brace pattern. Hadoop expands it to exact paths when
    names hold a slash, so folders with a long history are not listed.
    """
    if not names:
        return None
    try:
        return read(f"{root}/{{{','.join(names)}}}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def escape_glob(name: str) -> str:
    return re.sub(r"([\\*?\[\]{},])", r"\\\1", name)


# The characters that partition folders hold as a percent sign and two hexadecimal digits.
_ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")
# Fixed value: the folder name of a partition without a value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partition_value(value: str | None) -> str:
    """How a partition folder spells ``value``."""
    return _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value) if value else _NO_VALUE


def file_name(value: Column) -> Column:
    """A name that one file can have for each text, different ones for different texts: ``%`` and two hexadecimal digits
    stand for what a path cannot hold, and for a first character that would hide the file. The empty text is a lone ``%``.
    """
    for character in "%/\\:":
        value = F.replace(value, F.lit(character), F.lit(f"%{ord(character):02X}"))
    first = F.substring(value, 1, 1)
    shown = F.when(first.isin(".", "_"), F.concat(F.lit("%"), F.hex(F.ascii(first)))).otherwise(first)
    return F.when(value == "", F.lit("%")).otherwise(F.concat(shown, F.substring(value, 2, 1 << 30)))


def read_csv_by_name(
    spark: SparkSession,
    path: str,
    required: list[str],
    skip_bad: bool = False,
) -> DataFrame | None:
    """All-string frame over CSV files whose headers may differ in order and width.

    Spark binds a schema to CSV columns by position. So the distinct headers are read first and each gets
    a scan with a schema of its own names; the usual case is one header and
    one scan. A header lacking a required column raises, or with ``skip_bad`` its files are left out, as are
    unreadable ones. More than ``HEADERS`` different headers raise.
    """
    bad = {"ignoreCorruptFiles": True, "ignoreMissingFiles": True} if skip_bad else {}
    headers = _headers(spark, path, bad)
    lines = [r["line"] for r in headers.select("line").distinct().orderBy("line").limit(HEADERS + 1).collect()]
    if len(lines) > HEADERS:
        raise ValueError(f"more than {HEADERS} different headers under {path}")
    frames = []
    for line in lines:
        names = next(csv.reader([line]))
        missing = [c for c in required if c not in names]
        if missing and skip_bad:
            continue
        if missing:
            raise ValueError(f"no column {missing[0]!r} in a file under {path}; its header is {line}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        rows = spark.read.options(**CSV_READ, **bad, enforceSchema=len(lines) > 1).schema(schema).csv(path).select(
            "*", F.col("_metadata.file_path").alias("_file"))
        if len(lines) > 1:
            # Which files have this header is broadcast, a row for each file, so rows stay where they are read.
            rows = rows.join(F.broadcast(headers.filter(F.col("line") == line).select("_file")), "_file", "left_semi")
        frames.append(rows.select(*names, "_file"))
    if not frames:
        return None
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def read_rows(spark: SparkSession, path: str, required: list[str]) -> DataFrame | None:
    """Every row under ``path``, good or bad: the columns by name, ``_file``, ``_reason`` (null for a good row) and ``_line``, a bad row as it is.

    A row is bad if it has not as many fields as its header, or nothing in a required column. In a file whose header lacks a required column
    every line after the header is a bad row. Files that cannot be read at all raise. Files with different headers are one scan each.
    Take all columns before anything else: Spark parses only what is asked for, and notices bad rows only then.
    """
    headers = _headers(spark, path, {})
    lines = [r["line"] for r in headers.select("line").distinct().orderBy("line").limit(HEADERS + 1).collect()]
    if len(lines) > HEADERS:
        raise ValueError(f"more than {HEADERS} different headers under {path}")
    frames = []
    for line in lines:
        names = next(csv.reader([line]))
        missing = [c for c in required if c not in names]
        own = F.broadcast(headers.filter(F.col("line") == line).select("_file"))
        if missing:
            first = headers.select(F.col("_file"), F.col("n").alias("_n"))
            rows = spark.read.text(path).select(
                F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_n"), F.col("value").alias("_line"))
            rows = rows.join(own, "_file", "left_semi").join(first, ["_file", "_n"], "left_anti").filter("_line <> ''").select(
                "_file", F.lit(f"no column {missing[0]}").alias("_reason"), "_line")
        else:
            schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_line"]])
            rows = spark.read.options(**CSV_READ, mode="PERMISSIVE", columnNameOfCorruptRecord="_line").schema(schema).csv(path).select(
                "*", F.col("_metadata.file_path").alias("_file"))
            if len(lines) > 1:
                rows = rows.join(own, "_file", "left_semi")
            reason = F.when(F.col("_line").isNotNull(), "fields")
            for name in required:
                reason = reason.when(F.col(name).isNull(), f"no value of {name}")
            # What is kept of a row without a value is its fields, quoted.
            whole = F.coalesce("_line", F.to_csv(F.struct(*names)))
            rows = rows.withColumn("_reason", reason).withColumn("_line", F.when(F.col("_reason").isNotNull(), whole))
            rows = rows.select(*[F.when(F.col("_reason").isNull(), F.col(n)).alias(n) for n in names], "_file", "_reason", "_line")
        frames.append(rows)
    if not frames:
        return None
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def _headers(spark: SparkSession, path: str, options: dict) -> DataFrame:
    """``_file``, ``line`` and ``n``, the first line of each file and its number.

    Lines get numbers that grow along a file; the smallest one of a file's first block is folded without its
    text and joined back, so no text is sorted to find it. It is broadcast, a row for each file, so no text is shuffled either.
    """
    lines = spark.read.options(**options).text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"), F.monotonically_increasing_id().alias("n")).filter("start = 0")
    first = lines.groupBy("_file").agg(F.min("n").alias("n"))
    return lines.join(F.broadcast(first), ["_file", "n"]).select("_file", "line", "n")
