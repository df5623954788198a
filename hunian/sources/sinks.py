"""Writers. Each returns the number of rows it wrote."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .files import CSV_WRITE, file_system, fresh, move_over, remove


#: Folder name that tells good rows from bad ones.
SPLIT = "split"
#: Rows of a name from which ``write_csv_files`` writes several files.
FILE_ROWS = 100_000


def page_path(root: str, page: int, fmt: str = "parquet") -> str:
    return f"{root}/page_{page}" if fmt == "csv" else f"{root}/page={page}"


def write_page(df: DataFrame, root: str, page: int, fmt: str = "parquet") -> int:
    """Replace one page, also when ``df`` is empty; other pages stay.

    No shuffle: tasks write what they hold, so a page or province with most of
    the rows is written by as many tasks as read it.
    """
    options = CSV_WRITE if fmt == "csv" else {}
    counted, rows = observed(df)
    counted.write.options(**options).mode("overwrite").format(fmt).save(page_path(root, page, fmt))
    return rows()


def overwrite_partitions(df: DataFrame, root: str, by: list[str], fmt: str = "parquet", gather: bool = True) -> int:
    """Replace just the partitions ``df`` has rows for; an empty frame touches nothing.

    Without ``gather`` tasks write what they hold, for rows that are read partition by partition. Old and new rows are both there until the commit,
    so Parquet is written with the codec of the engine's sessions in any session.
    """
    options = {**(CSV_WRITE if fmt == "csv" else {"compression": "zstd"}), "partitionOverwriteMode": "dynamic"}
    counted, rows = observed(_gathered(df, by) if gather else df)
    counted.write.options(**options).mode("overwrite").partitionBy(*by).format(fmt).save(root)
    return rows()


def append_rows(df: DataFrame, root: str, by: list[str]) -> int:
    """Add rows to their partitions; what is stored stays.

    The commit is the job's: tasks lost with their executor are run again and
    leave no rows behind.
    """
    counted, rows = observed(_gathered(df, by))
    counted.write.mode("append").partitionBy(*by).parquet(root)
    return rows()


def write_split(rows: DataFrame, root: str) -> DataFrame:
    """Good and bad rows of ``read_rows`` in two folders under ``root``, written in one pass and one commit.

    Returns ``file``, ``reason`` (null for good rows) and ``rows``; they add up to the input.
    """
    part = F.when(F.col("_reason").isNull(), "good").otherwise("bad")
    rows.withColumn(SPLIT, part).write.mode("overwrite").partitionBy(SPLIT).parquet(root)
    return rows.sparkSession.read.parquet(root).groupBy(F.col("_file").alias("file"), F.col("_reason").alias("reason")).agg(
        F.count("*").alias("rows"))


def split_path(root: str, good: bool) -> str:
    return f"{root}/{SPLIT}={'good' if good else 'bad'}"


def write_csv_files(df: DataFrame, root: str, name: Column, scratch: str, parts: bool = True, packed: str = "") -> int:
    """A CSV file with a header for each ``name`` (a path under ``root``), replacing what has that name.

    A name with more than ``FILE_ROWS`` rows that several tasks write becomes a folder of that name with several such files, which the readers take
    like the file. Rows are counted by name for it, unless ``parts`` is false as no name has many. With ``packed``, a codec such as ``gzip``, names of so many
    rows are always folders, of packed files, and written apart. The driver handles one name at a time, as many as a batch has pages or districts.
    """
    spark, folder = df.sparkSession, fresh(scratch, "files")
    inputs = [c for c in df.columns if c != "_into"]
    named, packs = df.select(*inputs, name.alias("_name")), None
    if parts:
        large = named.groupBy("_name").agg(F.ceil(F.count("*") / FILE_ROWS).alias("_parts")).filter("_parts > 1")
        if packed:
            large = spark.createDataFrame(large.collect(), large.schema)
        named = named.join(F.broadcast(large), "_name", "left")
        if packed and not large.isEmpty():
            named, packs = named.filter("_parts is null"), named.filter("_parts is not null")
        # By the row's own values, so that a task that is run again deals its rows likewise.
        part = F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(*inputs), F.col("_parts")))
        named, packs = (rows and rows.withColumn("_part", part).hint("rebalance", "_name", "_part").select(*inputs, "_name") for rows in (named, packs))
    else:
        named = named.hint("rebalance", "_name")
    written = 0
    for rows, made, codec in ((named, f"{folder}/plain", "none"), (packs, f"{folder}/packed", packed)):
        if rows is not None:
            counted, seen = observed(rows)
            counted.write.options(**CSV_WRITE, compression=codec).partitionBy("_name").csv(made)
            written += seen()
    files, _ = file_system(spark, folder)
    for made, single in ((f"{folder}/plain", True), (f"{folder}/packed", False)):
        at = file_system(spark, made)[1]
        for part in files.listStatus(at) if files.exists(at) else ():
            if part.isDirectory():
                _put(spark, part.getPath(), f"{root}/{unquote(part.getPath().getName().removeprefix('_name='))}", folder, single)
    remove(spark, folder)
    return written


def _put(spark: SparkSession, made, target: str, folder: str, single: bool) -> None:
    """Give the folder ``made`` the name ``target``, or with ``single`` its file if it is the only one; what has the name is replaced."""
    files, there = file_system(spark, target)
    files.mkdirs(there.getParent())
    parts = files.listStatus(made)
    single = single and len(parts) == 1
    if not single or files.exists(there) and files.getFileStatus(there).isDirectory():
        # A folder cannot take a name that is taken; what has it steps aside first.
        aside = file_system(spark, f"{folder}/_aside")[1]
        files.mkdirs(aside)
        if files.exists(there) and not files.rename(there, file_system(spark, fresh(f"{folder}/_aside", "old"))[1]):
            raise OSError(f"cannot replace {target}")
    if single:
        move_over(spark, parts[0].getPath().toString(), target)
    elif not files.rename(made, there):
        raise OSError(f"cannot write {target}")


def _gathered(df: DataFrame, by: list[str]) -> DataFrame:
    """Bring rows of a partition together for few files; AQE splits the large ones."""
    return df.hint("rebalance", *by) if by else df.hint("rebalance")


def observed(df: DataFrame):
    """``df`` that counts its rows while it is written, and the way to ask for it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), lambda: seen.get["rows"]
