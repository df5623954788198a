"""Progress state: a page counter and the next page of every province.

A state is one small JSON document. Saving adds a document to a folder and
reading takes the one with the highest counter, so a job that dies while saving
leaves the previous state whole. A single ``progress.json`` is read and replaced just as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import advance_pages
from ..schemas import PROGRESS, PROVINCES
from ..sources.files import file_system, fresh, move_over, remove

#: Documents that stay in a progress folder after a save.
KEPT = 3


def new_progress(spark: SparkSession, provinces=PROVINCES, page: int = 1) -> DataFrame:
    """State in which every province waits at ``page``."""
    return spark.createDataFrame([(page, dict.fromkeys(provinces, page))], PROGRESS)


def init_progress(spark: SparkSession, path: str, provinces=PROVINCES, page: int = 1) -> None:
    """Start afresh: replaces whatever state ``path`` holds."""
    new_progress(spark, provinces, page).coalesce(1).write.mode("overwrite").json(path)


def newest_state(spark: SparkSession, path: str) -> Row:
    """The newest state; raises when there is none or it is malformed. One read of a few documents."""
    states = spark.read.schema(PROGRESS).json(path, multiLine=True, mode="FAILFAST")
    newest = states.filter("current_page IS NOT NULL").orderBy(F.desc("current_page")).limit(1).collect()
    if not newest or newest[0]["provinces"] is None:
        raise ValueError(f"no progress state in {path}")
    return newest[0]


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The newest state as one row."""
    row = newest_state(spark, path)
    return spark.createDataFrame([(row["current_page"], row["provinces"])], PROGRESS)


def progress_rows(state: DataFrame) -> DataFrame:
    """One row per province: ``current_page``, ``province``, ``page``."""
    return state.select("current_page", F.explode("provinces").alias("province", "page"))


def selected(state: DataFrame) -> DataFrame:
    """Provinces that take part in this batch; one ahead waits, one behind is passed."""
    return progress_rows(state).filter(F.col("page") == F.col("current_page"))


def advance(state: DataFrame) -> DataFrame:
    """State after the batch: selected provinces and the counter move one page on."""
    # In two steps: within one select the lambda would see the new counter.
    moved = advance_pages(F.col("provinces"), F.col("current_page"))
    return state.withColumn("provinces", moved).withColumn("current_page", F.col("current_page") + 1)


def write_progress(state: DataFrame, path: str) -> None:
    """Save a state.

    In a folder it is a further document, and all but the newest ``KEPT`` are removed after. A single file is
    replaced by a rename over it, so a reader sees the old or the new one.
    """
    spark = state.sparkSession
    files, at = file_system(spark, path)
    if files.exists(at) and files.getFileStatus(at).isFile():
        _replace_file(spark, path, state.select(F.to_json(F.struct("*"))).first()[0])
        return
    state.coalesce(1).write.mode("append").json(path)
    saved = spark.read.schema(PROGRESS).json(path, multiLine=True, mode="FAILFAST").select(
        "current_page", F.col("_metadata.file_path").alias("file")).orderBy(F.desc("current_page")).collect()
    for row in saved[KEPT:]:
        remove(spark, row["file"])


def _replace_file(spark: SparkSession, path: str, document: str) -> None:
    beside = fresh(path.rpartition("/")[0], ".progress")
    files, new = file_system(spark, beside)
    out = files.create(new)
    out.write(bytearray(document.encode()))
    out.close()
    move_over(spark, beside, path)
