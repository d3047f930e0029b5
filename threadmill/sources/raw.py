"""Raw record sources: dumps, record lines, provider pages, job lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.flatten import envelope_items


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``raw``: one JSON record per line, blank lines left out."""
    return (
        spark.read.text(path)
        .select(F.col("value").alias("raw"))
        .filter(F.rlike("raw", F.lit(r"\S")))
    )


def read_dump(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """A bulk dump: record lines as ``raw`` text, or Parquet with its own columns."""
    return spark.read.parquet(path) if kind == "parquet" else read_lines(spark, path)


def unreadable(records: DataFrame) -> DataFrame:
    """Lines of :func:`read_lines` that are no JSON object, for a quarantine table."""
    parsed = F.try_parse_json("raw")
    return records.filter(
        parsed.isNull() | ~F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT"))
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``raw``: the records of provider responses, one response per line."""
    pages = read_lines(spark, path)
    return pages.select(
        F.explode(envelope_items(F.try_parse_json("raw"))).alias("item")
    ).select(F.to_json("item").alias("raw"))


def read_job_lists(spark: SparkSession, path: str) -> DataFrame:
    """``payload``: job list documents, one file each (a job list is small by nature).

    ``list`` is the file's name; where several lists are read it makes job ids unique.
    """
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("payload"), F.col("_metadata.file_name").alias("list")
    )


def job_list(spark: SparkSession, text: str) -> DataFrame:
    """A single job list given as text, as from an environment variable."""
    return spark.createDataFrame([(text,)], "payload string")
