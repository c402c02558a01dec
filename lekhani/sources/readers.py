"""Reading crawls, scans, stage tables and lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as St

from lekhani.operators.dedup import one_per_key


def string_schema(columns: list[str]) -> St.StructType:
    """All-string nullable schema."""
    return St.StructType([St.StructField(c, St.StringType(), True) for c in columns])


def read_json(spark: SparkSession, glob: str, columns: list[str], multiline: bool = True) -> DataFrame:
    """JSON objects with a fixed all-string schema; unreadable files are skipped."""
    return spark.read.schema(string_schema(columns)).option("multiLine", multiline).option("ignoreCorruptFiles", True).json(glob)


def read_crawl_json(spark: SparkSession, glob: str, language: str, multiline: bool = True) -> DataFrame:
    """Crawled pages: html if there is any, else text."""
    raw = read_json(spark, glob, ["doc_id", "url", "source", "timestamp", "html", "text"], multiline)
    return raw.select("doc_id", "url", "source", F.lit(language).alias("language"), F.coalesce("html", "text").alias("text"), "timestamp")


def read_scan_json(spark: SparkSession, glob: str, language: str, multiline: bool = True) -> DataFrame:
    """Scanned pages; page numbers as strings."""
    raw = read_json(spark, glob, ["doc_id", "url", "source", "page_no", "identifier", "pdf_name", "text"], multiline)
    return raw.select("doc_id", "url", "source", F.lit(language).alias("language"), "page_no", "identifier", "pdf_name", "text")


def read_speech_json(*_args, **_kwargs) -> DataFrame:
    """Speech transcripts have no defined layout."""
    raise NotImplementedError("speech transcripts")


def read_stage_json(spark: SparkSession, glob: str, columns: list[str], language: str, id_col: str = "doc_id", multiline: bool = True) -> DataFrame:
    """Crawl layout from any JSON columns: ``body`` stands in for text; ids once."""
    raw = read_json(spark, glob, columns, multiline)
    if "body" in columns and "text" not in columns:
        raw = raw.withColumnRenamed("body", "text")
    return one_per_key(raw.withColumn("language", F.lit(language)), id_col)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One or several paths or globs."""
    return spark.read.parquet(*paths)


def read_manifest(spark: SparkSession, manifest: str, most: int = 100_000) -> DataFrame:
    """The parquet paths listed in a text file, a path a line."""
    paths = [r.value.strip() for r in spark.read.text(manifest).where("trim(value) != ''").limit(most + 1).collect()]
    if len(paths) > most:
        raise ValueError("manifest too long")
    return spark.read.parquet(*paths)


def language_codes(df: DataFrame, name: str = "language", code: str = "iso639_3", most: int = 10_000) -> dict[str, str | None]:
    """Language -> code of a small table."""
    rows = df.select(F.col(name).alias("k"), F.col(code).alias("v")).where("k is not null").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("too many languages")
    return {r.k: r.v for r in rows}
