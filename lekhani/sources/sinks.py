"""Writing stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Overwrites ``path``."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_by_language(df: DataFrame, path: str, column: str = "doc_lang", compression: str = "gzip") -> None:
    """Overwrites ``path`` with a folder per language; the column stays in the files."""
    part = f"{column}_partition"
    df.drop(part).withColumn(part, F.col(column)).write.mode("overwrite").option("compression", compression).partitionBy(part).parquet(path)


def plain_partition_names(df_path: str, spark, column: str) -> list[str]:
    """Renames ``column=value`` folders to ``value``; the new paths."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(df_path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{column}="):
            target = jvm.org.apache.hadoop.fs.Path(root, name.split("=", 1)[1])
            fs.rename(status.getPath(), target)
            out.append(target.toString())
    return sorted(out)


def partition_histogram(df: DataFrame) -> DataFrame:
    """Rows per partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows")).sort("partition")
