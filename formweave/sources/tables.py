"""Tables in Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, spread: bool = False) -> DataFrame:
    """A Parquet table; with ``spread``, small inputs are dealt to all cores.

    A file of one row group is one task however many cores wait, which costs
    dear before heavy row-wise text work. A scan of more tasks than cores, any
    large table, is left as it is.
    """
    df = spark.read.parquet(path)
    if spread:
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores:
            return df.repartition(cores)
    return df
