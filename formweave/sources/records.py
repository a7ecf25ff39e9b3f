"""Record, template and range files in JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formweave.functions.jsontext import parse_object, parse_objects, parse_record_list
from formweave.sources.files import only_file, read_texts, scan_files, texts_of


def read_objects(spark: SparkSession, folder: str) -> DataFrame:
    """source_file, pos, record of every object in *.json; broken files give none."""
    texts = read_texts(spark, folder, (".json",))
    return texts.select(F.col("path").alias("source_file"), F.posexplode(parse_objects(F.col("text"))).alias("pos", "record"))


def read_text_objects(spark: SparkSession, folder: str) -> DataFrame:
    """source_file, pos, text of the objects that hold a text."""
    objects = read_objects(spark, folder).filter(F.map_contains_key("record", "text"))
    return objects.select("source_file", "pos", F.element_at("record", F.lit("text")).alias("text"))


def read_record_lists(spark: SparkSession, folder: str) -> DataFrame:
    """source_file, pos, record of the files that hold a list; others are skipped."""
    texts = read_texts(spark, folder, (".json",))
    return texts.select(
        F.col("path").alias("source_file"), F.posexplode(parse_record_list(F.col("text"))).alias("pos", "record")
    )


def read_record_file(spark: SparkSession, path: str) -> DataFrame:
    """One JSON list file as a table with the union of its objects' columns."""
    return spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)


def read_template(spark: SparkSession, folder: str) -> list[str]:
    """Field names of the JSON template, in order.

    The first file by path counts; no file, a non-object or an empty object is
    an error. One small row comes to the driver.
    """
    texts = read_texts(spark, folder, (".json",))
    # A map would lose nothing but is unordered by contract; keys are read as written.
    row = (
        texts.select("path", "text", parse_object(F.col("text")).alias("t"))
        .select("path", F.json_object_keys("text").alias("keys"), F.col("t").isNotNull().alias("good"))
        .orderBy("path")
        .first()
    )
    if row is None:
        raise FileNotFoundError(f"no JSON template in {folder}")
    if not row["good"]:
        raise ValueError(f"the template {row['path']} is not a JSON object")
    if not row["keys"]:
        raise ValueError(f"the template {row['path']} has no fields")
    return list(row["keys"])


def read_range(spark: SparkSession, folder: str) -> DataFrame:
    """start_date, end_date of the folder's only JSON file."""
    texts = texts_of(only_file(scan_files(spark, folder, (".json",)), "JSON file"))
    parsed = texts.select(parse_object(F.col("text")).alias("r"))

    def end(name: str):
        value = F.col("r")[name]
        missing = F.raise_error(F.lit(f"the range file must hold {name}")).cast("string")
        return F.coalesce(value, missing).cast("date").alias(name)

    return parsed.select(end("start_date"), end("end_date"))
