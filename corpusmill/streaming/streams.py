"""The stateless filters and exact de-duplication over a stream of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import quality

DOCUMENT = "doc_id long, text string, arrived timestamp"


def read_stream(spark: SparkSession, path: str, schema: str = DOCUMENT) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def cleaned_stream(docs: DataFrame, least: int = 200) -> DataFrame:
    return quality.long_enough(docs.filter(F.length("text") > 0), least)


def first_of_each_text(docs: DataFrame, late: str = "1 hour", time_col: str = "arrived") -> DataFrame:
    """Documents whose text has not come before within the watermark; the state holds hashes alone and is dropped with it."""
    hashed = docs.withColumn("text_sha", F.sha2("text", 256)).withWatermark(time_col, late)
    return hashed.dropDuplicatesWithinWatermark(["text_sha"]).drop("text_sha")
