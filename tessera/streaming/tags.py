"""Tag frequencies per country, maintained incrementally over arriving photo files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.tags import country_tag_freq, pictures
from tessera.session import shared_path
from tessera.sources.schemas import PHOTO_SCHEMA


def tag_freq_stream(spark: SparkSession, source_dir: str, boxes: DataFrame, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``country, tag, n`` over tab-separated photo files landing in ``source_dir``.

    The box table is static; each micro-batch is located through the same broadcast cell
    lookup as the batch operator, and counts are kept in the aggregation state keyed by
    (country, tag).
    """
    reader = spark.readStream.schema(PHOTO_SCHEMA).option("sep", "\t").option("header", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    photos = reader.csv(source_dir)
    return country_tag_freq(pictures(photos, boxes))


def start_tag_freq(
    spark: SparkSession,
    source_dir: str,
    boxes: DataFrame,
    query_name: str = "tag_freq",
    sink: str = "console",
    output_mode: str = "update",
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Start the stream. State and progress go to the shared checkpoint folder, so a restarted
    driver resumes where it stopped."""
    location = checkpoint or shared_path(spark, "streams", query_name)
    return (
        tag_freq_stream(spark, source_dir, boxes)
        .writeStream.format(sink)
        .queryName(query_name)
        .outputMode(output_mode)
        .option("checkpointLocation", location)
        .start()
    )
