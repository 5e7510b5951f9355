"""Segments that arrive as files: the stateless part of the segment operators as a stream.

Island numbers need the whole order and stay a batch operator; what streams is reading, bounds and appending, so that a
batch run finds new segments already typed and bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strandline.operators.segments import segment_bounds


def incoming(spark: SparkSession, folder: str, schema: T.StructType | str, files_per_trigger: int = 100) -> DataFrame:
    """Delimited segment files of a folder as a stream; each file is taken once."""
    return spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", files_per_trigger).csv(folder)


def append_bounded(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends the stream with true bounds to a Parquet table and ends once everything that is there has been taken."""
    return segment_bounds(stream).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
