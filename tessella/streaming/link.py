"""Linking records that arrive as files against an index that stays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..config import Config
from ..operators import blocking, retrieve
from ..sources.tables import RECORD


def arriving(spark: SparkSession, path: str, files_per_batch: int = 16) -> DataFrame:
    """Stream of records from Parquet files that appear in a folder."""
    schema = StructType([StructField(c, StringType()) for c in RECORD])
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def retrieve_stream(stream: DataFrame, weights: DataFrame, idf: DataFrame, cfg: Config, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Each micro-batch's pruned candidates go to ``sink(candidates, batch_id)``; stops when all files are read.

    The index is not changed, so no state is held and nothing can come late.  A batch that is run again
    has the same id, so a sink that writes by batch id writes once.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        sink(retrieve.prune(retrieve.top_k(blocking.views(df), weights, idf, cfg), cfg.prune), batch_id)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
