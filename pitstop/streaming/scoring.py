"""Streaming scoring: request files -> validate -> defaults -> score ->
append-only prediction log, with rejected requests in a quarantine sink.

One query reads the source once; each micro-batch is kept until both sinks are
written, in the folder of its batch id.  A batch that runs again after a
failure, also one between its two writes, overwrites its own folders, so no
request is lost or repeated in either sink.  Scoring is stateless: a fitted
``PipelineModel``, or a column over the filled fields."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pitstop.operators.score import log_rows, score, score_by, split_requests
from pitstop.sources.schemas import SCORING_REQUEST

REQUEST_WITH_ID = T.StructType([T.StructField("request_id", T.LongType())] + SCORING_REQUEST.fields)
BATCH = "batch_id"

#: Accepted requests -> rows as :func:`pitstop.operators.score.finished` makes them.
Scorer = Callable[[DataFrame], DataFrame]


def model_scorer(model: PipelineModel, model_source: str, cap_recency: int | None = None) -> Scorer:
    return lambda accepted: score(accepted, model, model_source, cap_recency)


def column_scorer(column: Column, model_source: str, cap_recency: int | None = None) -> Scorer:
    return lambda accepted: score_by(accepted, column, model_source, cap_recency)


def request_stream(spark: SparkSession, source_dir: str, schema: T.StructType = REQUEST_WITH_ID,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(source_dir)


def write_sink(rows: DataFrame, path: str, batch_id: int) -> None:
    """The rows as what the batch has in this sink, whatever it had before."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}")


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BATCH)


def start_scoring_stream(requests: DataFrame, scorer: Scorer, log_path: str, rejects_path: str, checkpoint_dir: str,
                         available_now: bool = True, keep: tuple[str, ...] = ("request_id",)) -> StreamingQuery:
    """Start the stream; both sinks are Parquet folders with a partition a batch."""
    keep = tuple(c for c in keep if c in requests.columns)

    def both(batch: DataFrame, batch_id: int) -> None:
        read_once = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            accepted, rejected = split_requests(read_once)
            write_sink(log_rows(scorer(accepted), keep), log_path, batch_id)
            write_sink(rejected, rejects_path, batch_id)
        finally:
            read_once.unpersist()

    w = requests.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
