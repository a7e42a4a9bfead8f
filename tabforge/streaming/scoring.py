"""Incremental batch scoring with Structured Streaming.

New input files are picked up by a file-source stream; every micro-batch is
scored with the same lazy ``batch_score`` plan as a batch job and written to
a parquet sink partitioned by batch id. A replayed batch (after a failure)
overwrites only its own partition, so the sink stays exactly-once. Stream
progress lives in the checkpoint folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabforge.functions.numeric import round_cents
from tabforge.operators.clean import preprocess
from tabforge.operators.model import batch_score
from tabforge.spec import FeatureSpec


def score_stream(
    spark: SparkSession,
    model: PipelineModel,
    spec: FeatureSpec,
    source_dir: str,
    schema: T.StructType,
    sink_dir: str,
    checkpoint_dir: str,
    adjust_cents: bool = False,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    clean_spec: FeatureSpec | None = None,
    clean_stats: dict[str, float | None] | None = None,
) -> StreamingQuery:
    """Start a stream that scores every new parquet file under ``source_dir``.

    ``available_now`` processes what is there and stops (scheduled jobs);
    otherwise the query keeps running on a processing-time trigger. With
    ``clean_spec`` raw records are cleaned first, using fixed statistics
    ``clean_stats`` fitted once on batch data (``fit_preprocess``): the
    stream stays a stateless per-record transformation. ``checkpoint_dir``
    must be the same at every start: it is what makes a restart go on where
    the last run ended.
    """
    if clean_spec is not None and clean_stats is None:
        raise ValueError("clean_spec needs clean_stats fitted on batch data")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.parquet(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if clean_spec is not None:
            batch = preprocess(batch, clean_spec, stats=clean_stats)
        scored = batch_score(model, batch, spec)
        if adjust_cents:
            scored = scored.withColumn("prediction", round_cents("prediction"))
        (scored.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(sink_dir))

    writer = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_dir)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
