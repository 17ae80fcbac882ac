"""Continuous scoring (SCO2): one request file row = one request.

``readStream`` with an explicit schema → validation → the saved pipeline
model's ``transform`` → ``foreachBatch``.  The job is stateless; each
micro-batch writes its scored and rejected rows under ``batch_id=<id>`` with
overwrite, so a batch replayed after a failure replaces its own output
(idempotent sink) and the checkpoint location tracks progress.

A micro-batch takes at most ``max_files`` files, and no more after the one that reaches ``max_bytes``, so a
backlog is worked off in batches of one size.  A line that is no JSON object of the schema is kept and
written as rejected, with what it holds.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.functions.scalars import risk_level
from churnlens.operators.scoring import validate_score_requests
from churnlens.schemas import FINAL_FEATURES, SCORE_REQUEST


def score_batch(model: PipelineModel, valid: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    out = model.transform(valid)
    p = vector_to_array("probability")[1]
    return out.select("request_id", (F.col("prediction") == 1).alias("churned"),
                      F.bround(p, 3).alias("churn_probability"), risk_level(p).alias("risk_level"))


MAX_FILES = 1000
CORRUPT = "_corrupt_record"


def start_scoring_stream(spark: SparkSession, model: PipelineModel, source: str, sink: str, checkpoint: str,
                         fmt: str = "json", available_now: bool = True, fields=FINAL_FEATURES,
                         max_files: int | None = MAX_FILES, max_bytes: str | None = None):
    """Start the stream; returns the StreamingQuery (already finished when ``available_now``).

    A batch is bounded by files or by bytes (``max_bytes``, such as "8g"), whichever is given."""
    from pyspark.sql import types as T
    schema = SCORE_REQUEST if list(fields) == list(FINAL_FEATURES) else T.StructType(
        [T.StructField("request_id", T.StringType())] + [T.StructField(c, T.DoubleType()) for c in fields])
    text = fmt in ("json", "csv")
    if text:  # what cannot be parsed is kept beside the fields
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    limit = ("maxBytesPerTrigger", max_bytes) if max_bytes else ("maxFilesPerTrigger", max_files)
    reader = spark.readStream.schema(schema).format(fmt).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    req = (reader.option(*limit) if limit[1] else reader).load(source)
    checked = validate_score_requests(req, fields)
    if text:
        broken = F.col(CORRUPT).isNotNull()
        told = F.concat(F.lit(f"not a {fmt.upper()} request: "), F.substring(CORRUPT, 1, 200))
        checked = checked.withColumn("error", F.when(broken, told).otherwise(F.col("error"))) \
            .withColumn("valid", F.col("valid") & ~broken)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read and validated once for both outputs
        try:
            scored = score_batch(model, batch.where("valid"))
            scored.write.mode("overwrite").parquet(f"{sink}/scored/batch_id={batch_id}")
            (batch.where(~F.col("valid")).select("request_id", "error")
             .write.mode("overwrite").parquet(f"{sink}/rejected/batch_id={batch_id}"))
        finally:
            batch.unpersist()

    w = checked.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
