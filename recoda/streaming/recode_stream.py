"""The unambiguous recode (J1) applied to a stream of incoming declaration files.

Declarations arriving as Parquet files in a landing folder are recoded with a
stream-static broadcast join against the mapping; the output sink is
append-only Parquet with a checkpoint in the shared checkpoint folder, so a
restarted query resumes exactly where it stopped.  No state is kept between
micro-batches (J1 is stateless), so no watermark is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from recoda.operators.recode import recode_unambiguous
from recoda.session import scratch_path


def recode_stream(landing: str, spark: SparkSession, schema, mapping: DataFrame, output: str,
                  checkpoint: str, available_now: bool = False, max_files_per_trigger: int = 100) -> StreamingQuery:
    """Start the streaming recode from ``landing`` into ``output``."""
    incoming = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing)
    recoded = recode_unambiguous(incoming, mapping)
    writer = recoded.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(output)


def recode_files_once(spark: SparkSession, declarations: DataFrame, mapping: DataFrame) -> DataFrame:
    """Land ``declarations`` as files, drain them through the stream once, read the output."""
    landing = scratch_path(spark, "landing")
    output = scratch_path(spark, "recoded")
    checkpoint = scratch_path(spark, "stream-ckpt")
    declarations.write.parquet(landing)
    q = recode_stream(landing, spark, declarations.schema, mapping, output, checkpoint, available_now=True)
    q.awaitTermination()
    return spark.read.parquet(output)
