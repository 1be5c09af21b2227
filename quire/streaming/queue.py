"""The polling queue as a stream: each micro-batch claims its ready services once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.operators.service import ready

SERVICES = "id string, status string, met int, service_instance_id string"


def claims(spark: SparkSession, source: str, claimed: str, checkpoint: str, process: Callable[[DataFrame, int], None] | None = None, schema: str = SERVICES) -> StreamingQuery:
    """Reads service rows as they arrive in source and appends each ready id to the table claimed once, with its batch.

    A batch that is run again writes over its own claims, and ids that earlier batches claimed are left out, so a
    lost driver neither loses nor doubles a claim. process gets the newly claimed rows.
    """

    def batch(rows: DataFrame, number: int) -> None:
        fresh = ready(rows).dropDuplicates(["id"])
        path = spark._jvm.org.apache.hadoop.fs.Path(claimed)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            earlier = spark.read.parquet(claimed).where(F.col("batch") < number).select("id")
            fresh = fresh.join(earlier, "id", "left_anti")
        fresh = fresh.withColumn("status", F.lit("Processing"))
        fresh.write.mode("overwrite").parquet(f"{claimed}/batch={number}")
        if process:
            process(spark.read.schema(fresh.schema).parquet(f"{claimed}/batch={number}"), number)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
