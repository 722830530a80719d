"""The resumable map as a stream: each run takes what is new, and a checkpoint remembers what is done.

Accepted rows and dead letters are one committed set of files a micro-batch; a batch that is run again replaces its own
files, so no row is written twice. Failed rows count as done, as accepted ones do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curata.operators import transform


def run_available(spark: SparkSession, source: str, schema, prepare: Callable[[DataFrame], DataFrame], output: str, checkpoint: str, translate: Callable = transform.mock, **options) -> dict[str, int]:
    """Maps what is new below `source` (parquet) into output/rows, in folders of batch and part (ok or failed); rows done by
    this run.

    prepare: source rows -> ord, source_id, text_fields.
    """
    done = {"ok": 0, "failed": 0}

    def sink(batch: DataFrame, number: int) -> None:
        # one table with the flag as its folder: both parts are committed together, and counted as they are written
        path, seen = f"{output}/rows/batch={number}", Observation()
        results = transform.map_texts(prepare(batch), translate, **options).withColumn("part", F.when(F.col("ok"), "ok").otherwise("failed")).drop("ok")
        counted = results.observe(seen, F.count_if(F.col("part") == "ok").alias("ok"), F.count_if(F.col("part") == "failed").alias("failed"))
        counted.write.mode("overwrite").partitionBy("part").parquet(path)
        for name in done:
            done[name] += seen.get[name]

    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return done
