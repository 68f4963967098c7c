"""Resumable translation as a stream: new files in, each micro-batch translated once and appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corpusloom.config import TranslateConfig
from corpusloom.operators.translate import Backend, translated
from corpusloom.sources.tables import exists


def translate_available(spark: SparkSession, source: str, schema: str, results: str, checkpoint: str, backend: Backend, config: TranslateConfig = TranslateConfig()) -> StreamingQuery:
    """Translates what is in the source folder and not in results yet, then stops. The checkpoint keeps what was read; an
    anti join keeps rows of a batch that is run again from being appended twice."""

    def step(batch: DataFrame, _: int) -> None:
        todo = batch.dropDuplicates(["row_id"])
        if exists(spark, results):
            todo = todo.join(spark.read.parquet(results).where("state = 'success'").select("row_id"), "row_id", "left_anti")
        translated(todo, backend, config).write.mode("append").parquet(results)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
