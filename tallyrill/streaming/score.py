"""Scoring of texts as they arrive."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def arriving_texts(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 64) -> DataFrame:
    """JSON files that appear in a folder, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def scored(texts: DataFrame, model: PipelineModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Label per text. Stateless, and the same plan for a stream and for a table."""
    ready = texts.withColumn("length", F.length(text).cast("double"))
    out = model.transform(ready)
    said = F.when(F.col("prediction") == 1.0, "positive").otherwise("negative")
    return out.select(key, "prediction", said.alias("sentiment"))


def score_stream(
    texts: DataFrame, model: PipelineModel, out: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Write scored texts as Parquet; a restart goes on from the checkpoint folder."""
    writer = scored(texts, model).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer
    return writer.outputMode("append").start(out)
