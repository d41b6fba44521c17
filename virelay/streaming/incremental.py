"""Results that grow as files of alignments and reads arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int = 1) -> DataFrame:
    """The files of a table, one file or a folder of files, as a stream with the schema of what is there."""
    batch = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    folder, _, file = batch.inputFiles()[0].rpartition("/")
    inside = folder.endswith(f"{name}.parquet")
    r = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", files_per_trigger)
    return r.option("pathGlobFilter", "*.parquet" if inside else file).parquet(folder)


def without_redelivered(rows: DataFrame, keys: list[str], event_time: str, lateness: str) -> DataFrame:
    """Rows the keys of which haven't come within ``lateness`` before; state older than that is dropped."""
    return rows.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(keys)


def windowed_counts(rows: DataFrame, key: str, event_time: str, window: str, lateness: str) -> DataFrame:
    """(window_start, key, n_rows) of each window of event time, final once the watermark has passed it."""
    w = F.window(event_time, window)
    return rows.withWatermark(event_time, lateness).groupBy(w, key).agg(F.count(F.lit(1)).alias("n_rows")).select(F.col("window.start").alias("window_start"), key, "n_rows")


def write_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Everything available now is written to a folder of Parquet files, exactly once; the query ends by itself."""
    return df.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
