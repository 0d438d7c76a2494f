"""The scan as a stream: arriving files in, details and a running summary out."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions import normalise as n
from riskloom.plans.scan import scan
from riskloom.schemas import ARRIVING_FILE


def arriving(spark: SparkSession, path: str, schema: T.StructType = ARRIVING_FILE, files_per_trigger: int = 1000) -> DataFrame:
    """JSON files that appear below ``path``, at most ``files_per_trigger`` per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def scan_stream(files: DataFrame, model: Transformer | None = None) -> DataFrame:
    """Rules and decision per arriving file: stateless, so it runs as the batch scan does."""
    texts = files.withColumnRenamed("code", "raw_code").filter(~n.is_blank(F.col("raw_code")))
    return scan(texts, model)


def running_summary(details: DataFrame) -> DataFrame:
    """Files per risk level so far; the state holds one row per level."""
    return details.groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("is_vulnerable")).alias("vulnerable_files")
    )


def drop_seen(
    files: DataFrame, code: str = "code", name: str = "filename", arrival: str | None = None, horizon: str = "7 days", salts: int = 8
) -> DataFrame:
    """Pass each content once.

    A first pass drops repeats per (hash, salt of the name), so copies of one hot content are
    spread over ``salts`` tasks and at most ``salts`` of them reach the second pass. Without an
    arrival time the state grows with the distinct hashes; with one, hashes older than
    ``horizon`` are forgotten.
    """
    salt = F.pmod(F.xxhash64(name), F.lit(salts))
    keyed = files.withColumns({"code_hash": n.content_key(F.col(code)), "_salt": salt})
    if arrival:
        keyed = keyed.withWatermark(arrival, horizon).dropDuplicatesWithinWatermark(["code_hash", "_salt"])
        return keyed.dropDuplicatesWithinWatermark(["code_hash"]).drop("_salt")
    return keyed.dropDuplicates(["code_hash", "_salt"]).dropDuplicates(["code_hash"]).drop("_salt")


def write_details(details: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append details as Parquet; offsets and output are committed together."""
    writer = details.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


KEPT_BATCHES = 3  # older ones are deleted; a reader has so many micro-batches' time to finish


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def write_summary(summary: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Keep the latest summary: each micro-batch writes the few rows of its own numbered folder, then a line of the manifest.

    The manifest names a batch only when its folder is complete, and a retried batch replaces its own folder alone, so ``read_summary``
    always finds a whole summary.
    """
    def replace(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        folder, manifest = f"{path}/data/{number:019d}", f"{path}/manifest"
        batch.write.mode("overwrite").parquet(folder)
        spark.createDataFrame([(number,)], "batch long").coalesce(1).write.mode("overwrite").parquet(f"{manifest}/{number:019d}")
        for kind in ("data", "manifest"):
            place, files = _file_system(spark, f"{path}/{kind}")
            for old in sorted(s.getPath().getName() for s in files.listStatus(place))[: -KEPT_BATCHES - 1]:
                files.delete(spark._jvm.org.apache.hadoop.fs.Path(place, old), True)

    writer = summary.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(replace)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_summary(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The summary of the last complete micro-batch. Raises ValueError before there is one."""
    place, files = _file_system(spark, f"{path}/manifest")
    names = [s.getPath() for s in files.listStatus(place) if files.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))] if files.exists(place) else []
    if not names:
        raise ValueError(f"no summary has been written below {path}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{path}/data/{max(p.getName() for p in names)}")
