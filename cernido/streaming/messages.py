"""Streams of messages: contracts, dead letters, idempotent drain, completion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

#: payload of a routed message
CONTRACT = "event_type string, file_id string, attempt int"
KNOWN_EVENTS = ["file.routed", "file.chunks_ready"]


def judged(messages: DataFrame) -> DataFrame:
    """Messages with their parsed payload and ``problem``: null where the contract
    holds, else the first reason why not. Works on batches and streams."""
    p = F.from_json("payload", CONTRACT)
    problem = (
        F.when(F.coalesce(p["event_type"], p["file_id"], p["attempt"].cast("string")).isNull(), "malformed_payload")
        .when(p["event_type"].isNull() | ~p["event_type"].isin(KNOWN_EVENTS), "unknown_event")
        .when(F.coalesce(p["file_id"], F.lit("")) == "", "missing_file_id")
        .when(p["file_id"] != F.col("file_id"), "file_mismatch")
        .when(F.coalesce(p["attempt"], F.lit(0)) < 1, "bad_attempt")
    )
    return messages.withColumn("parsed", p).withColumn("problem", problem)


def dead_letter_key(*parts: str) -> Column:
    return F.concat_ws(":", F.lit("poison"), *[F.coalesce(F.col(c), F.lit("")) for c in parts], F.col("problem"))


def dead_letters(messages: DataFrame) -> DataFrame:
    """One dead letter per run, file and reason, however often it was delivered."""
    bad = judged(messages).filter("problem is not null").withColumn("dead_letter_key", dead_letter_key("run_id", "file_id"))
    return bad.groupBy("dead_letter_key").agg(F.first("problem").alias("problem"), F.count("*").alias("deliveries"))


def drain(stream: DataFrame, target: str, checkpoint: str, key: str) -> StreamingQuery:
    """Takes all that is there, once: each micro-batch replaces the folder of its
    number, so a batch that is repeated after a failure is written once. Of the
    copies of a message one is kept, whatever batches they come in: a batch is
    anti-joined against the keys stored by the others. Messages without a key
    can't be told apart and are all kept.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        keyed = batch.filter(F.col(key).isNotNull()).dropDuplicates([key])
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            stored = spark.read.schema(T.StructType([batch.schema[key], T.StructField("batch", T.LongType())])).parquet(target)
            keyed = keyed.join(stored.filter(F.col("batch") != number).select(key), key, "left_anti")
        out = keyed.select(*batch.columns).unionByName(batch.filter(F.col(key).isNull()))
        out.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_copies(stream: DataFrame, key: str, time: str, within: str = "7 days") -> DataFrame:
    """The first copy of each message of a stream, with bounded state: a key is
    forgotten ``within`` after its first copy, so a copy that comes later than
    that is passed on again. ``drain`` is the exact way."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark([key])


def completed_files(pages: DataFrame) -> DataFrame:
    """Files none of whose pages is open: what the completion event is sent for."""
    per = pages.groupBy("file_id").agg(F.count("*").alias("pages"), F.count(F.when(F.col("status") != "completed", 1)).alias("open"))
    return per.filter("open = 0").select("file_id", "pages")


def read_stream(spark: SparkSession, path: str, schema, max_files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)
