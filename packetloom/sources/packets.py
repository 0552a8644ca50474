"""Packet feeds: tables, file streams, Kafka, and packets pushed as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PACKET_SCHEMA = T.StructType(
    [
        T.StructField("payload", T.BinaryType()),
        T.StructField("addr", T.StringType()),
        T.StructField("port", T.StringType()),
        T.StructField("arrival_ts", T.TimestampType()),
        T.StructField("arrival_seq", T.LongType()),
    ]
)
PUSHED_SCHEMA = "struct<remote:string,data:string>"


def read_packets(spark: SparkSession, path: str, source: str = "parquet", **options: str) -> DataFrame:
    """Batch packet feed from files of any columnar format Spark reads."""
    reader = spark.read.schema(PACKET_SCHEMA).format(source)
    return reader.options(**options).load(path)


def stream_packets(
    spark: SparkSession,
    path: str,
    source: str = "parquet",
    max_files_per_trigger: int | None = 1000,
    **options: str,
) -> DataFrame:
    """Streaming packet feed from files. `max_files_per_trigger` is the ingest limit of one micro-batch."""
    reader = spark.readStream.schema(PACKET_SCHEMA).format(source).options(**options)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def stream_pushed(
    spark: SparkSession, servers: str, topic: str, max_offsets_per_trigger: int | None = 100000, **options: str
) -> DataFrame:
    """Streaming feed of pushed packets from a Kafka topic (the Kafka package must be on the class path).

    Only one partition per source keeps arrival order in the offset, which then serves as `arrival_seq`.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    feed = reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("arrival_ts"),
        F.col("offset").alias("arrival_seq"),
    )
    return unwrap_pushed(feed)


def unwrap_pushed(pushed: DataFrame) -> DataFrame:
    """JSON envelopes (`value`) to packets. The remote is split at its last colon, so `[::1]:1234` works.

    Rows whose envelope cannot be read are left out here and listed by `bad_envelopes`.
    """
    return _opened(pushed).filter("addr IS NOT NULL AND payload IS NOT NULL").select(*PACKET_SCHEMA.fieldNames())


def bad_envelopes(pushed: DataFrame) -> DataFrame:
    return (
        _opened(pushed)
        .filter("addr IS NULL OR payload IS NULL")
        .select(F.lit("envelope").alias("reason"), F.encode("value", "UTF-8").alias("payload"), "arrival_seq")
    )


def _opened(pushed: DataFrame) -> DataFrame:
    envelope = F.from_json("value", PUSHED_SCHEMA)
    remote = F.col("envelope.remote")
    port = F.substring_index(remote, ":", -1)
    return pushed.withColumn("envelope", envelope).select(
        "value",
        F.try_to_binary(F.col("envelope.data"), F.lit("base64")).alias("payload"),
        F.when(
            remote.contains(":"), F.substring(remote, F.lit(1), F.char_length(remote) - F.char_length(port) - 1)
        ).alias("addr"),
        port.alias("port"),
        "arrival_ts",
        "arrival_seq",
    )
