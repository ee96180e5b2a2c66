"""The message trunk: publishing, reading, routing and decoding."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from beaconry import schemas
from beaconry.functions.messages import decode_json, encode_json, salted_key

# fixed values: key prefix and topic of each message kind
PREFIXES = {"cpu_usage": "cu", "mem_used": "mu", "alert": "al"}
TOPICS = {"cpu_usage": "cpu.usage", "mem_used": "mem.used", "alert": "alert"}
STATUSES = ("OPEN", "CLOSED")


def to_messages(df: DataFrame, prefix: str | Column, salt: int = 100, spread: str = "id") -> DataFrame:
    """Rows as (key, value) messages whose keys spread over ``salt`` values per prefix."""
    return df.select(salted_key(prefix, F.col(spread), salt).alias("key"), encode_json(df).alias("value"))


def publish(messages: DataFrame, brokers: str, topic: str) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).save()


# what one micro-batch takes at most, so that a backlog is worked off in bounded steps
MAX_OFFSETS, MAX_FILES = 10_000_000, 1_000


def trunk_options(brokers: str, topics: Sequence[str], starting: str = "latest",
                  max_offsets: int = MAX_OFFSETS) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "subscribe": ",".join(topics), "startingOffsets": starting,
            "maxOffsetsPerTrigger": str(max_offsets)}


def read_trunk(spark: SparkSession, brokers: str, topics: Sequence[str] = tuple(TOPICS.values()),
               starting: str = "latest", max_offsets: int = MAX_OFFSETS) -> DataFrame:
    """All topics as one stream of string keys and values. Needs Spark's Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").options(**trunk_options(brokers, topics, starting, max_offsets)).load()
    return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def read_trunk_files(spark: SparkSession, path: str, max_files: int = MAX_FILES) -> DataFrame:
    """The trunk from a folder of (key, value) Parquet files, in arrival order."""
    return spark.readStream.schema(schemas.TRUNK).option("maxFilesPerTrigger", max_files).parquet(path)


def route(trunk: DataFrame, prefix: str) -> DataFrame:
    return trunk.filter(F.col("key").startswith(prefix))


def fork(stream: DataFrame, *branches: Callable[[DataFrame], StreamingQuery]) -> list[StreamingQuery]:
    """Start several queries on one stream; each keeps its own checkpoint and progress."""
    return [start(stream) for start in branches]


def decode(messages: DataFrame, schema: T.StructType, valid: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The message fields, the message itself as ``raw``, the columns to ``keep``, and ``is_valid``.

    A message that is not JSON, lacks a field or has one of the wrong type is not
    valid, nor is one that fails the extra condition. Nothing is dropped here.

    The parsed struct passes through explode, which filters do not move across:
    otherwise a filter on validity would parse the message again for every field it tests.
    """
    parsed = messages.select(F.col("value").alias("raw"), *keep, F.explode(F.array(decode_json("value", schema))).alias("m"))
    parsed = parsed.select("raw", *keep, "m.*")
    ok = F.lit(True) if valid is None else valid
    for name in schema.names:
        ok = F.col(name).isNotNull() & ok
    return parsed.withColumn("is_valid", F.coalesce(ok, F.lit(False)))


def decode_metric(messages: DataFrame, *keep: str) -> DataFrame:
    return decode(messages, schemas.METRIC_MESSAGE, keep=keep)


def decode_alert(messages: DataFrame) -> DataFrame:
    return decode(messages, schemas.ALERT_MESSAGE, F.col("status").isin(*STATUSES))


def accepted(decoded: DataFrame) -> DataFrame:
    """The valid messages, their epoch seconds turned into event times."""
    rows = decoded.filter("is_valid").drop("is_valid", "raw")
    return rows.withColumn("timestamp", F.timestamp_seconds("timestamp"))


def quarantined(decoded: DataFrame) -> DataFrame:
    """The messages that could not be used, unchanged."""
    return decoded.filter(~F.col("is_valid")).select("raw")
