"""JSON and key expressions for stream messages and master documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry import schemas
from beaconry.functions.times import col


def encode_json(df: DataFrame) -> Column:
    """The row as a JSON object; timestamps are written as epoch seconds."""
    fields = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = F.unix_timestamp(c).alias(f.name)
        fields.append(c)
    return F.to_json(F.struct(*fields))


def salted_key(prefix: str | Column, spread: Column, salt: int = 100) -> Column:
    """``prefix|n`` with n in [0, salt), derived from the row so that a retried task sends the same key."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(prefix, F.lit("|"), F.pmod(F.xxhash64(spread), F.lit(salt)).cast("string"))


def decode_json(value: Column | str, schema: T.StructType) -> Column:
    return F.from_json(col(value), schema, {"mode": "PERMISSIVE"})


def decode_server_document(value: Column | str) -> Column:
    return decode_json(value, schemas.SERVER_DOCUMENT)


def metric_key(name: Column | str) -> Column:
    """The name thresholds use for a stream's metric: ``cpu_usage`` is ``cpu.usage``."""
    return F.translate(col(name), "_", ".")


def state_key(server_id: Column | str, timestamp: Column | str) -> Column:
    """Row key of a server state: both numbers as 8 big-endian bytes, in hex."""
    return F.concat(*[F.lpad(F.hex(col(c).cast("long")), 16, "0") for c in (server_id, timestamp)])
