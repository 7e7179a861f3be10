"""Keyed publish from the job (K2-K4, K7): rows of a micro-batch as messages of a topic.

Messages leave before the batch is entered in the ledger.  A batch that is lost in
between is sent again, so delivery is at least once, and every message carries an id
in its ``message_id`` header, ``<query id>-<batch id>-<hash of key and value>``, that is
the same in each attempt: consumers drop what they have seen.  (Rows that are equal in
all published columns have one id.)
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackstream import schema as S
from trackstream.operators import routing

Send = Callable[[DataFrame, str], None]


@dataclass(frozen=True)
class Topics:
    """Where each output goes (None: nowhere) and what sends it."""

    send: Send
    processed: str | None = S.PROCESSED_TOPIC
    invalid: str | None = S.INVALID_OUT_TOPIC
    aggregated: str | None = S.AGGREGATED_TOPIC
    key: str = "icao24"


def broker_options(bootstrap: str, topic: str, options: dict | None = None) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, **(options or {})}


def to_broker(bootstrap: str, options: dict | None = None) -> Send:
    """Send with the broker connector (not part of the tests: it needs a broker)."""
    def send(messages: DataFrame, topic: str) -> None:
        messages.write.format("kafka").options(**broker_options(bootstrap, topic, options)).save()
    return send


def messages(df: DataFrame, query_id: str, batch_id: int, *, key: str = "icao24") -> DataFrame:
    """(key, value, headers) of the rows of a micro-batch."""
    kv = routing.encode_kv(df, key=key)
    name = F.concat_ws("-", F.lit(query_id), F.lit(batch_id), F.hex(F.xxhash64("key", "value")))
    return kv.withColumn("headers", F.array(F.struct(
        F.lit("message_id").alias("key"), name.cast("binary").alias("value"))))


def publish(df: DataFrame, topics: Topics | None, topic: str | None, query_id: str,
            batch_id: int) -> None:
    if topics is not None and topic is not None:
        topics.send(messages(df, query_id, batch_id, key=topics.key), topic)
