"""Bulk writes of served rows to an external key-value store, from the executors."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame


def write_key_values(key_values: DataFrame, open_client: Callable[[], Any],
                     ttl_seconds: int = 3600, chunk: int = 1000) -> None:
    """Set and expire every ``serving_key`` through pipelines of ``chunk`` keys.

    ``open_client`` is called once per task and returns a client with ``pipeline()``
    whose result has ``set``, ``expire`` and ``execute``, as common Python clients do.
    Setting a key twice leaves it the same, so a retried task is harmless; an error
    fails the batch.
    """
    def send(rows) -> None:
        client, pending, pipe = None, 0, None
        for row in rows:
            if client is None:
                client = open_client()
                pipe = client.pipeline()
            pipe.set(row["serving_key"], row["value"])
            pipe.expire(row["serving_key"], ttl_seconds)
            pending += 1
            if pending == chunk:
                pipe.execute()
                pipe, pending = client.pipeline(), 0
        if pending:
            pipe.execute()

    key_values.select("serving_key", "value").foreachPartition(send)
