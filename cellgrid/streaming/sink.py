"""Streams into tables: each micro-batch is one write, named by its query and number, so a repeated batch replaces itself."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cellgrid.sources.table import Table


def upsert_stream(stream: DataFrame, table: Table, checkpoint: str, timestamp: int | None = None, **trigger: object) -> StreamingQuery:
    """Start a query that writes ``stream`` into ``table``; ``checkpoint`` names the query for good."""
    if not table.exists():
        table.create()
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def put(batch: DataFrame, number: int) -> None:
        table.write(batch, timestamp=timestamp, write_id=f"{name}-{number}")

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
