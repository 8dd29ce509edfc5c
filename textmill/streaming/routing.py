"""Routing a message stream, control messages first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from textmill.operators.tasks import route_messages
from textmill.streaming.sink import WHAT_HAS_ARRIVED


def start_routing(messages: DataFrame, table: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write the routed messages of each batch below ``table``, one folder per route.

    Inside a batch the control rows are written before any other: who reads the
    control folder knows of a stop before the tasks of that batch appear.
    Across batches arrival order holds.  A batch is read once for each lane, so nothing is held by executors.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        routed = route_messages(batch)
        for lane, rows in (("control", "route = 'control'"), ("work", "route <> 'control'")):
            routed.where(rows).write.mode("overwrite").parquet(f"{table}/lane={lane}/batch={batch_id}")

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or WHAT_HAS_ARRIVED))
        .start()
    )
