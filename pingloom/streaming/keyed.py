"""Latest position per vehicle kept as streaming state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pingloom.operators.latest import newest


def latest_stream(positions: DataFrame, order: str = "arrival") -> DataFrame:
    """Latest positions of a stream: state is one row per vehicle and never expires.

    Use the update output mode for changed vehicles only, complete for the whole table.
    """
    return newest(positions, order=order)


def start_latest(positions: DataFrame, folder: str, checkpoint: str, order: str = "arrival") -> StreamingQuery:
    """Write the whole latest table after every batch, each to its own folder, replaced on rerun."""

    def save(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return (
        latest_stream(positions, order)
        .writeStream.outputMode("complete")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
