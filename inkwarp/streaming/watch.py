"""Pages that arrive in a folder are mined as they come; the checkpoint remembers what is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import classify as C


def watch_candidates(spark: SparkSession, folder: str, schema, sink: str, checkpoint: str, files_per_batch: int = 8) -> StreamingQuery:
    """Classifies candidates of new parquet files once each and appends the accepted to the sink."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)

    def put(batch: DataFrame, number: int) -> None:
        # A batch that is repeated after a failure overwrites its own folder.
        C.classify(batch).filter("accepted").write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
