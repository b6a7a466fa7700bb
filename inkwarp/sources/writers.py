"""Sinks: progress, data set and images. Spark's committer publishes a result as a whole."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def write_progress(status: DataFrame, path: str, one_file: bool = False) -> None:
    """arxiv_id,count in queue order, each paper once, NULL as an empty field; in one file, through one task, only if asked."""
    rows = status.groupBy("paper").agg(F.min("pos").alias("pos"), F.max("fig_count").alias("count"))
    rows = rows.orderBy("pos") if not one_file else rows.repartition(1).sortWithinPartitions("pos")
    rows.select(F.col("paper").alias("arxiv_id"), "count").write.mode("overwrite").csv(path, header=True, nullValue="", emptyValue="")


def write_dataset(records: DataFrame, path: str) -> None:
    """One JSON object a line, keyed by its filename field."""
    records.write.mode("overwrite").json(path)


def dataset_object(records: DataFrame) -> DataFrame:
    """(json): all records as one object by filename, for a small result only."""
    rest = [c for c in records.columns if c != "filename"]
    return records.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("filename", F.struct(*rest)))))).alias("json"))


def write_images(figures: DataFrame, folder: str) -> int:
    """Writes image_bytes of each row to its filename in a folder that all executors share; returns how many."""

    def run(rows: Iterator[Row]) -> Iterator[int]:
        os.makedirs(folder, exist_ok=True)
        n = 0
        for r in rows:
            if r["image_bytes"] is not None:
                at = os.path.join(folder, r["filename"])
                with open(f"{at}.part", "wb") as f:
                    f.write(r["image_bytes"])
                os.replace(f"{at}.part", at)
                n += 1
        yield n

    return figures.select("filename", "image_bytes").rdd.mapPartitions(run).sum()


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)
