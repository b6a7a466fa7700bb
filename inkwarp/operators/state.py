"""Resumable progress: the queue of papers, what is done, what comes next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import lexicons as L


def queue_id(raw: Column) -> Column:
    """A listed id as it is queued: stripped, in lower case, without arxiv:; NULL for a blank line."""
    x = F.trim(F.replace(F.lower(F.regexp_replace(raw, r"^\s+|\s+$", "")), F.lit("arxiv:"), F.lit("")))
    return F.when(F.regexp_replace(raw, r"\s+", "") != "", x)


def with_status(queue: DataFrame, progress: DataFrame) -> DataFrame:
    """(pos, paper, fig_count): the queue with each paper's count by its latest report.

    queue: pos, paper; progress: paper, fig_count, logged_at. A paper listed twice keeps both
    places. NULL means unprocessed. Reports of papers in no queue are ignored; of reports of
    one time the larger count holds.
    """
    last = progress.filter(F.col("paper").isNotNull()).groupBy("paper").agg(F.max_by(F.struct("fig_count"), F.struct("logged_at", "fig_count")).alias("l")).select("paper", F.col("l.fig_count").alias("fig_count"))
    return queue.join(last, "paper", "left").select("pos", "paper", "fig_count")


def unprocessed(status: DataFrame, claimed: DataFrame | None = None) -> DataFrame:
    """(pos, paper): the papers still to do, each at its first place, without those claimed."""
    todo = status.filter(F.col("fig_count").isNull()).groupBy("paper").agg(F.min("pos").alias("pos"))
    if claimed is not None:
        todo = todo.join(claimed.select("paper"), "paper", "left_anti")
    return todo.select("pos", "paper")


def claim(status: DataFrame, batch: int, claimed: DataFrame | None = None) -> DataFrame:
    """The next papers in queue order, as many as a batch holds."""
    return unprocessed(status, claimed).orderBy("pos").limit(batch)


def total_collected(status: DataFrame) -> DataFrame:
    """(total, papers_done): over distinct papers; 0 for an empty queue."""
    one = status.groupBy("paper").agg(F.max("fig_count").alias("c"))
    return one.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"), F.count("c").alias("papers_done"))


def accepted_per_paper(figures: DataFrame) -> DataFrame:
    """(paper, found): how many figures of each paper are accepted, also 0."""
    return figures.groupBy("paper").agg(F.count_if(F.col("accepted")).alias("found"))


def merge_counts(status: DataFrame, finished: DataFrame) -> DataFrame:
    """status with the counts of finished papers (paper, fig_count; failed ones have 0) put in."""
    new = finished.groupBy("paper").agg(F.max("fig_count").alias("new"))
    return status.join(new, "paper", "left").select("pos", "paper", F.coalesce("new", "fig_count").alias("fig_count"))


BLOCK = 1000


def within_target(counts: DataFrame, target: int = L.IMAGE_TARGET) -> DataFrame:
    """(pos, n, before): the papers started before the total reached the target; the last may overshoot it.

    counts: pos, n. The running total is taken over blocks of positions first, so no task sees
    more than one block or the list of blocks.
    """
    block = F.floor(F.col("pos") / BLOCK)
    rows = counts.select("pos", F.coalesce("n", F.lit(0)).alias("n"), block.alias("block"))
    sums = rows.groupBy("block").agg(F.sum("n").alias("s"))
    upto = sums.select("block", F.coalesce(F.sum("s").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    own = F.coalesce(F.sum("n").over(Window.partitionBy("block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_ = upto.filter(F.col("base") < target)
    return rows.join(open_, "block").withColumn("before", F.col("base") + own).filter(F.col("before") < target).select("pos", "n", "before")
