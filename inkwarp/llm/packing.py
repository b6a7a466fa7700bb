"""P6: items of varying length in containers of a fixed capacity, cut only where one is larger.

The global histogram of lengths has at most as many entries as the capacity, whatever the
number of items. Dynamic programming over it chooses the bucket boundaries that minimise
padding; inside each bucket, batches are filled up to the token budget, the longest first.
Containers that a bucket leaves with room for shorter items are topped up from the buckets
below, as batches of one bucket alone would leave up to half of a container unused. The plan
says, for each length, which ranks go to which containers; the items find their rank without
one task seeing a whole length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

CAPACITY = 4096
BUCKETS = 16
RANKED = 250_000  # items of one length that one task ranks, about


def bucket_bounds(counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of the buckets that need the least padding; counts[i]: items of length i.

    Every item of a bucket would be padded to its bound. Exact, in O(lengths^2 * buckets) at
    most, over the lengths that occur.
    """
    size = np.flatnonzero(counts)
    size = size[size > 0]
    if not len(size):
        return []
    n = np.concatenate(([0], np.cumsum(counts[size]))).astype(float)
    m = len(size)
    k = min(buckets, m)
    # cost of a bucket of sizes i..j-1 padded to size[j-1], without the tokens themselves, which are constant
    best = np.concatenate(([0.0], np.full(m, np.inf)))
    back = np.zeros((k + 1, m + 1), int)
    for b in range(1, k + 1):
        new = np.full(m + 1, np.inf)
        new[0] = 0.0
        for j in range(1, m + 1):
            c = best[:j] + size[j - 1] * (n[j] - n[:j])
            i = int(np.argmin(c))
            new[j], back[b, j] = c[i], i
        best = new
    out, j = [], m
    for b in range(k, 0, -1):
        if j == 0:
            break
        out.append(int(size[j - 1]))
        j = back[b, j]
    return sorted(out)


@dataclass
class Run:
    """Ranks start .. start + uses * containers - 1 of a length go to `containers` containers from `first`, `uses` to each."""

    length: int
    start: int
    uses: int
    containers: int
    first: int


def plan(counts: np.ndarray, capacity: int = CAPACITY, bounds: list[int] | None = None, first: int = 0) -> tuple[list[Run], int]:
    """The runs that place all counted items, and the next free container."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    used = np.zeros(len(left), np.int64)
    bounds = bucket_bounds(counts) if bounds is None else bounds
    floors = dict(zip(bounds, [0, *bounds[:-1]], strict=False))
    runs: list[Run] = []
    lengths = [int(x) for x in np.flatnonzero(left)[::-1]]
    while lengths := [x for x in lengths if left[x]]:
        top = lengths[0]
        floor = floors[min(b for b in bounds if b >= top)]
        room, pattern = capacity, []
        # First the bucket's own items, longest first; then what is left of the room by lower buckets.
        for own in (True, False):
            for x in lengths:
                if (x > floor) == own and x <= room:
                    k = int(min(room // x, left[x]))
                    if k:
                        pattern.append((x, k))
                        room -= k * x
        times = min(int(left[x]) // k for x, k in pattern)
        for x, k in pattern:
            runs.append(Run(x, int(used[x]), k, times, first))
            used[x] += k * times
            left[x] -= k * times
        first += times
    return runs, first


def pack(items: DataFrame, key: str, tokens: Column, capacity: int = CAPACITY, buckets: int = BUCKETS) -> DataFrame:
    """(key, part, parts, tokens, bucket, container): where each item, or each part of a cut one, goes.

    An item of more tokens than the capacity is cut into full parts, each a container of its
    own, and a rest that is placed like an item. Items of NULL or no tokens need no room and
    give no row; an empty table gives none. bucket is the bound of the item's length bucket.
    """
    base = items.select(F.col(f"`{key}`").alias("key"), tokens.cast("long").alias("n")).filter("n > 0")
    cut = base.select("key", "n", F.ceil(F.col("n") / capacity).cast("int").alias("parts"))
    part = cut.select("key", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "n").withColumn("tokens", F.least(F.lit(capacity), F.col("n") - F.col("part").cast("long") * capacity).cast("int")).drop("n")
    rows = settle(part)
    counts = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy("tokens").agg(F.count("*").alias("c")).collect():  # capacity rows at most
        counts[r["tokens"]] = r["c"]
    # A frequent length is ranked in as many parts as it needs.
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("key", "part"), F.lit(1 + int(counts.max(initial=0)) // RANKED)).cast("int"))
    grouped = rows.groupBy("tokens", "salt").agg(F.count("*").alias("c"))
    bounds = bucket_bounds(counts, buckets)
    runs, _ = plan(counts, capacity, bounds)
    spark = items.sparkSession
    placed = spark.createDataFrame([(r.length, r.start, r.uses, r.containers, r.first) for r in runs], "tokens int, start long, uses int, containers long, first long")
    size = spark.createDataFrame([(int(x), min(b for b in bounds if b >= x)) for x in np.flatnonzero(counts)], "tokens int, bucket int")
    before = F.coalesce(F.sum("c").over(Window.partitionBy("tokens").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offset = grouped.select("tokens", "salt", before.alias("before"))
    own = F.row_number().over(Window.partitionBy("tokens", "salt").orderBy("key", "part")) - 1
    ranked = rows.withColumn("own", own).join(F.broadcast(offset), ["tokens", "salt"]).withColumn("rank", F.col("own") + F.col("before"))
    # The plan has a few runs for each of at most `capacity` lengths.
    at = ranked.join(F.broadcast(placed), "tokens").filter((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("uses") * F.col("containers")))
    # Neighbouring ranks go to different containers, so that a container mixes items of different hash ranges.
    where = F.col("first") + F.pmod(F.col("rank") - F.col("start"), F.col("containers"))
    return at.join(F.broadcast(size), "tokens").select(F.col("key").alias(key), "part", "parts", "tokens", "bucket", where.alias("container"))


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(container, items, used, unused) of every container."""
    return packed.groupBy("container").agg(F.count("*").alias("items"), F.sum("tokens").alias("used")).withColumn("unused", F.lit(capacity) - F.col("used"))
