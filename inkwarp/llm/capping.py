"""P2: at most so many records, or such a share, from each contributor, the best ones kept.

Parallel bisection. Every contributor over the limit has bounds on its cutoff. In each round
the records of all contributors are counted above a row of midpoints between their bounds,
in one aggregation with partial counts on the map side; the interval that holds the cutoff
gives the next bounds, tightened to the values that occur. A contributor's records are never
brought into one task, whatever share of all rows it owns. Ties at a cutoff are resolved by
the next score and at last by the identifier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle, small_side

BIG = 1.7976931348623157e308
LEAST, LOW = -BIG, -1.797e308
BROADCAST_ROWS = 100_000  # of under 100 bytes: 10 MB at most
SALTS = 32


def rank_value(score: Column) -> Column:
    """A double that orders like the score, with NULL and NaN below every number."""
    x = score.cast("double")
    return F.when(x.isNull() | F.isnan(x), F.lit(LEAST)).otherwise(F.greatest(F.lit(LOW), F.least(x, F.lit(BIG))))


def _with_bounds(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """rows joined to their contributor's bounds: broadcast if they are few, else salted."""
    hinted = small_side(bounds, BROADCAST_ROWS)
    if hinted is not bounds:
        return rows.join(hinted, "g")
    many = bounds.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(many, ["g", "salt"]).drop("salt")


def _bisect(rows: DataFrame, value: str, need: DataFrame, mids: int) -> DataFrame:
    """(g, cut, need, tied): values above cut stay; of those at cut, all or (tied) the first `need`.

    rows: g, id and the value; need: g and how many of its rows stay, fewer than it has.
    """
    kind = dict(rows.dtypes)[value]
    bounds = settle(
        _with_bounds(rows.select("g", "id", value), need).groupBy("g")
        .agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count("*").alias("n"), F.first("need").alias("need"))
    )
    done = None
    while True:
        ends = (F.col("lo") == F.col("hi")) | (F.col("n") == F.col("need"))
        over = bounds.filter(ends).select("g", F.col("lo").alias("cut"), "need", (F.col("n") > F.col("need")).alias("tied"))
        done = over if done is None else done.unionByName(over)
        bounds = bounds.filter(~ends).drop("n")
        if bounds.isEmpty():
            return settle(done)
        v, lo, hi = F.col(value), F.col("lo"), F.col("hi")
        if kind == "double":  # halves, as the difference of two doubles may overflow
            part = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
        else:
            part = (v.cast("decimal(20,0)") - lo.cast("decimal(20,0)")).cast("double") / (hi.cast("decimal(20,0)") - lo.cast("decimal(20,0)")).cast("double")
        counted = (
            _with_bounds(rows.select("g", "id", value), bounds).filter((v >= lo) & (v <= hi))
            .groupBy("g", F.least(F.floor(part * mids), F.lit(mids - 1)).alias("bucket"))
            .agg(F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"), F.first("need").alias("need"))
        )
        above = F.coalesce(F.sum("n").over(Window.partitionBy("g").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        bounds = settle(
            counted.withColumn("above", above).filter((F.col("above") < F.col("need")) & (F.col("above") + F.col("n") >= F.col("need")))
            .select("g", "lo", "hi", "n", (F.col("need") - F.col("above")).alias("need"))
        )


def count_for_share(counts: DataFrame, share: float, mids: int = 64) -> int:
    """The largest cap under which no contributor has more than the share of what remains.

    counts: g, n. Again by bisection, all midpoints in one aggregation of one row. 0 if even a
    cap of 1 leaves one contributor more than its share.
    """
    lo, hi = 0, counts.agg(F.max("n")).first()[0] or 0
    while lo < hi:
        tries = sorted({lo + -(-(hi - lo) * k // mids) for k in range(1, mids + 1)})
        left = counts.agg(*(F.sum(F.least("n", F.lit(c))).alias(f"c{c}") for c in tries)).first()
        fits = [c for c in tries if c <= share * left[f"c{c}"]]
        # A larger cap fits only if every smaller one does: what remains grows no faster than the cap.
        lo, hi = max(fits, default=lo), min([c - 1 for c in tries if c not in fits], default=hi)
    return lo


def over_cap(df: DataFrame, group: Column, key: str, scores: list[str], cap: int | None = 10, share: float | None = None, mids: int = 64) -> DataFrame:
    """(key): the rows to drop so that no group keeps more than the cap, its best ones kept.

    Higher scores stay first, one score after the other, then the smaller key. NULL and NaN
    scores rank below all numbers and tie with each other. Rows whose group is NULL are never
    dropped. With a share, the cap is the largest under which no group has more than that
    share of all rows kept. An empty table gives none. Rows that repeat a key and all scores
    are dropped together where only some of them would fit. The key is a long and not NULL;
    rows without one are treated as its greatest value.
    """
    id_ = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(2**63 - 1))
    rows = df.select(group.alias("g"), (-id_).alias("id"), *(rank_value(F.col(f"`{s}`")).alias(f"s{i}") for i, s in enumerate(scores))).filter(F.col("g").isNotNull())
    counts = rows.groupBy("g").agg(F.count("*").alias("n"))
    if cap is None or share is not None:
        counts = settle(counts)
        by_share = count_for_share(counts.select("g", "n"), share)
        cap = by_share if cap is None else min(cap, by_share)
    over = settle(counts.filter(F.col("n") > cap).select("g"))
    active = settle(_with_bounds(rows, over))  # read once; every round goes over these rows only
    if cap <= 0:
        return active.select((-F.col("id")).alias(key))
    levels = [f"s{i}" for i in range(len(scores))] + ["id"]
    need, tied, cuts = over.withColumn("need", F.lit(cap).cast("long")), active, over
    for name in levels:
        cut = _bisect(tied, name, need, mids)
        cuts = cuts.join(cut.select("g", F.col("cut").alias(f"c_{name}"), F.col("tied").alias(f"t_{name}")), "g", "left")
        need = cut.filter("tied").select("g", "need")
        if need.isEmpty():
            levels = levels[: levels.index(name) + 1]
            break
        at = cut.filter("tied").select("g", "cut")
        tied = settle(_with_bounds(tied, at).filter(F.col(name) == F.col("cut")).drop("cut"))
    cuts = settle(cuts)
    keep: Column = F.lit(False)
    for name in reversed(levels):
        v, c, t = F.col(name), F.col(f"c_{name}"), F.col(f"t_{name}")
        keep = (v > c) | (v == c) & (~t | keep)
    return _with_bounds(active, cuts).filter(~F.coalesce(keep, F.lit(False))).select((-F.col("id")).alias(key))


def cap_rows(df: DataFrame, group: Column, key: str, scores: list[str], **limits) -> DataFrame:
    """df without the rows over the cap; all its columns stay. See over_cap."""
    return df.join(over_cap(df, group, key, scores, **limits), key, "left_anti")
