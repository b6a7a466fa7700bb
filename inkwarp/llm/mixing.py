"""P7: records of several sources mixed so that each has its share of all tokens.

Temperature mixing. The weights are the target shares drawn towards the sources' own token
shares by an exponent that is bisected until every limit of repetition holds; it is 1, and the
targets are met in full, for as large a mixture as that allows. Or the own shares alone are
exponentiated, the exponent bisected until their entropy is that of the targets. The weights
become token budgets: whole passes over a source, and of the last pass those blocks of a
permutation that fit, the block at the edge record by record.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .subjects import source_name

BLOCKS = 1024


def entropy(weights: dict[str, float]) -> float:
    total = sum(weights.values())
    return -sum(w / total * log(w / total) for w in weights.values() if w > 0)


def tempered(shares: dict[str, float], exponent: float) -> dict[str, float]:
    raw = {s: p**exponent for s, p in shares.items() if p > 0}
    total = sum(raw.values()) or 1.0
    return {s: w / total for s, w in raw.items()}


def bisect(good, lo: float, hi: float, steps: int = 60) -> float:
    """The largest x between lo and hi for which good holds, if it holds up to some point; lo if nowhere."""
    if good(hi):
        return hi
    for _ in range(steps):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if good(mid) else (lo, mid)
    return lo


def exponent_for_entropy(shares: dict[str, float], wanted: float) -> float:
    """The exponent at which the tempered shares have the entropy: 0 is uniform, 1 as they are."""
    return bisect(lambda a: entropy(tempered(shares, a)) >= wanted, 0.0, 16.0)


def weigh(held: dict[str, int], targets: dict[str, tuple[float, int]], total: int | None = None, by_entropy: bool = False) -> tuple[dict[str, float], float, float]:
    """Weights of the sources, the size of the mixture in tokens, and the exponent behind the weights.

    held: tokens of each source; targets: (share, most repeats). A target without tokens gets
    none and the others fill its share; sources without a target are left out. Without a
    total the mixture is the largest that keeps the weights; a larger total than any exponent
    allows is brought down to what the limits allow. by_entropy: the own shares tempered to the
    entropy of the targets, instead of the targets.
    """
    open_ = {s: t for s, (t, r) in targets.items() if held.get(s, 0) > 0 and t > 0 and r > 0}
    if not open_:
        return {}, 0.0, 1.0
    norm = sum(open_.values())
    share = {s: t / norm for s, t in open_.items()}
    most = {s: held[s] * targets[s][1] for s in share}
    whole = sum(held[s] for s in share)
    own = {s: held[s] / whole for s in share}
    if by_entropy:
        a = exponent_for_entropy(own, entropy(share))
        weights = tempered(own, a)
        size = min(most[s] / weights[s] for s in weights)
        return weights, float(size if total is None else min(size, total)), a
    size = min(most[s] / share[s] for s in share) if total is None else min(total, sum(most.values()))
    # At 0 each source has what all its repeats would fill, which any total allows.
    full = {s: most[s] / sum(most.values()) for s in share}

    def at(a: float) -> dict[str, float]:
        raw = {s: share[s] ** a * full[s] ** (1 - a) for s in share}
        return {s: w / sum(raw.values()) for s, w in raw.items()}

    a = bisect(lambda x: all(at(x)[s] * size <= most[s] * (1 + 1e-9) for s in share), 0.0, 1.0)
    return at(a), float(size), a


def _of_source(documents: DataFrame, tokens: Column) -> DataFrame:
    return documents.select("doc_id", source_name(F.col("source")).alias("source"), tokens.cast("long").alias("tokens")).filter("tokens > 0")


def read_targets(targets: DataFrame) -> dict[str, tuple[float, int]]:
    """The targets by source; a repeated source adds up its shares. A list small by its nature."""
    rows = targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats").filter("source is not null and target_share is not null")
    return {r[0]: (r[1], r[2] or 1) for r in rows.groupBy("source").agg(F.sum("target_share"), F.max("max_repeats")).collect()}


def _first_that_fit(rows: DataFrame) -> DataFrame:
    """Of each source the records that come first in the order of h and together fit its budget `rest`."""
    rows = rows.withColumn("block", F.pmod("h", F.lit(BLOCKS)).cast("int"))
    sums = rows.groupBy("source", "block").agg(F.sum("tokens").alias("n"))
    until = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.join(F.broadcast(sums.withColumn("until", until)), ["source", "block"])  # BLOCKS rows for each target
    inside = placed.filter(F.col("until") + F.col("n") <= F.col("rest"))
    edge = placed.filter((F.col("until") < F.col("rest")) & (F.col("until") + F.col("n") > F.col("rest")))
    running = F.sum("tokens").over(Window.partitionBy("source", "block").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    fits = edge.withColumn("run", running).filter(F.col("until") + F.col("run") <= F.col("rest"))
    return inside.select(*rows.columns).unionByName(fits.select(*rows.columns)).drop("block")


def _mixed(rows: DataFrame, goals: dict[str, tuple[float, int]], total: int | None, seed: int, by_entropy: bool) -> tuple[DataFrame, dict[str, float], float]:
    mine = rows.filter(F.col("source").isin(list(goals)))
    sizes = {r[0]: (r[1], r[2]) for r in mine.groupBy("source").agg(F.sum("tokens"), F.min("tokens")).collect()} if goals else {}  # a row for each target
    weights, size, exponent = weigh({s: n for s, (n, _) in sizes.items()}, goals, total, by_entropy)
    spark = rows.sparkSession
    epoch = {s: int(w * size // sizes[s][0]) for s, w in weights.items()}
    rest = {s: int(w * size - epoch[s] * sizes[s][0] + 1e-6) for s, w in weights.items()}
    whole = spark.createDataFrame([(s, e) for s, e in epoch.items() if e], "source string, whole int")
    parts = [rows.join(F.broadcast(whole), "source").select("doc_id", "source", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("epoch"), "tokens")]
    while True:
        # A source whose next pass its limit allows and whose shortest record fits.
        open_ = [(s, epoch[s], rest[s]) for s in rest if epoch[s] < goals[s][1] and rest[s] >= sizes[s][1]]
        if not open_:
            break
        left = mine.join(F.broadcast(spark.createDataFrame(open_, "source string, epoch int, rest long")), "source").filter("tokens <= rest")
        for taken in parts[1:]:
            left = left.join(taken.select("doc_id", "source", "epoch"), ["doc_id", "source", "epoch"], "left_anti")
        taken = settle(_first_that_fit(left.withColumn("h", F.xxhash64("doc_id", F.lit(seed), "epoch"))).select("doc_id", "source", "epoch", "tokens"))
        parts.append(taken)
        spent = dict(taken.groupBy("source").agg(F.sum("tokens")).collect())
        for s, _, _ in open_:
            # A long record stops a turn short of the budget; shorter ones follow, at last of another pass.
            rest[s] -= spent.get(s, 0)
            epoch[s] += s not in spent
    return reduce(DataFrame.unionByName, parts).withColumn("place", F.xxhash64("doc_id", "epoch", F.lit(seed))), weights, exponent


def mixture(documents: DataFrame, targets: DataFrame, tokens: Column, total: int | None = None, seed: int = 11, by_entropy: bool = False) -> DataFrame:
    """(doc_id, source, epoch, tokens, place): the records of the mixture, one row for each time one is used.

    Texts without tokens and sources without a target are not used. place orders an epoch's
    records of all sources at random; the same seed gives the same mixture. No source exceeds
    its budget; what it lacks is less than its shortest record, or than any record not used as often
    as its limit allows. Of records that repeat a doc_id within
    a source those that fit are taken together.
    """
    return _mixed(settle(_of_source(documents, tokens)), read_targets(targets), total, seed, by_entropy)[0]


def shares(documents: DataFrame, targets: DataFrame, tokens: Column, total: int | None = None, seed: int = 11, by_entropy: bool = False) -> DataFrame:
    """(source, target_share, max_repeats, held, used, repeats, actual_share, weight, exponent) of every target and every source."""
    rows = settle(_of_source(documents, tokens))
    mixed, weights, exponent = _mixed(rows, read_targets(targets), total, seed, by_entropy)
    used = settle(mixed.groupBy("source").agg(F.sum("tokens").alias("used"), (F.max("epoch") + 1).alias("repeats")))
    held = rows.groupBy("source").agg(F.sum("tokens").alias("held"))
    want = targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats")
    whole = used.agg(F.sum("used")).first()[0] or 1
    given = rows.sparkSession.createDataFrame(list(weights.items()), "source string, weight double")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return want.join(held, "source", "full").join(used, "source", "left").join(F.broadcast(given), "source", "left").select(
        "source", "target_share", "max_repeats", zero("held"), zero("used"), zero("repeats"), (F.coalesce("used", F.lit(0)) / whole).alias("actual_share"),
        F.coalesce("weight", F.lit(0.0)).alias("weight"), F.lit(exponent).alias("exponent"),
    )
