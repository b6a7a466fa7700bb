"""P3: train, validation and test splits that keep related records together.

Records belong together if they share an entity (a paper) or a text (a caption that is the
same but for label, case, spacing, punctuation, characters, scan damage, two changed words or
a short closing remark). Texts are reduced to glyph keys, which no misreading alters. A text
that may hold a header line or a closing remark has a form without it as well; two texts are
the same if a form of one differs from a form of the other in at most the words allowed.
Components over entities and texts are the groups; groups go to the splits in the order of
their hash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import paper, settle
from .components import components
from .glyphs import unify_arrow
from .scans import glyph_key

CHANGED = 2  # words that may differ
SHARE = 5  # of so many words one may differ
REMARK = 10  # words of a closing remark, which is no longer than what it closes
PARTS = 5  # into which a text is cut to find texts that agree in all but CHANGED of them
PAIRS = 32  # texts that agree so beyond which they are cut further instead of compared in pairs

_FOLIO = re.compile(r"\W*(?:p(?:age|[.])?\s*)?[\dlIoOsSB]{1,5}(?:\s+of\s+[\dlIoOsSB]{1,5})?\W*", re.I)
_HEADING = re.compile(r"(?:\d+\s+)?(?:[^\W\d_a-z]|l)")  # a page number may lead; an I may be read as l
_BARE = re.compile(r"\W*[\dlIoOsSB]{1,5}\W*", re.I)
_TOKEN = re.compile(r"[^\W_]+|[^\w\s.,:;()\[\]{}'\"—–-]+")
_CUT = re.compile(r"[-¬]\s+(?=\w)")
_NUMBER = re.compile(r"[\dlos]{1,7}", re.I)


@lru_cache(500_000)
def skeleton(word: str) -> str:
    return word if word.isdigit() else glyph_key(word)


_LABELS = {skeleton(x) for x in ("fig", "figure", "tab", "table")}


def allowed(n: int) -> int:
    """Words that may differ between two texts of n words: a fifth, so that four fifths agree, and two at most."""
    return min(CHANGED, n // SHARE)


def _words(lines: list[str]) -> tuple[list[str], list[bool]]:
    """The skeletons of the words without the leading label and its number, and whether each begins a sentence or with a capital."""
    text = _CUT.sub("", "\n".join(lines)).replace("-", "")
    found = list(_TOKEN.finditer(text))
    words = [skeleton(m[0].lower()) for m in found]
    starts = [m[0][0].isupper() or bool(re.search(r"[.;:!?]\W*$", text[max(0, m.start() - 4) : m.start()])) for m in found]
    skip = 0
    if words and words[0] in _LABELS:
        skip = 2 if len(words) > 1 and _NUMBER.fullmatch(found[1][0]) else 1
    return words[skip:], starts[skip:]


def _set_apart(lines: list[str]) -> list[bool]:
    """Of each line whether it is not one that wrapping made: it is wider than all others, or the next word would still have fitted."""
    width = [len(x.rstrip()) for x in lines]
    top = sorted(width)[-2:]
    out = []
    for i, n in enumerate(width):
        wide = top[0] if n == top[-1] else top[-1]
        out.append(n > wide or i + 1 == len(lines) or n + 1 + len((lines[i + 1].split(None, 1) or [""])[0]) <= wide)
    return out


def _may_be_header(lines: list[str], i: int, apart: list[bool] | None) -> bool:
    """Whether the text may go on without line i: it begins like a heading, doesn't end like a part of a sentence,
    and the next line doesn't go on with a sentence that the line has begun. In a text without capitals, which
    shows no heading, it may be any line that is set apart.
    """
    line = lines[i].strip()
    if line[-1:] in ".,;:-¬":
        return False
    if apart:
        return apart[i]
    open_ = i + 1 == len(lines) or lines[i - 1].rstrip()[-1:] not in ".;:!?" or not lines[i + 1].lstrip()[:1].islower()
    return open_ and bool(_HEADING.match(line))


def forms(text: str) -> Iterator[tuple[list[str], bool]]:
    """(words, whole) of a unified text: as it is first, without each line that may be a header, and all these
    without a closing remark (whole is then false). Lines that are page numbers alone never count, but
    for a bare number at the end, which may also be the text's last word.
    """
    lines = text.split("\n")
    lines = [x for i, x in enumerate(lines) if i == 0 or not _FOLIO.fullmatch(x) or i == len(lines) - 1 and _BARE.fullmatch(x)]
    flat = not any(c.isupper() for c in text)
    apart = _set_apart(lines) if flat else None
    for i in range(len(lines)):
        if i and not _may_be_header(lines, i, apart) and not (i == len(lines) - 1 and _BARE.fullmatch(lines[i])):
            continue
        words, starts = _words(lines if i == 0 else lines[:i] + lines[i + 1 :])
        if not words:
            continue
        yield words, True
        for k in range(max(len(words) - REMARK, (len(words) + 1) // 2), len(words)):
            if starts[k] or flat:
                yield words[:k], False


# --- which parts of a text agree ---
@lru_cache(100_000)
def _open(n: int, path: str) -> tuple[tuple[int, ...], tuple[tuple[int, ...], ...]]:
    """The positions of a text of n words that may differ after the choices of path, and their parts."""
    at: tuple[int, ...] = tuple(range(n))
    for step in path.split("/")[1:]:
        parts = _parted(at)
        at = tuple(p for k in map(int, step.split(",")) for p in parts[k])
    return at, _parted(at)


def _parted(at: tuple[int, ...]) -> tuple[tuple[int, ...], ...]:
    k = min(PARTS, len(at))
    ends = [len(at) * i // k for i in range(k + 1)] if k else [0]
    return tuple(at[a:b] for a, b in zip(ends, ends[1:], strict=False))


def narrower(words: list[str], path: str) -> list[tuple[str, int, bool]]:
    """(path, key, proof): for every choice of parts that may differ, the hash of all other words.

    Texts of one length that differ in at most allowed(n) words have a key of each step in
    common. proof: no more positions are open than may differ, so texts of the key are the same.
    """
    n, most = len(words), allowed(len(words))
    if not most:
        return []
    _, parts = _open(n, path)
    out = []
    for free in combinations(range(len(parts)), min(most, len(parts))):
        step = f"{path}/{','.join(map(str, free))}"
        open_ = {p for k in free for p in parts[k]}
        key = xxhash.xxh64_intdigest(f"{n} {step} " + " ".join(w for i, w in enumerate(words) if i not in open_)) - 2**63
        out.append((step, key, len(open_) <= most))
    return out


# --- Spark ---
_FORMS = "rid string, words string, whole boolean, first boolean"
_KEYS = "w string, whole boolean, path string, key long, proof boolean"


def _all_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"rid": pa.string(), "words": pa.string(), "whole": pa.bool_(), "first": pa.bool_()}
    batch = lambda rows: pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)] if rows else [pa.array([], k) for k in kinds.values()], list(kinds))
    for b in batches:
        rows, size = [], 0
        for rid, text in zip(b.column("rid").to_pylist(), unify_arrow(b.column("raw"))[0].to_pylist(), strict=True):
            for i, (words, whole) in enumerate(forms(text)):
                rows.append((rid, " ".join(words), whole, i == 0))
                size += len(rows[-1][1])
                if size > 20_000_000:  # the forms of very long texts don't wait for each other
                    yield batch(rows)
                    rows, size = [], 0
        yield batch(rows)


def _all_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at, path, key, proof = [], [], [], []
        for i, (words, p) in enumerate(zip(b.column("words").to_pylist(), b.column("path").to_pylist(), strict=True)):
            for x, k, sure in narrower(words.split(), p):
                at.append(i)
                path.append(x)
                key.append(k)
                proof.append(sure)
        own = b.select(["w", "whole"]).take(pa.array(at, pa.int64()))
        yield pa.record_batch([own.column("w"), own.column("whole"), pa.array(path, pa.string()), pa.array(key, pa.int64()), pa.array(proof, pa.bool_())], ["w", "whole", "path", "key", "proof"])


def same_texts(texts: DataFrame, most: int = PAIRS) -> DataFrame:
    """(a, b): links between the texts (w, words, whole) that are the same; b may be a key that stands for all its texts.

    Every two texts that are the same meet in a key. Those of a key that few texts have are
    compared in pairs, `most` / 2 a text at most; those of another are cut further until few
    are left or the key itself proves that they are the same, so no key makes more links than
    it has texts. Of two texts one must be whole.
    """
    todo, links = texts.withColumn("path", F.lit("")), None
    while True:
        keys = settle(todo.select("w", "words", "whole", "path").mapInArrow(_all_keys, _KEYS))
        use = keys.groupBy("key").agg(F.count("*").alias("n"), F.max("whole").alias("any")).filter((F.col("n") > 1) & F.col("any")).drop("any")
        shared = settle(keys.join(use, "key"))
        star = shared.filter("proof").select(F.col("w").alias("a"), F.concat(F.lit("k:"), F.col("key").cast("string")).alias("b"))
        few = shared.filter(~F.col("proof") & (F.col("n") <= most))
        one, other = (few.select("key", F.col("w").alias(x), F.col("whole").alias(f"whole_{x}")) for x in "ab")
        pairs = one.join(other, "key").filter((F.col("a") < F.col("b")) & (F.col("whole_a") | F.col("whole_b"))).select("a", "b").distinct()
        words = lambda x: texts.select(F.col("w").alias(x), F.split("words", " ").alias(f"words_{x}"))
        differ = F.size(F.filter(F.zip_with("words_a", "words_b", lambda x, y: x != y), lambda z: z))
        room = F.least(F.lit(CHANGED), F.floor(F.size("words_a") / SHARE))
        good = pairs.join(words("a"), "a").join(words("b"), "b").filter((F.size("words_a") == F.size("words_b")) & (differ <= room)).select("a", "b")
        found = settle(star.unionByName(good))
        links = found if links is None else links.unionByName(found)
        hot = shared.filter(~F.col("proof") & (F.col("n") > most)).select("w", "path").distinct()
        if hot.isEmpty():
            return links
        todo = hot.join(texts, "w")


def group_records(records: DataFrame, key: str, entity: Column, text: Column, most: int = PAIRS) -> DataFrame:
    """(key, root, entity): for every record its group, named by one of its nodes, and its own entity.

    A record without entity or text is grouped by the other; one without both is alone. A text
    without any word besides its label says nothing. Texts of fewer than SHARE words are the
    same only if all words are.
    """
    base = records.select(F.col(f"`{key}`").alias("key"), entity.alias("entity"), text.alias("raw"))
    raws = settle(base.select("raw").filter(F.col("raw").isNotNull()).distinct().withColumn("rid", F.md5("raw")))
    form = settle(raws.select("rid", "raw").mapInArrow(_all_forms, _FORMS).withColumn("w", F.md5("words")))
    first = form.filter("first").select("rid", F.col("w").alias("t"))
    owners = settle(form.join(first, "rid").select("t", "w", "whole").distinct())
    texts = settle(form.groupBy("w").agg(F.first("words").alias("words"), F.max("whole").alias("whole")))
    links = same_texts(texts, most)
    linked = links.select(F.explode(F.array("a", "b")).alias("w"))
    both = owners.groupBy("w").agg(F.count_distinct("t").alias("n"), F.max("whole").alias("whole")).filter((F.col("n") > 1) & F.col("whole")).select("w")
    own = owners.filter("t <> w").join(linked.unionByName(both).distinct(), "w", "left_semi").select(F.col("t").alias("a"), F.col("w").alias("b"))
    named = base.join(raws, "raw", "left").join(first, "rid", "left")
    node = named.select("key", "entity", F.concat(F.lit("e:"), "entity").alias("e"), F.col("t"))
    node = settle(node.withColumn("self", F.coalesce("e", "t", F.concat(F.lit("r:"), F.col("key").cast("string")))))
    root = components(node.select(F.col("self").alias("a"), F.coalesce("t", "self").alias("b")).distinct().unionByName(links).unionByName(own))
    return node.join(root.withColumnRenamed("node", "self"), "self").select("key", "root", "entity")


def labelled_groups(labels: DataFrame, figures: DataFrame) -> DataFrame:
    """(label_id, root, paper, label) of the labels with a candidate_id, by their figure's paper and caption."""
    who = figures.groupBy("candidate_id").agg(F.min(paper(F.col("arxiv_id"))).alias("paper"), F.min("caption_text").alias("caption"))
    rec = settle(labels.filter(F.col("candidate_id").isNotNull()).select("label_id", "candidate_id", "label").join(who, "candidate_id", "left"))
    groups = group_records(rec, "label_id", F.col("paper"), F.col("caption")).withColumnRenamed("key", "label_id").withColumnRenamed("entity", "paper")
    return groups.join(rec.select("label_id", "label"), "label_id")


def spanning_groups(labels: DataFrame, figures: DataFrame) -> DataFrame:
    """(label_id, group_paper): the records whose group spans more than one paper."""
    g = settle(labelled_groups(labels, figures))
    wide = g.groupBy("root").agg(F.min("paper").alias("group_paper"), F.max("paper").alias("last")).filter("group_paper <> last")
    return g.join(wide, "root").select("label_id", "group_paper")


BUCKETS = 4096
SPLITS = (("train", 0.8), ("validation", 0.1), ("test", 0.1))


def assign_splits(groups: DataFrame, splits: tuple[tuple[str, float], ...] = SPLITS) -> DataFrame:
    """groups (root, label, ...) with their split: whole groups, near the shares, both labels in each.

    Groups that hold more than a quarter of the smallest share are few; the largest first,
    each goes where most is missing. The others follow by the hash of their root: counted in
    BUCKETS ranges of the hash, the ranges fill up one split after the other. If a split lacks
    a label that occurs, a range that holds it is moved there.
    """
    least = min(s for _, s in splits)
    sizes = settle(groups.groupBy("root").agg(F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    big = sizes.filter(F.col("n") > least / 4 * total).select("root", "n", "pos", "neg").collect()  # 4 / least groups at most
    bucket = F.pmod(F.xxhash64("root", F.lit(7)), F.lit(BUCKETS)).cast("int")
    small = sizes.filter(F.col("n") <= least / 4 * total).groupBy(bucket.alias("b")).agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()
    missing = {s: share * total for s, share in splits}
    held = {s: [0, 0] for s, _ in splits}
    of_big, of_small = {}, {}

    def put(x, s: str, where: dict, k) -> None:
        missing[s] -= x["n"]
        held[s][0] += x["pos"]
        held[s][1] += x["neg"]
        where[k] = s

    for x in sorted(big, key=lambda x: (-x["n"], x["root"])):
        put(x, max(missing, key=missing.get), of_big, x["root"])
    for x in sorted(small, key=lambda x: x["b"]):
        put(x, next((s for s, _ in splits if missing[s] >= x["n"] / 2), max(missing, key=missing.get)), of_small, x["b"])
    for i, name in enumerate(("pos", "neg")):
        for s, _ in splits:
            if not held[s][i]:
                donors = [x for x in small if x[name] and held[of_small[x["b"]]][i] > x[name]]
                if donors:
                    x = min(donors, key=lambda x: (x["n"], x["b"]))
                    old = of_small[x["b"]]
                    missing[old] += x["n"]
                    held[old][0] -= x["pos"]
                    held[old][1] -= x["neg"]
                    put(x, s, of_small, x["b"])
    spark = groups.sparkSession
    last = max(splits, key=lambda x: x[1])[0]
    table = spark.createDataFrame([(k, s) for k, s in of_small.items()], "b int, s string")
    large = spark.createDataFrame([(k, s) for k, s in of_big.items()], "root string, l string")
    return groups.withColumn("b", bucket).join(F.broadcast(table), "b", "left").join(F.broadcast(large), "root", "left").withColumn("split", F.coalesce("l", "s", F.lit(last))).drop("b", "s", "l")
