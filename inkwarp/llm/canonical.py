"""P1: free-entered values mapped to the entry of a reference list that they mean.

A prefix-filter set-similarity join. The distinct values are brought to plain words, words
that decorate many different entries ("... protocol", "the ...") are learned from the values
themselves and taken off, turned ("Estimation, Phase") and shortened ("Estim.") forms are
written out. Of every form the character pairs are ordered by global rarity; only the
rarest, the prefix that a pair of forms of the wanted similarity must share, are joined,
under the length and positional filters. The Jaccard similarity of what is left is computed
exactly, an edit distance checks it, and the best entry is kept.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .glyphs import unify_list

SIMILARITY = 0.25
SPARE = 2  # words that a core may have beyond the longest entry, as a misspelling may part words
AFFIX_ENTRIES = 3


def plain_words(text: str) -> str:
    """Words in lower case without accents or marks, a shortened word with its point."""
    flat = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()
    return " ".join(re.findall(r"[^\W_]{2,}\.(?=\s|$)(?!$)|[^\W_]{2,}\.$|[^\W_]+", flat))


def _forms(values: pd.Series) -> pd.Series:
    """Of each value: its words, and turned round where it reads 'B of A' or 'B, A'."""
    out = []
    for raw, text in zip(values, unify_list(list(values)), strict=True):
        if raw is None:
            out.append([])
            continue
        found = [plain_words(text)]
        if m := re.fullmatch(r"\W*(.+?)(?:\s*,\s*|\s+of\s+)(.+?)\W*", text, re.I | re.S):
            found.append(plain_words(f"{m[2]} {m[1]}"))
        if found[0].endswith("."):
            found.append(found[0][:-1])
        out.append(list(dict.fromkeys(x for x in found if x)))
    return pd.Series(out)


def osa(a: str, b: str, most: int) -> int:
    """Edits, a swap of neighbours being one, between a and b; most + 1 if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    prior: list[int] = []
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, prior[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        prior, last = last, row
    return last[-1]


def allowed(n: int) -> int:
    """Edits that a misspelling of a name of n letters may have."""
    return 0 if n < 5 else 1 if n < 6 else 2 if n < 16 else 3


def _edits(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series([osa(x, y, allowed(len(y))) for x, y in zip(a, b, strict=True)], dtype="int64")


def _tokens(form: Column) -> Column:
    """The distinct pairs of neighbouring characters, ends marked, spaces left out."""
    s = F.concat(F.lit("^"), F.replace(form, F.lit(" "), F.lit("")), F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda i: F.substring(s, i, 2)))


def _prefixes(sets: DataFrame, t: float) -> DataFrame:
    """side, kind, form, size, tok, pos for the prefix of each form's tokens in order of rarity."""
    flat = sets.select("side", "kind", "form", F.explode("toks").alias("tok"))
    rarity = flat.groupBy("tok").agg(F.count("*").alias("freq"))
    ranked = flat.join(rarity, "tok").groupBy("side", "kind", "form").agg(F.array_sort(F.collect_list(F.struct("freq", "tok"))).alias("r"))
    size = F.size("r")
    return ranked.select("side", "kind", "form", size.alias("size"), F.posexplode(F.slice("r", 1, size - F.ceil(F.lit(t) * size - 1e-9).cast("int") + 1)).alias("pos", "x")).select(
        "side", "kind", "form", "size", "pos", F.col("x.tok").alias("tok")
    )


def similar_forms(left: DataFrame, right: DataFrame, t: float = SIMILARITY) -> DataFrame:
    """(kind, l, r, jaccard) of the distinct forms (kind, form) whose token sets are as similar as t."""
    sets = (
        left.select(F.lit("l").alias("side"), "kind", "form").unionByName(right.select(F.lit("r").alias("side"), "kind", "form"))
        .filter(F.col("form") != "").distinct().withColumn("toks", _tokens(F.col("form")))
    )
    sets = settle(sets)
    p = settle(_prefixes(sets, t))
    a, b = (p.filter(F.col("side") == s).select("kind", "tok", F.col("form").alias(s), F.col("size").alias(f"n{s}"), F.col("pos").alias(f"i{s}")) for s in "lr")
    n = F.col("nl") + F.col("nr")
    pairs = (
        a.join(b, ["kind", "tok"]).filter((F.col("nr") >= t * F.col("nl") - 1e-9) & (F.col("nl") >= t * F.col("nr") - 1e-9))
        # The first shared prefix token leaves room for so many more; a later one only repeats the pair.
        .groupBy("kind", "l", "r", "nl", "nr").agg(F.min(F.struct("il", "ir")).alias("at"), F.count("*").alias("c"))
        .filter(F.least(F.col("nl") - F.col("at.il"), F.col("nr") - F.col("at.ir")) >= F.ceil(t / (1 + t) * n - 1e-9))
    )
    ts = [sets.filter(F.col("side") == s).select("kind", F.col("form").alias(s), F.col("toks").alias(f"t{s}")) for s in "lr"]
    both = F.size(F.array_intersect("tl", "tr"))
    return pairs.join(ts[0], ["kind", "l"]).join(ts[1], ["kind", "r"]).withColumn("jaccard", both / (F.col("nl") + F.col("nr") - both)).filter(F.col("jaccard") >= t).select("kind", "l", "r", "jaccard")


_WINDOW = "kind string, vid string, fid long, at int, size int, affix long, plain boolean, form string"


def _windows(forms: DataFrame, longest: int) -> DataFrame:
    """kind, vid, fid, at, size, affix, plain, form: every run of at most so many words of a form as its core, and the form itself.

    affix is the hash of what stands before and after the core, plain whether that is nothing.
    Hashes go on word by word from both ends, so the work grows with the words of a form, not their square.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.string()), ("vid", pa.string()), ("fid", pa.int64()), ("at", pa.int32()), ("size", pa.int32()), ("affix", pa.int64()), ("plain", pa.bool_()), ("form", pa.string())])
        for b in batches:
            rows: list[tuple] = []
            for kind, vid, fid, form in zip(*(b.column(c).to_pylist() for c in ("kind", "vid", "fid", "form")), strict=True):
                words = form.split(" ")
                n = len(words)
                ends = []
                for side in (words, words[::-1]):
                    h = [0]
                    for w in side:
                        h.append(xxhash.xxh64_intdigest(w, seed=h[-1]))
                    ends.append(h)
                for i in range(n):
                    for k in range(1, min(longest, n - i) + 1):
                        rows.append((kind, vid, fid, i + 1, k, xxhash.xxh64_intdigest(f"{ends[0][i]},{ends[1][n - i - k]}") - 2**63, k == n, " ".join(words[i : i + k])))
                    if len(rows) > 100_000:
                        yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows = []
                if n > longest:  # it can't be an entry, but is its own core
                    rows.append((kind, vid, fid, 1, n, 0, True, form))
            if rows:
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return forms.select("kind", "vid", "fid", "form").mapInArrow(run, _WINDOW)


def map_to_reference(values: DataFrame, reference: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(kind, value, ref_id, edits, jaccard) for each distinct (kind, value); ref_id -1: it means no entry.

    reference: ref_id, kind, term, aliases; NULL or empty aliases add nothing. NULL and blank
    values give no row. Words are taken off a value if what stands around its core decorates
    AFFIX_ENTRIES entries at least, or, if nothing else fits, if the core is exactly an entry and
    none of the others is a word of any. Where two entries fit equally well, the one reached without taking words
    off, then the smaller ref_id is taken. With an empty reference every value is -1.
    """
    forms = F.pandas_udf(_forms, "array<string>")
    distinct = settle(values.select("kind", "value").filter(F.col("value").isNotNull() & F.col("value").rlike(r"[^\s\p{Z}]")).distinct().withColumn("vid", F.md5("value")))
    mine = settle(distinct.select("kind", "vid", F.explode(forms("value")).alias("form")).withColumn("fid", F.xxhash64("form")))
    listed = settle(
        reference.select("ref_id", "kind", F.explode(F.array_union(F.array("term"), F.coalesce("aliases", F.expr("array()")))).alias("name"))
        .filter(F.col("name").isNotNull()).select("ref_id", "kind", F.explode(forms("name")).alias("form"))
        .groupBy("kind", "form").agg(F.min("ref_id").alias("ref_id")).filter(F.col("form") != "")
    )
    solid = F.replace(F.col("form"), F.lit(" "), F.lit(""))
    most, letters = listed.agg(F.max(F.size(F.split("form", " "))), F.max(F.length(solid))).first()
    longest = (most or 0) + SPARE
    split = settle(_windows(mine, longest))
    known = listed.select("kind", solid.alias("solid"), "ref_id").distinct()
    word = settle(listed.select("kind", F.explode(F.split("form", " ")).alias("word")).distinct())
    plain = F.col("plain")
    hits = settle(split.withColumn("solid", solid).join(known, ["kind", "solid"]))
    exact = hits.filter(plain).select("kind", "vid").distinct()
    inside = hits.filter(~plain).join(exact, ["kind", "vid"], "left_anti")
    affixes = inside.groupBy("kind", "affix").agg(F.count_distinct("ref_id").alias("n")).filter(F.col("n") >= AFFIX_ENTRIES).select("kind", "affix")
    # An entry among words that belong to none.
    words = F.split("whole", " ")
    rest = F.concat(F.slice(words, F.lit(1), F.col("at") - 1), F.slice(words, F.col("at") + F.col("size"), F.size(words)))
    around = inside.join(mine.withColumnRenamed("form", "whole"), ["kind", "vid", "fid"]).select("kind", "vid", "fid", "at", "size", F.explode(rest).alias("word"))
    claimed = around.join(word, ["kind", "word"], "left_semi").select("kind", "vid", "fid", "at", "size").distinct()
    free = inside.join(claimed, ["kind", "vid", "fid", "at", "size"], "left_anti")
    core = lambda df, taken: df.select("kind", "vid", "form", F.lit(taken).alias("taken"))
    cores = core(split.filter(plain), 0).unionByName(core(split.filter(~plain).join(affixes, ["kind", "affix"]), 1)).unionByName(core(free, 2))
    # A shortened word stands for every word of the reference list that begins with it.
    stems = word.select("kind", "word", F.explode(F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.length("word") - 1)), lambda k: F.substring("word", F.lit(1), k))).alias("stem")).distinct()
    short = cores.withColumn("stem", F.regexp_extract("form", r"([^\s.]+)\.", 1))
    longer = short.filter(F.col("stem") != "").join(stems, ["kind", "stem"]).withColumn("form", F.replace(F.col("form"), F.concat("stem", F.lit(".")), F.col("word")))
    cores = settle(cores.unionByName(longer.select(*cores.columns)).withColumn("form", F.replace(F.col("form"), F.lit("."), F.lit(""))).filter(F.col("form") != "").distinct())
    # No core is an entry by so few edits if it is that much longer than all.
    pairs = similar_forms(cores.filter(F.length(solid) <= (letters or 0) + allowed(letters or 0)), listed, similarity)
    bare = lambda c: F.replace(F.col(c), F.lit(" "), F.lit(""))
    checked = pairs.withColumn("edits", F.pandas_udf(_edits, "long")(bare("l"), bare("r"))).withColumn("room", F.length(bare("r")))
    # The same steps as allowed(): short names are taken only as they are.
    room = F.when(F.col("room") < 5, 0).when(F.col("room") < 6, 1).when(F.col("room") < 16, 2).otherwise(3)
    good = checked.filter(F.col("edits") <= room).join(listed.withColumnRenamed("form", "r"), ["kind", "r"])
    # Of the forms that have the same edits the longer name fits better: its edits weigh less.
    order = F.struct((F.col("taken") == 2).alias("last"), (F.col("edits") / F.greatest(F.length(bare("r")), F.lit(1))).alias("share"), "taken", (-F.col("jaccard")).alias("far"), "ref_id", "edits")
    best = cores.withColumnRenamed("form", "l").join(good, ["kind", "l"]).groupBy("kind", "vid").agg(F.min(order).alias("best"))
    return distinct.join(best, ["kind", "vid"], "left").select(
        "kind", "value", F.coalesce("best.ref_id", F.lit(-1)).cast("int").alias("ref_id"), F.col("best.edits").alias("edits"), (-F.col("best.far")).alias("jaccard")
    )


def record_values(records: DataFrame) -> DataFrame:
    """(record_id, slot, kind, value): slot 0 the problem, slot k the k-th gate, NULL ones counted in k."""
    gates = records.select("record_id", F.posexplode("quantum_gates").alias("i", "value")).select("record_id", (F.col("i") + 1).alias("slot"), F.lit("gate").alias("kind"), "value")
    return records.select("record_id", F.lit(0).alias("slot"), F.lit("problem").alias("kind"), F.col("quantum_problem").alias("value")).unionByName(gates)


def entered_values(records: DataFrame, reference: DataFrame) -> DataFrame:
    """The values to map: not NULL, blank, exactly Unknown, or exactly a term of their kind."""
    filled = record_values(records).filter(F.col("value").isNotNull() & F.col("value").rlike(r"[^\s\p{Z}]") & (F.col("value") != "Unknown"))
    return filled.join(reference.select("kind", F.col("term").alias("value")).distinct(), ["kind", "value"], "left_anti")


def map_records(records: DataFrame, reference: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(record_id, slot, kind, value, ref_id, edits, jaccard) of every value that is not yet a term.

    A frequent value may hold a third of all rows; the map is joined as a whole, and the
    engine splits such a value's rows between tasks.
    """
    todo = entered_values(records, reference)
    mapped = settle(map_to_reference(todo, reference, similarity))
    return todo.join(mapped, ["kind", "value"]).select("record_id", "slot", "kind", "value", "ref_id", "edits", "jaccard")


def unmatched(records: DataFrame, reference: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(kind, value, uses): the values that mean no entry, the most used first by count."""
    return map_records(records, reference, similarity).filter("ref_id = -1").groupBy("kind", "value").agg(F.count("*").alias("uses"))
