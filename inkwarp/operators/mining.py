"""Gates, problem, descriptions and file name of an accepted figure."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicons as L
from ..functions import text as T


def letter_gates(up: Column, letters: dict[str, str] = L.LETTER_GATES) -> Column:
    """Names of the single-letter gates that stand by themselves inside a figure, its text in upper case."""
    left, right = rf"(?:^|[{T.SPACE}(\[\].,])", rf"(?:$|[{T.SPACE})\].,])"
    return F.array_compact(F.array(*(F.when(up.rlike(left + c + right), F.lit(name)) for c, name in letters.items())))


def name_pattern(name: str) -> str:
    """A name in lower case as a whole: word boundaries at its ends, blanks or hyphens between its words."""
    low = name.lower()
    body = f"[{T.SPACE}\\-]*".join(re.escape(w).replace(r"\-", "-") for w in low.split(" "))
    # A boundary lies between a word character and another one: beside a sign it asks for a word character.
    word = lambda c: c.isalnum() or c == "_"
    left = f"(?:^|[^{T.WORD}])" if word(low[0]) else f"[{T.WORD}]"
    right = f"(?:$|[^{T.WORD}])" if word(low[-1]) else f"[{T.WORD}]"
    return f"{left}{body}{right}"


def named_gates(low: Column, names: list[str] = L.GATE_NAMES) -> Column:
    """The gate and component names that occur in a lower-case text, each as a literal pattern compiled once."""
    # A plain search for the first word spares most texts the pattern.
    return F.array_compact(F.array(*(F.when(F.contains(low, F.lit(n.lower().split(" ")[0])) & low.rlike(name_pattern(n)), F.lit(n)) for n in names)))


def state_symbols(t: Column) -> Column:
    return F.array_compact(F.array(F.when(t.rlike(rf"\|[01][{T.SPACE}]*>"), F.lit("Basis State")), F.when(t.rlike(rf"\|[+\-][{T.SPACE}]*>"), F.lit("Superposition State"))))


def with_gates(df: DataFrame, inside: Column, blob: Column, name: str = "gates") -> DataFrame:
    """df with all gates of a figure in column `name`: distinct, sorted by code point. NULL texts count as empty."""
    # Brought to their case once, in a step of its own, as some 65 patterns look at them.
    cased = df.withColumns({"_in": T.text(inside), "_up": F.upper(T.text(inside)), "_low": F.lower(T.text(blob))})
    found = F.array_union(F.array_union(letter_gates(F.col("_up")), named_gates(F.col("_low"))), state_symbols(F.col("_in")))
    return cased.withColumn(name, F.sort_array(found)).drop("_in", "_up", "_low")


def known_problem(low: Column, names: list[str] = L.PROBLEM_NAMES) -> Column:
    """The longest listed problem that a lower-case text contains as a substring; of the same length the first listed; NULL if none."""
    chain = None
    for n in sorted(names, key=len, reverse=True):
        hit = F.contains(low, F.lit(n.lower()))
        chain = F.when(hit, n) if chain is None else chain.when(hit, n)
    return chain if chain is not None else F.lit(None).cast("string")


AIM = rf"(?:{'|'.join(L.PROBLEM_HEADS)})[{T.SPACE}]+for[{T.SPACE}]+((?:[{T.WORD}\-]+[{T.SPACE}]?){{1,4}})"
BEFORE = rf"([{T.WORD}{T.SPACE}]+) problem"


def with_problem(df: DataFrame, text: Column, title: Column, name: str = "problem") -> DataFrame:
    """df with, in column `name`, a listed problem; else what a circuit or scheme is said to be for; else the words before 'problem'; else Unknown."""
    low = df.withColumn("_both", F.lower(F.concat_ws(" ", T.text(title), T.text(text))))
    return low.withColumn(name, problem_of(F.col("_both"))).drop("_both")


def problem_of(both: Column) -> Column:
    """The problem that title and text, in lower case, are about; see with_problem."""
    aim = F.regexp_replace(F.regexp_extract(both, AIM, 1), rf"[{T.SPACE}]+$", "")
    group = F.when(F.contains(both, F.lit(" problem")), F.regexp_extract(both, BEFORE, 1)).otherwise(F.lit(""))
    before = F.regexp_replace(group, rf"^[{T.SPACE}]+|[{T.SPACE}]+$", "")
    return F.coalesce(
        known_problem(both),
        F.when((aim != "") & ~aim.isin(L.PROBLEM_JUNK), T.title_case(aim)),
        F.when((group != "") & (F.length(group) < 30), F.concat(T.title_case(before), F.lit(" Problem"))),
        F.lit("Unknown"),
    )


def file_name(arxiv_id: Column, page: Column, idx: Column) -> Column:
    return F.format_string("quantph_%s_p%d_f%d.png", F.replace(arxiv_id, F.lit("/"), F.lit("")), page, idx)


def model_text(caption: Column, context: Column) -> Column:
    """What a text model is given: caption and context in one line."""
    return F.replace(F.concat_ws(" ", T.text(caption), T.text(context)), F.lit("\n"), F.lit(" "))


def descriptions(caption: Column, context: Column) -> Column:
    """The cleaned caption and context, each unless empty."""
    return F.array_compact(F.array(F.when(caption != "", caption), F.when(context != "", F.concat(F.lit("Context: "), context))))


def mine(figures: DataFrame, title: Column | None = None) -> DataFrame:
    """The mined record of each figure.

    figures: arxiv_id, page_num, figure_idx, caption_text, figure_content_text,
    referencing_context, caption_span, context_span; NULL texts count as empty. Texts are
    cleaned; descriptions and text_positions run in parallel, positions pointing into the raw
    page text.
    """
    c, i, x = (T.clean_text(F.col(n)) for n in ("caption_text", "figure_content_text", "referencing_context"))
    base = (
        figures.select("arxiv_id", "page_num", "figure_idx", "caption_span", "context_span", (title if title is not None else F.lit("")).alias("_t"), c.alias("_c"), i.alias("_i"), x.alias("_x"))
        .withColumn("_all", F.concat_ws(" ", "_c", "_i", "_x"))
    )
    has_c, has_x = F.col("_c") != "", F.col("_x") != ""  # spans run beside the descriptions
    named = with_problem(with_gates(base, F.col("_i"), F.col("_all"), "_gates"), F.col("_all"), F.col("_t"), "_problem")
    return named.select(
        file_name(F.col("arxiv_id"), F.col("page_num"), F.col("figure_idx")).alias("filename"),
        F.col("arxiv_id").alias("arxiv_number"), F.col("page_num").alias("page_number"), (F.col("figure_idx") + 1).alias("figure_number"),
        F.col("_gates").alias("quantum_gates"), F.col("_problem").alias("quantum_problem"),
        descriptions(F.col("_c"), F.col("_x")).alias("descriptions"),
        F.array_compact(F.array(F.when(has_c, F.col("caption_span")), F.when(has_x, F.col("context_span")))).alias("text_positions"),
    )


def upsert(records: DataFrame, newer: DataFrame, order: list[str], key: str = "filename") -> DataFrame:
    """records with those of newer in place of the ones of the same key; the last write wins.

    Of rows of newer that repeat a key the one that is last by the columns `order` is kept, NULL
    coming first. Rows without a key are dropped from newer.
    """
    last = F.max_by(F.struct(*(F.col(f"`{c}`") for c in newer.columns)), F.struct(*order)).alias("_last")
    fresh = newer.filter(F.col(key).isNotNull()).groupBy(key).agg(last).select("_last.*")
    return records.join(fresh.select(key), key, "left_anti").unionByName(fresh)
