"""Text predicates and metrics as Column expressions; NULL text counts as empty unless said otherwise."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import lexicons as L

#: What counts as white space, spelled out so that every regex engine agrees on it.
SPACE = r"\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: And what a word is made of.
WORD = r"\p{L}\p{N}_"


def spaced(pattern: str) -> str:
    r"""The pattern with every \s standing for all white space."""
    return pattern.replace(r"\s", f"[{SPACE}]")


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def contains_any(c: Column, terms: list[str]) -> Column:
    """Whether any of the terms is a substring.

    One lambda over a literal list keeps plans small where many lists are used, and is as fast
    as its terms unrolled (0.45 us a term and text of 600 characters; one alternation takes four
    times that). c should be a plain column, as it is looked at once for each term.
    """
    return F.exists(F.array(*map(F.lit, terms)), lambda t: F.contains(text(c), t)) if terms else F.lit(False)


def count_terms(c: Column, terms: list[str]) -> Column:
    """How many of the terms occur, not how often."""
    return F.size(F.filter(F.array(*map(F.lit, terms)), lambda t: F.contains(text(c), t))) if terms else F.lit(0)


def count_terms_in(texts: tuple[Column, ...], terms: list[str]) -> Column:
    """How many of the terms occur in any of the texts."""
    return F.size(F.filter(F.array(*map(F.lit, terms)), lambda t: reduce(lambda a, b: a | b, [F.contains(text(c), t) for c in texts]))) if terms else F.lit(0)


def tokens(c: Column) -> Column:
    """What stands between white space; no empty tokens."""
    return F.filter(F.split(text(c), f"[{SPACE}]+"), lambda t: t != "")


def ratio_over(part: Column, whole: Column, limit: float) -> Column:
    return F.when(whole > 0, part / whole > F.lit(float(limit))).otherwise(F.lit(False))


def numeric_dense(c: Column, least: int = 5, share: float = 0.15) -> Column:
    """At least so many tokens of which more than the share are numbers, but for .,()[] around them."""
    t = tokens(c)
    n = F.size(t)
    hits = F.size(F.filter(t, lambda x: F.regexp_replace(x, r"^[.,()\[\]]+|[.,()\[\]]+$", "").rlike(r"^-?[0-9]+(\.[0-9]+)?(e-?[0-9]+)?$")))
    return (n >= least) & ratio_over(hits, n, share)


def prose_dense(c: Column, least: int = 10, share: float = 0.25, words: list[str] | None = None) -> Column:
    """At least so many tokens of which more than the share are stop words."""
    t = tokens(c)
    n = F.size(t)
    return (n >= least) & ratio_over(F.size(F.filter(t, lambda x: F.lower(x).isin(words or L.STOP_WORDS))), n, share)


def symbol_hits(c: Column, symbols: str = L.MATH_SYMBOLS) -> Column:
    return F.length(text(c)) - F.length(F.translate(text(c), symbols, ""))


def math_dense(c: Column, edge: int = 50, most: int = 2, share: float = 0.05, symbols: str = L.MATH_SYMBOLS) -> Column:
    """In a short text more than `most` mathematical symbols, in a longer one more than the share of all characters."""
    n, hits = F.length(text(c)), symbol_hits(c, symbols)
    return F.when(n < edge, hits > most).otherwise(ratio_over(hits, n, share))


def whole_word(pattern: str, ignore_case: bool = False) -> str:
    """A regex for the pattern with no word character on either side."""
    return f"{'(?i)' if ignore_case else ''}(?:^|[^{WORD}])(?:{pattern})(?:$|[^{WORD}])"


#: The first three keep their case, the others do not.
STRICT_GATES = [
    (whole_word("CNOT")), (whole_word("SWAP")), (whole_word("Measure", True)), (whole_word("Toffoli", True)), (whole_word("[HXYZ]", True)),
    (whole_word("R[xyz]", True)), r"\|0⟩", r"\|1⟩", r"\|\+⟩",
]


def strict_gates(c: Column, patterns: list[str] = STRICT_GATES) -> Column:
    """How many of the gate patterns occur."""
    return reduce(lambda a, b: a + b, [text(c).rlike(p).cast("int") for p in patterns], F.lit(0))


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode NFKC, which the engine has no built-in for; NULL stays NULL."""
    return texts.map(lambda t: None if t is None else t if t.isascii() else unicodedata.normalize("NFKC", t))


#: Runs of letters that have case, and what is between them.
RUNS = r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"


def title_case(low: Column) -> Column:
    """A lower-case text with every run of letters capitalised, as in Multi-Qubit 3D; NULL stays NULL."""
    runs = F.regexp_extract_all(low, F.lit(f"({RUNS})"))
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, F.lit(2), F.length(x)))), "")


#: Characters that do not print, without the plain space.
UNPRINTABLE = r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LEADERS = rf"(?:[.\-_][{SPACE}]*){{3,}}"


def clean_text(c: Column, normalize: bool = True, spelling: dict[str, str] | None = None, breaks_to_space: bool = False) -> Column:
    """Mathematical characters spelled out, leader lines and unprintable characters removed, blanks collapsed.

    NULL comes out empty. By default line breaks are unprintable too and vanish, joining the
    words on both sides; with breaks_to_space they become blanks first.
    """
    t = text(c)
    if normalize:
        t = nfkc(t)
    if breaks_to_space:
        t = F.regexp_replace(t, r"[\t-\r]", " ")
    for a, b in (spelling or L.MATH_SPELLING).items():
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.regexp_replace(t, LEADERS, " ")
    t = F.regexp_replace(t, UNPRINTABLE, "")
    return F.trim(F.regexp_replace(t, " +", " "))
