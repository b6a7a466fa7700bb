"""P4: text of scanned pages repaired into continuous readable paragraphs.

Skip-gram vectors are learned from the co-occurrence counts of the whole corpus. Rare words
are linked to frequent ones that a plausible glyph edit away, and of these and the word as written
the one that its neighbours in the text predict best is taken. Running headers, known by their place
at the top of a paper's pages, and printed page numbers are removed wherever they stand;
words cut at line ends are joined where the joined word is one that the corpus uses; the
rest is reflowed.

Bounds: the vocabulary that goes to every worker holds all words if they are at most WORDS,
else those that are at least a share COMMON of all tokens, so at most 1 / COMMON of them; what
a text needs of the others is then joined to it. Every known word has a vector: they are learned
on the driver where the counts are at most CELLS, else by the same steps over the workers.
Header forms are joined by paper.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import paper, settle, small_side
from .glyphs import unify_arrow

WORDS = 500_000  # that may be broadcast
COMMON = 2e-6  # share of tokens from which a word is broadcast if there are more
LEAST = 5  # uses from which a word is known
RATIO = 5  # times as frequent as the misread form must the word be
TOP, FOOT = 50.0, 740.0  # points from the top of the page where headers end and page numbers begin, if the blocks don't tell
FIRST = 2  # blocks of a page that may be the paper's title
WINDOW, DIMS, STEPS = 2, 16, 40
SURE, CENTER = 100, 2e-5  # uses, and share of tokens besides, from which a word's vector has half a say or more
NEGATIVE = 5.0  # negative samples a pair
LOG_RATIO, LOG_NEGATIVE = float(np.log(RATIO)), float(np.log(NEGATIVE))
CONTEXT = 5e-4  # share of tokens from which a word is a context of the vectors, so 2,000 words at most
CELLS = 20_000_000  # counts of words beside contexts, zeros too, that the driver learns from; more stay with the workers

# A glyph or two and what they are read as.
MISREAD = (
    ("m", "rn"), ("n", "ri"), ("u", "ii"), ("w", "vv"), ("d", "cl"), ("cl", "d"), ("li", "h"), ("rn", "m"), ("e", "c"), ("c", "e"), ("t", "f"), ("f", "t"),
    ("a", "o"), ("h", "b"), ("i", "l"), ("l", "1"), ("I", "l"), ("i", "1"), ("I", "1"), ("o", "0"), ("O", "0"), ("s", "5"), ("S", "5"), ("g", "9"), ("b", "6"),
    ("B", "8"), ("D", "O"), ("R", "P"), ("z", "2"), ("Z", "2"),
)
_BACK: dict[str, list[tuple[str, str]]] = {}
for _true, _read in MISREAD:
    _BACK.setdefault(_read[0], []).append((_read, _true))

# Of every letter a form that no misreading in MISREAD alters, nor case: words a misreading apart come out the same.
ALIKE = str.maketrans({
    "e": "c", "i": "l", "1": "l", "f": "t", "p": "r", "5": "s", "9": "g", "2": "z", "m": "rrl", "n": "rl", "w": "vv", "u": "ll", "h": "ll", "b": "ll", "6": "ll", "8": "ll",
    "d": "cl", "o": "cl", "a": "cl", "0": "cl",
})

WORD = re.compile(r"[^\W_]+(?:-[^\W_]+)*")
CUT = re.compile(r"(?<=[^\W_])[-¬]\s+(?=[^\W_])")
_LEFT, _RIGHT = re.compile(f"{WORD.pattern}$"), WORD
NUMBER = "<n>"


def glyph_key(word: str) -> str:
    return word.lower().translate(ALIKE)


class Lexicon:
    """The words with their counts, and the vectors of the common ones.

    A partial one holds frequent words only. What it is asked of others is taken from told, or
    noted in asked and answered with no. beside: in which share of its other uses a word stands
    left and right of a number; vectors and beside are of all words unless apart.
    """

    def __init__(self, counts: dict[str, int], total: int, vectors: tuple[dict[str, int], np.ndarray, dict[str, int], np.ndarray] | None = None, beside: tuple[dict[str, float], dict[str, float]] | None = None):
        self.counts, self.total, self.vectors, self.beside = counts, total, vectors, beside or ({}, {})
        self._links: dict[str, list[str]] = {}
        self._plain: set[str] = set()
        self._doubtful: set[str] = set()
        self._beside: dict[tuple[int, int], float] = {}
        self._keys: dict[str, list[str]] | None = None
        self.partial = self.apart = False
        self.asked: set[str] = set()
        self.told: dict[str, tuple[int, list[str]]] = {}
        self.told_counts: dict[str, int] = {}
        self.told_vectors: dict[str, list[float]] = {}
        self.told_beside: dict[str, tuple[float, float]] = {}

    def tell(self, told: list[dict]) -> None:
        """Take over what was found out for a text: form, its count n, its links and their counts sizes."""
        self.asked = set()
        self.told = {x["form"]: (x["n"], x["links"]) for x in told}
        self.told_counts = {w.lower(): n for x in told for w, n in zip([x["form"], *x["links"]], [x["n"], *x["sizes"]], strict=True)}
        if self.apart:
            self.told_vectors = {w.lower(): v for x in told for w, v in zip([x["form"], *x["links"]], [x["vector"], *x["vectors"]], strict=True) if v}
            self.told_beside = {x["form"].lower(): (x["left"] or 0.0, x["right"] or 0.0) for x in told}

    def reachable(self, word: str, least: int) -> bool:
        """Whether a word of so many uses has word's glyph key, which no misreading alters."""
        if self._keys is None:
            self._keys = {}
            for w, n in self.counts.items():
                if n >= LEAST:
                    self._keys.setdefault(glyph_key(w), []).append(w)
        low = word.lower()
        return any(w != low and self.counts[w] >= least for w in self._keys.get(glyph_key(word), ()))

    def strange(self, word: str) -> bool:
        return self.partial and word.lower() not in self.counts

    def count(self, word: str) -> int:
        w = word.lower()
        return self.counts.get(w) or self.told_counts.get(w, 0)

    def all_plain(self, pieces: list[str]) -> bool:
        """Whether no piece between blanks holds a misread word or the first half of a cut one."""
        if self._plain.issuperset(pieces):
            return True
        for x in pieces:
            if x not in self._plain:
                if x not in self._doubtful:
                    good = not (len(x) > 1 and x[-1] in "-¬") and not any(self.strange(w) or self.links(w) for w in WORD.findall(x) if not w.isdigit())
                    if len(self._plain) + len(self._doubtful) > 1_000_000:
                        self._plain.clear()
                        self._doubtful.clear()
                    (self._plain if good else self._doubtful).add(x)
                    if good:
                        continue
                return False
        return True

    def links(self, word: str, deep: int = 3) -> list[str]:
        """The known words that word may be a misreading of, by as few edits as any; none if it is good itself."""
        if self.strange(word):
            if word not in self.told:
                self.asked.add(word)
                return []
            return self.told[word][1]
        found = self._links.get(word)
        if found is None:
            own = self.counts.get(word.lower(), 0)
            found, seen, front = [], {word}, [word]
            # A letter by itself is a label, not a word that could be told from another.
            least = max(RATIO * own, LEAST)
            for _ in range(deep if len(word) > 1 and self.reachable(word, least) else 0):
                step = []
                for x in front:
                    for i, c in enumerate(x):
                        for read, true in _BACK.get(c, ()):
                            if x.startswith(read, i):
                                y = x[:i] + true + x[i + len(read) :]
                                if y not in seen:
                                    seen.add(y)
                                    step.append(y)
                # A link leads up to a word at least RATIO times as frequent that is good itself.
                found = [y for y in step if len(y) > 1 and self.counts.get(y.lower(), 0) >= least and not self.links(y)]
                if found:
                    break
                front = step
            # Of spellings that differ in case alone, the one that changes case least often comes first.
            bumps = lambda y: sum(a.isupper() != b.isupper() for a, b in zip(y[1:], y[2:], strict=False))
            found = self._links[word] = sorted(found, key=lambda y: (-self.counts[y.lower()], bumps(y), y))
        return found

    def known(self, word: str) -> bool:
        if self.strange(word):
            linked = self.links(word)
            return bool(linked) or self.told.get(word, (0,))[0] >= LEAST
        return self.counts.get(word.lower(), 0) >= LEAST or bool(self.links(word))

    def fitting(self, found: list[str], around: Iterable[str], word: str) -> str:
        """Of the links and the word as written the one that its neighbours predict best.

        A link has the odds RATIO over the word as written, which its count must exceed anyway,
        but not more however frequent it is, or no neighbours could speak for a rare word.
        """
        near = [w.lower() for w in around]
        best = max(found, key=lambda w: np.log(self.count(w)) + self.support(w, near)) if len(found) > 1 else found[0]
        return best if self.support(best, near) - self.support(word, near) + LOG_RATIO >= 0 else word

    def support(self, word: str, near: list[str]) -> float:
        """How much likelier, as a logarithm, its neighbours are beside the word than elsewhere, by the vectors.

        A vector of few uses fits their neighbours by chance, and a misreading grows frequent with
        the corpus, so a word's vector has a say by its uses and by its share of all tokens. A word of
        under LEAST uses has none: its neighbours are taken to be as elsewhere.
        """
        if not self.vectors:
            return 0.0
        rows, center, columns, context = self.vectors
        w = word.lower()
        i = rows.get(w)
        own = self.told_vectors.get(w) if i is None else None
        if i is None and own is None:
            return 0.0
        total = 0.0
        for c in near:
            j = columns.get(c)
            if j is not None:
                x = self._beside.get((i, j)) if own is None else None
                if x is None:
                    # The vectors' product tends to the pair's mutual information less the logarithm of NEGATIVE.
                    x = float((center[i] if own is None else np.array(own, np.float32)) @ context[j]) + LOG_NEGATIVE
                    if own is None:
                        self._beside[i, j] = x
                total += x
        n = self.count(w)
        return total * n / (n + SURE + CENTER * self.total)

    def rarely_beside_number(self, left: str, right: str) -> bool:
        return all(self._share(w, side) < 0.004 for side, w in enumerate((left, right)))

    def _share(self, word: str, side: int) -> float:
        if self.apart and self.strange(word):
            if word not in self.told:
                self.asked.add(word)
            return self.told_beside.get(word.lower(), (0.0, 0.0))[side]
        return self.beside[side].get(word.lower(), 0.0)


_FLAT = str.maketrans({"0": "o", "1": "l", "i": "l", "I": "l", "5": "s", "8": "b", "6": "b", "9": "g", "c": "e", "t": "f", "a": "o", "h": "b", "|": "l"})


def header_key(line: str) -> tuple[str, ...]:
    """The words of a header in a form that scan damage leaves alone; its page number is left out."""
    words = [w for w in re.findall(r"[^\W_]+", line)]
    if len(words) > 2 and words[0].isdigit():
        words = words[1:]
    elif len(words) > 2 and words[-1].isdigit() and not re.fullmatch("v[o0]l", words[-2], re.I):
        words = words[:-1]
    return tuple(flat_word(w) for w in words)


@lru_cache(200_000)
def flat_word(w: str) -> str:
    return w.lower().replace("rn", "m").replace("ri", "n").replace("ii", "u").replace("vv", "w").replace("cl", "d").replace("li", "h").replace("p", "r").translate(_FLAT)


@lru_cache(200_000)
def flat_piece(x: str) -> str:
    """The first word of what stands between blanks, flat."""
    m = re.search(r"[^\W_]+", x)
    return flat_word(m[0]) if m else ""


LEAD = 5  # words that may stand before a known header in its line, as the authors do


def matches(key: tuple[str, ...] | list[str], form: tuple[str, ...], share: float = 0.7) -> bool:
    return sum(a == b for a, b in zip(key, form, strict=True)) >= max(2, share * len(form))


def is_header(line: str, forms: set[tuple[str, ...]]) -> bool:
    """Whether a line reads like one of the paper's headers, all of it or its end after a short lead."""
    pieces = line.split()
    n = len(pieces) + line.count("-")
    near = [f for f in forms if -2 <= n - len(f) <= LEAD + 4]
    if not near:
        return False
    # Before all words are looked at: a third of the form's must begin a piece, as 0.7 must match and few follow a hyphen.
    there = set(map(flat_piece, pieces))
    if not any(3 * sum(w in there for w in f) >= len(f) for f in near):
        return False
    key = header_key(line)
    return len(key) >= 2 and any(0 <= len(key) - len(f) <= LEAD and matches(key[len(key) - len(f) :], f) for f in forms)


def page_mark(line: str, page: int | None) -> str:
    """'bare', 'marked' or '' : the way in which a line is a printed page number."""
    if page is None:
        return ""
    if len(line) > 24:
        return ""
    m = re.fullmatch(r"\s*(?:([-—–]\s*)|(p\w{2}e\s+|p\.\s*))?([\dlIoOS]+)(\s+o[ft]\s+\d+)?(\s*[-—–])?\s*", line, re.I)
    if not m or m[3].translate(str.maketrans("lIoOS", "11005")) != str(page):
        return ""
    return "marked" if m[1] and m[5] or m[2] or m[4] else "" if m[1] or m[5] else "bare"


def _header_in_line(text: str, forms: set[tuple[str, ...]]) -> list[tuple[int, int]]:
    """Where a header stands in a text whose line ends are blanks; a lead that begins like a name belongs to it."""
    there = set(map(flat_piece, text.split()))
    forms = {f for f in forms if len(f) > 1 and 2 * sum(w in there for w in f) >= len(f)}
    if not forms:
        return []
    spans: list[tuple[int, int]] = []
    words = list(re.finditer(r"[^\W_]+", text))
    flat = [flat_word(m[0]) for m in words]
    there = set(flat)
    for f in forms:
        n = len(f)
        if sum(w in there for w in f) < 0.7 * n:
            continue
        for i in range(len(flat) - n + 1):
            if words[i][0][0].isupper() and matches(flat[i : i + n], f, 0.75):
                lead = _LEAD.search(text, max(0, words[i].start() - 80), words[i].start())
                spans.append((lead.start() if lead else words[i].start(), words[i + n - 1].end()))
    spans.sort()
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_LEAD = re.compile(r"(?:(?<=\s)|^)[^\W\d_]\.(?: [^\W\d_]+\.?){1,4} [—–-] $")  # A. Name and others, and a dash
_HEADING = re.compile(r"\s*(?:\d|l|[^\W\d_a-z])")  # an I may be read as l
_FOLIO_IN = re.compile(r"(?:^|(?<=\s))(?:[-—–] (\d+) [-—–]|P\w{2}e (\d+)|p\. (\d+)|(\d+) of \d+)(?=\s|$)")


def strip_furniture(text: str, lined: bool, page: int | None, forms: set[tuple[str, ...]], y0: float | None, lex: Lexicon, drawing: bool, bands: tuple[float, float] = (TOP, FOOT)) -> tuple[str, set[str]]:
    """The text without headers and page numbers, and which of 'header' and 'folio' it had.

    y0: the top of a text block; None for a field of a figure. drawing: the labels inside a figure.
    bands: where on a page headers end and page numbers begin.
    """
    found: set[str] = set()
    number = str(page)

    def numbered(line: str) -> bool:
        x = line.strip()
        return x.startswith(number) and x[len(number) : len(number) + 2].isspace() or x.endswith(number) and x[: -len(number)][-2:].isspace()

    if lined:
        lines = text.split("\n")
        if len(lines) == 1 and y0 is not None:
            if y0 < bands[0] and re.search(r"[^\W\d_]", text):
                return "", {"header", "folio"} if numbered(text) else {"header"}
            mark = page_mark(text, page)
            return ("", {"folio"}) if mark == "marked" or mark == "bare" and y0 > bands[1] else (text, found)
        keep, after = [], False
        for i, line in enumerate(lines):
            mark = page_mark(line, page) if len(line) <= 24 and len(lines) > 1 else ""
            if mark == "bare" and drawing and not after and (len(line.strip()) < 2 and int(page or 0) < 4) and i in (0, len(lines) - 1):
                mark = ""
            if mark:
                found.add("folio")
            elif forms and line[-1:] not in ".,;:" and _HEADING.match(line) and is_header(line, forms):
                found.add("header")
                after = True
                if numbered(line):
                    found.add("folio")
                continue
            else:
                keep.append(line)
            after = False
        return "\n".join(keep), found
    cut: list[tuple[int, int]] = []
    for a, b in _header_in_line(text, forms):
        found.add("header")
        tail, front = text[b:].lstrip(), text[:a].rstrip()
        if tail.startswith(number) and not tail[len(number) : len(number) + 1].strip():
            found.add("folio")
            b = len(text) - len(tail) + len(number)
        if front.endswith(number) and not front[: -len(number)][-1:].strip():
            found.add("folio")
            a = len(front) - len(number)
        cut.append((a, b))
    if page is not None:
        for m in _FOLIO_IN.finditer(text):
            if number in m.groups():
                found.add("folio")
                cut.append(m.span())
        at = text.find(number) if number in text.split() else -1
        while at >= 0:
            end = at + len(number)
            alone = not text[at - 1 : at].strip() and not text[end : end + 1].strip()
            if alone and not any(a <= at < b for a, b in cut):
                left, right = WORD.findall(text[:at])[-1:], WORD.findall(text[end:])[:1]
                if not left or not right or lex.rarely_beside_number(left[0], right[0]):
                    found.add("folio")
                    cut.append((at, end))
            at = text.find(number, end)
    for a, b in sorted(cut, reverse=True):
        text = text[:a].rstrip(" ") + " " + text[b:].lstrip(" ")
    return text.strip(" ") if cut else text, found


def join_cuts(text: str, lex: Lexicon) -> tuple[str, bool]:
    """The text with the words that are cut at line ends joined, and whether there were any."""
    found, out, at = False, [], 0
    for m in CUT.finditer(text):
        if m.start() < at:
            continue
        left, right = _LEFT.search(text, max(at, m.start() - 60), m.start()), _RIGHT.match(text, m.end())
        if not left or not right:
            continue
        a, b = left[0], right[0]
        soft = m[0][0] == "¬"
        if lex.known(a + b):
            joint = ""
        elif soft:
            joint = "-" if lex.known(f"{a}-{b}") else ""
        else:
            joint = "-" if b.isdigit() or b[0].isupper() or lex.known(f"{a}-{b}") or lex.known(a) and lex.known(b) else ""
        found |= not joint
        out += [text[at : m.start()], joint]
        at = m.end()
    return ("".join([*out, text[at:]]) if out else text), found


def correct_words(text: str, lex: Lexicon) -> tuple[str, bool]:
    """The text with its misread words corrected, and whether there were any."""
    if lex.all_plain(text.split()):
        return text, False
    doubt = [m for m in WORD.finditer(text) if not m[0].isdigit()]
    out, at, found = [], 0, False
    done = lex._links
    for k, m in enumerate(doubt):
        links = done.get(m[0])
        if links is None:
            links = lex.links(m[0])
        if links:
            near = [x[0] for x in doubt[max(0, k - WINDOW) : k] + doubt[k + 1 : k + 1 + WINDOW]]
            best = lex.fitting(links, near, m[0])
            if best != m[0]:
                out += [text[at : m.start()], best]
                at, found = m.end(), True
    return ("".join([*out, text[at:]]), True) if found else (text, False)


def reflow(text: str, pieces: list[str] | None = None) -> str:
    """Lines joined into paragraphs; an empty line parts two. pieces: the text split at blanks, if at hand."""
    if "\n\n" not in text and "\n " not in text:
        return " ".join(text.split() if pieces is None else pieces)
    return "\n\n".join(p for p in (re.sub(r"\s+", " ", x).strip() for x in re.split(r"\n\s*\n", text)) if p)


def mend(text: str, lined: bool, page: int | None, forms: set[tuple[str, ...]], y0: float | None, lex: Lexicon, drawing: bool = False, bands: tuple[float, float] = (TOP, FOOT)) -> tuple[str, set[str]]:
    """A unified text repaired, and the kinds of damage it had."""
    text, damage = strip_furniture(text, lined, page, forms, y0, lex, drawing, bands)
    pieces = text.split()
    if lex.all_plain(pieces):  # neither a cut nor a misread word
        return reflow(text, pieces), damage
    text, cut = join_cuts(text, lex) if "-" in text or "¬" in text else (text, False)
    text, wrong = correct_words(text, lex)
    return reflow(text), damage | ({"break"} if cut else set()) | ({"misread"} if wrong else set())


# --- Spark ---

FIELDS = ("caption_text", "referencing_context", "figure_content_text")


def corpus(figures: DataFrame, blocks: DataFrame) -> DataFrame:
    """table_name, row_id, field_name, paper, page, y0, text: every field that is neither NULL nor empty."""
    part = lambda name: F.struct(F.lit(name).alias("field_name"), F.col(name).alias("text"))
    fig = figures.select(
        F.lit("figure_candidates").alias("table_name"), F.col("candidate_id").alias("row_id"), paper(F.col("arxiv_id")).alias("paper"), F.col("page_num").alias("page"),
        F.lit(None).cast("double").alias("y0"), F.explode(F.array(*map(part, FIELDS))).alias("f"),
    ).select("table_name", "row_id", "f.field_name", "paper", "page", "y0", "f.text")
    blk = blocks.select(
        F.lit("text_blocks").alias("table_name"), F.col("block_key").alias("row_id"), F.lit("text").alias("field_name"), paper(F.col("arxiv_id")).alias("paper"),
        F.col("page_num").alias("page"), F.col("bbox.y0").alias("y0"), "text",
    )
    return fig.unionByName(blk).filter(F.length("text") > 0)


def page_bands(blocks: DataFrame) -> tuple[float, float]:
    """Where on a page headers end and page numbers begin, from all blocks.

    Headers stand above the text, so above all but a thousandth of the blocks of several lines;
    page numbers stand about where half of the blocks that are their page's number do.
    """
    y0, text = F.col("bbox.y0"), F.col("text")
    top, foot = blocks.agg(
        F.percentile_approx(F.when(F.contains(text, F.lit("\n")), y0), 0.001, 10_000), F.percentile_approx(F.when(F.trim(text) == F.col("page_num").cast("string"), y0), 0.5, 10_000)
    ).first()
    return TOP if top is None else top, FOOT if foot is None else foot - 20


def header_forms(blocks: DataFrame, top: float = TOP) -> DataFrame:
    """(paper, forms): the forms of each paper's running header, from what stands at the top of its pages.

    That is what stands above the text, and what may be the title: a line of several words among
    the first blocks of a page. Of the forms those used at least a twentieth as often as the most
    frequent are kept, so a paper has twenty at most however many pages it has; damaged ones
    match them by most words.
    """
    line = blocks.select(paper(F.col("arxiv_id")).alias("paper"), F.col("bbox.y0").alias("y0"), "block_id", "text").filter(
        F.col("paper").isNotNull() & ((F.col("y0") < top) | (F.col("block_id") < FIRST)) & ~F.contains("text", F.lit("\n")) & ~F.col("text").rlike(r"^\s*[IVX]+\.\s") & F.length("text").between(9, 159)
    )
    top_ = line.filter((F.col("y0") < top) | (F.size(F.split("text", " ")) >= 3) & F.col("text").rlike(r"^[A-Z][\p{L}-]* [^.]*\b[a-z]{2,}\b.*\b[a-z]{2,}\b[^.]*$"))
    n = top_.groupBy("paper", "text").agg(F.count("*").alias("n"))
    best = n.groupBy("paper").agg(F.max("n").alias("most"))
    return n.join(best, "paper").filter(F.col("n") * 20 >= F.col("most")).groupBy("paper").agg(F.collect_list("text").alias("forms"))


def _texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return unify_arrow(batch.column(name))[0].to_pylist()


def _pieces(texts: list[str]) -> list[str]:
    """What stands between blanks, the halves of cut words left out, the texts parted by a mark."""
    all_ = " \x1e ".join(texts).split()
    cut = [i for i, x in enumerate(all_) if x[-1] in "-¬" and len(x) > 1]
    for i in cut:
        all_[i] = "\x1e"
        if i + 1 < len(all_):
            all_[i + 1] = "\x1e"
    return all_


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts in lower case; words cut at line ends are left out."""

    def words(pieces: Counter) -> Counter:
        total: Counter = Counter()
        for x, n in pieces.items():
            for w in WORD.findall(x.lower()):
                total[w] += n
        return total

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: Counter = Counter()
        for b in batches:
            pieces.update(_pieces(_texts(b)))
            if len(pieces) > 500_000:
                total = words(pieces)
                yield pa.record_batch({"word": pa.array(total.keys(), pa.string()), "n": pa.array(total.values(), pa.int64())})
                pieces.clear()
        total = words(pieces)
        yield pa.record_batch({"word": pa.array(total.keys(), pa.string()), "n": pa.array(total.values(), pa.int64())})

    return texts.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class _Ids(dict):
    """The vocabulary index of a piece: of its only word, -2 if that is in no vocabulary, NUMBER for a number, -1 for anything else."""

    def __init__(self, known: dict[str, int]):
        super().__init__()
        self.known = known

    def __missing__(self, piece: str) -> int:
        w = WORD.findall(piece.lower())
        i = -1 if len(w) != 1 else self.known.get(NUMBER, -1) if w[0].isdigit() else self.known.get(w[0], -2)
        if len(self) < 1_000_000:
            self[piece] = i
        return i


def pair_counts(texts: DataFrame, ids: dict[str, int], columns: int, others: bool = False) -> DataFrame:
    """(word, code, n): how often two words stand within WINDOW of each other.

    code is center * columns + context; below 0 it counts what stands next to a number (word 0):
    -1 - 2 * center for a center on its left, one less for a center on its right. With others,
    words without an id are centers too: word is theirs, and code what it would be for the center 0.
    """
    shared = texts.sparkSession.sparkContext.broadcast(ids)
    whole, beside = len(ids) * columns, 2 * len(ids)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Ids(shared.value)
        dense = np.zeros(whole + beside, np.int64) if whole < 8_000_000 else None
        waiting: list[np.ndarray] = []
        sums: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            pieces = _pieces(_texts(b))
            seq = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
            if others:
                fresh: dict[str, int] = {}
                for i in np.flatnonzero(seq == -2):
                    seq[i] = fresh.setdefault(WORD.findall(pieces[i].lower())[0], len(ids) + len(fresh))
            codes: list[np.ndarray] = []
            for o in range(1, WINDOW + 1):
                for side, (x, y) in enumerate(((seq[:-o], seq[o:]), (seq[o:], seq[:-o]))):
                    ok = (x >= 0) & (y >= 0) & (y < columns)
                    codes.append(x[ok] * columns + y[ok])
                    if o == 1:
                        codes.append(-1 - 2 * x[(x >= 0) & (y == 0)] - side)
            if others:
                code = np.concatenate(codes)
                own = (code >= -beside) & (code < whole)
                codes = [code[own]]
                code, n = np.unique(code[~own], return_counts=True)
                center = np.where(code < 0, (-1 - code) // 2, code // columns)
                names = np.array(list(fresh), object)[center - len(ids)]
                code = np.where(code < 0, code + 2 * center, code - center * columns)
                yield pa.record_batch({"word": pa.array(names, pa.string()), "code": pa.array(code, pa.int64()), "n": pa.array(n, pa.int64())})
            if dense is not None:
                waiting += codes
            else:
                sums.append(np.unique(np.concatenate(codes), return_counts=True))
            if len(sums) > 32:
                sums = [_merged(sums)]
            if dense is not None and sum(map(len, waiting)) > 5_000_000:
                dense += np.bincount(np.concatenate(waiting) + beside, minlength=whole + beside)
                waiting.clear()
        if dense is not None:
            if waiting:
                dense += np.bincount(np.concatenate(waiting) + beside, minlength=whole + beside)
            at = np.flatnonzero(dense)
            sums = [(at - beside, dense[at])]
        if sums:
            code, n = _merged(sums)
            yield pa.record_batch({"word": pa.nulls(len(code), pa.string()), "code": pa.array(code, pa.int64()), "n": pa.array(n, pa.int64())})

    return texts.select("text").mapInArrow(count, "word string, code long, n long").groupBy(*(["word"] if others else []), "code").agg(F.sum("n").alias("n"))


def _merged(sums: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code = np.concatenate([c for c, _ in sums])
    n = np.concatenate([k for _, k in sums])
    u, inverse = np.unique(code, return_inverse=True)
    return u, np.bincount(inverse, n, len(u)).astype(np.int64)


def _first(words: list[str], side: str, dims: int = DIMS) -> np.ndarray:
    """Small vectors to start from, which depend on nothing but the word."""
    made = b"".join(hashlib.shake_128(f"{side} {w}".encode()).digest(4 * dims) for w in words)
    return ((np.frombuffer(made, np.uint32).reshape(-1, dims) / 2**32 - 0.5) * 0.35).astype(np.float32)


def _gradients(counts: np.ndarray, w: np.ndarray, x: np.ndarray, cols: np.ndarray, per_pair: float) -> tuple[np.ndarray, np.ndarray]:
    """Of some centers' counts: the gradients of their vectors, and their part of the contexts'."""
    rows = counts.sum(1, keepdims=True)
    p = 1 / (1 + np.exp(-np.clip(w @ x.T, -20, 20)))
    g = counts * (p - 1) + per_pair * rows * cols * p
    return (g @ x) * (1.0 / np.maximum(rows, 1)).astype(np.float32), g.T @ w


def _descend(w: np.ndarray, squares: np.ndarray, d: np.ndarray) -> None:
    squares += d * d
    w -= 0.3 * d / np.sqrt(squares)


def skip_gram(counts: np.ndarray, dims: int = DIMS, steps: int = STEPS, negative: float = NEGATIVE, seed: int = 7, first: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Center and context vectors that minimise the skip-gram loss with negative sampling over the counts.

    All pairs of the corpus enter through their counts, so each step is one of full-batch
    gradient descent (Adagrad) on the expected loss. Returns the same vectors for the same counts.
    first: the vectors to start from, else random ones.
    """
    rng = np.random.default_rng(seed)
    v, c = counts.shape
    w, x = (a.copy() for a in first) if first else (rng.normal(0, 0.1, (k, dims)).astype(np.float32) for k in (v, c))
    per_pair = np.float32(negative / max(counts.sum(dtype=np.float64), 1.0))
    cols = counts.sum(0, keepdims=True)
    gw, gx = np.full_like(w, 1e-8), np.full_like(x, 1e-8)
    scale_x = (1.0 / np.maximum(cols.T, 1)).astype(np.float32)
    for _ in range(steps):
        dx = np.zeros_like(x)
        dw = np.zeros_like(w)
        for lo in range(0, v, 4096):
            hi = min(v, lo + 4096)
            dw[lo:hi], part = _gradients(counts[lo:hi], w[lo:hi], x, cols, per_pair)
            dx += part
        _descend(w, gw, dw)
        _descend(x, gx, dx * scale_x)
    return w, x


def skip_gram_spread(rows: DataFrame, contexts: list[str], steps: int = STEPS, negative: float = NEGATIVE) -> tuple[DataFrame, np.ndarray]:
    """The vectors of skip_gram where the counts are too many for the driver: the rows with their center's vector, and the contexts'.

    rows: word, seen (array of code, n: its counts by context), and others. A step is one pass in which the centers stay
    with the workers; the driver gets the sums of the contexts' gradients, one a task.
    """
    x = _first(contexts, "context")
    columns = len(contexts)
    cols = np.zeros((1, columns), np.float64)
    for code, n in rows.select(F.explode("seen").alias("s")).groupBy("s.code").agg(F.sum("s.n").alias("n")).collect():
        cols[0, code] = n
    per_pair = np.float32(negative / max(cols.sum(), 1.0))
    cols = cols.astype(np.float32)
    gx = np.full_like(x, 1e-8)
    scale_x = (1.0 / np.maximum(cols.T, 1)).astype(np.float32)
    state = rows.withColumn("w", F.lit(None).cast("binary")).withColumn("squares", F.lit(None).cast("binary")).withColumn("dx", F.lit(None).cast("binary"))
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema)
    for _ in range(steps):
        shared = rows.sparkSession.sparkContext.broadcast(x)

        def step(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            x = shared.value
            dx = np.zeros_like(x)
            names, types = [], []
            for whole in batches:
                names, types = whole.schema.names, whole.schema.types
                for lo in range(0, whole.num_rows, 2048):
                    b = whole.slice(lo, 2048)
                    seen, k = b.column("seen"), b.num_rows
                    at = np.repeat(np.arange(k), np.diff(seen.offsets.to_numpy()))
                    pair = seen.flatten()
                    counts = np.zeros((k, columns), np.float32)
                    counts[at, pair.field("code").to_numpy()] = pair.field("n").to_numpy()
                    if b.column("w").null_count:
                        w = _first(b.column("word").to_pylist(), "center")
                        squares = np.full_like(w, 1e-8)
                    else:
                        w, squares = (np.frombuffer(b"".join(b.column(a).to_pylist()), np.float32).reshape(k, -1).copy() for a in ("w", "squares"))
                    dw, part = _gradients(counts, w, x, cols, per_pair)
                    dx += part
                    _descend(w, squares, dw)
                    new = {"w": w, "squares": squares}
                    yield pa.record_batch([pa.array([r.tobytes() for r in new[a]], t) if a in new else b.column(a) for a, t in zip(names, types, strict=True)], names=names)
            if names:
                yield pa.record_batch([pa.array([dx.tobytes() if a == "dx" else None], t) for a, t in zip(names, types, strict=True)], names=names)

        state = settle(state.mapInArrow(step, kind))
        parts = state.filter(F.col("dx").isNotNull()).select("dx").collect()
        dx = sum((np.frombuffer(r[0], np.float32).reshape(x.shape).astype(np.float64) for r in parts), np.zeros(x.shape))
        _descend(x, gx, (dx * scale_x).astype(np.float32))
        state = state.filter(F.col("dx").isNull())
        shared.unpersist()
    return state.drop("squares", "dx"), x


def learn(texts: DataFrame, counts: DataFrame | None = None, words: int = WORDS, common: float = COMMON) -> Lexicon:
    """The lexicon of a corpus: counts, vectors, and what stands beside numbers, over all its texts.

    counts: the result of word_counts. The lexicon is partial if there are more than so many words.
    """
    return learn_apart(texts, settle(word_counts(texts)) if counts is None else counts, words, common)[0]


def learn_apart(texts: DataFrame, counts: DataFrame, words: int = WORDS, common: float = COMMON) -> tuple[Lexicon, DataFrame | None]:
    """The lexicon of learn, and if it lacks vectors (word, vector, left, right) of every word of LEAST uses."""
    total, different, often = counts.agg(F.sum("n"), F.count("*"), F.count_if(F.col("n") >= LEAST)).first()
    total = int(total or 0)
    partial = different > words
    # At most WORDS or 1 / COMMON words come to the driver.
    floor = max(LEAST, common * total) if partial else 0
    known = {r[0]: r[1] for r in counts.filter(F.col("n") >= floor).collect()}
    by_use = lambda c: sorted((w for w in c if not w.isdigit()), key=lambda w: (-c[w], w))
    columns = {r[0]: r[1] for r in counts.filter(F.col("n") >= max(LEAST, CONTEXT * total)).collect()}
    contexts = [NUMBER, *by_use(columns)]
    wide = len(contexts)
    spread = (often or 0) * max(wide, 100) > CELLS
    by_id = contexts if spread else [*contexts, *by_use({w: n for w, n in known.items() if n >= LEAST and w not in columns})]
    ids = {w: i for i, w in enumerate(by_id)}
    pairs = pair_counts(texts, ids, wide, spread or partial)
    rest = None
    if spread:
        here = texts.sparkSession.createDataFrame(list(enumerate(by_id)), "id long, name string")
        center = F.when(F.col("code") < 0, F.floor((-1 - F.col("code")) / 2)).otherwise(F.floor(F.col("code") / wide))
        first = F.when(F.col("code") < 0, F.col("code") + 2 * F.col("id")).otherwise(F.col("code") - wide * F.col("id"))
        named = pairs.filter("word IS NULL").withColumn("id", center).join(F.broadcast(here), "id").select(F.col("name").alias("word"), first.alias("code"), "n")
        uses = counts.filter(F.col("n") >= LEAST).select("word", F.col("n").alias("uses"))
        all_ = named.unionByName(pairs.filter("word IS NOT NULL")).join(uses, "word", "left").filter(F.col("uses").isNotNull() | (F.col("word") == NUMBER))
        share = lambda code: F.coalesce((F.max(F.when(F.col("code") == code, F.col("n"))) - 1) / F.greatest(F.max("uses") - 1, F.lit(1)), F.lit(0.0))
        seen = F.collect_list(F.when(F.col("code") >= 0, F.struct(F.col("code").cast("int").alias("code"), "n")))
        rows, context = skip_gram_spread(settle(all_.groupBy("word").agg(seen.alias("seen"), F.max("uses").alias("uses"), share(-1).alias("left"), share(-2).alias("right"))), contexts)
        rest = rows.select("word", F.col("w").alias("vector"), "left", "right", "uses")
        held = rest.filter((F.col("uses") >= floor) | (F.col("word") == NUMBER)).toPandas()
        center = np.frombuffer(b"".join(map(bytes, held["vector"])), np.float32).reshape(-1, DIMS)
        names, left, right = list(held["word"]), *(dict(zip(held["word"], held[a].astype(float), strict=True)) for a in ("left", "right"))
        ids = {w: i for i, w in enumerate(names)}
    else:
        uses = dict(known)
        if partial:
            pairs = settle(pairs)
            more = pairs.filter("word IS NOT NULL").join(counts.filter(F.col("n") >= LEAST).select("word", F.col("n").alias("uses")), "word").toPandas()
            pairs = pairs.filter("word IS NULL")
            uses |= columns | dict(zip(more["word"], more["uses"].tolist(), strict=True))
            by_id = [*by_id, *sorted(set(more["word"]))]
            ids = {w: i for i, w in enumerate(by_id)}
        found = pairs.select("code", "n").toPandas()  # at most CELLS rows
        code, n = found["code"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
        if partial and len(more):
            i, c = more["word"].map(ids).to_numpy(np.int64), more["code"].to_numpy(np.int64)
            code, n = np.concatenate([code, np.where(c < 0, c - 2 * i, c + wide * i)]), np.concatenate([n, more["n"].to_numpy(np.int64)])
        matrix = np.zeros((len(ids), wide), np.float32)
        matrix.ravel()[code[code >= 0]] = n[code >= 0]
        center, context = skip_gram(matrix, first=(_first(by_id, "center"), _first(contexts, "context")))
        ids = {w: i for w, i in ids.items() if matrix[i].any()}  # beside no context nothing is learned of a word
        left, right = {}, {}
        for c, k in zip((-1 - code[code < 0]).tolist(), n[code < 0].tolist(), strict=True):
            word = by_id[c // 2]
            # The use that the share is asked for says nothing by itself.
            (right if c % 2 else left)[word] = (k - 1) / max(uses.get(word, 1) - 1, 1)
    lex = Lexicon(known, total, (ids, center, {w: i for i, w in enumerate(contexts)}, context), (left, right))
    lex.partial, lex.apart = partial, spread and partial
    return lex, rest if lex.apart else None


def answers(asked: DataFrame, counts: DataFrame, total: int, learned: DataFrame | None = None) -> DataFrame:
    """TOLD: of every form asked its count, its links and theirs, by all words of the corpus, and if learned is given their vectors.

    Misreadings leave the glyph key as it is, so a form meets all words that it may link to, and
    all that these may link to, in the words of its key.
    """
    key = F.pandas_udf(lambda x: x.map(glyph_key), "string")
    low = F.pandas_udf(lambda x: x.str.lower(), "string")
    forms = settle(asked.select("form", low("form").alias("word"), key("form").alias("key")))
    if learned is None:
        counts = counts.select("*", F.lit(None).cast("binary").alias("vector"), F.lit(None).cast("double").alias("left"), F.lit(None).cast("double").alias("right"))
    else:
        counts = counts.join(learned.drop("uses"), "word", "left")
    near = counts.filter(F.col("n") >= LEAST).select(key("word").alias("key"), F.struct("word", "n", "vector").alias("w")).join(forms.select("key").distinct(), "key", "left_semi")
    near = near.groupBy("key").agg(F.collect_list("w").alias("near"))
    all_ = forms.join(counts, "word", "left").join(near, "key", "left").select("form", "word", F.coalesce("n", F.lit(0)).alias("n"), "near", "vector", "left", "right")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x in b.to_pylist():
                lex = Lexicon({w["word"]: w["n"] for w in x["near"] or []} | {x["word"]: x["n"]}, total)
                links = lex.links(x["form"]) if x["near"] else []
                of = {w["word"]: w["vector"] for w in x["near"] or []}
                vectors = [_numbers(v) for v in (x["vector"], *(of.get(y.lower()) for y in links))]
                rows.append({"form": x["form"], "n": x["n"], "links": links, "sizes": [lex.count(y) for y in links], "vector": vectors[0], "vectors": vectors[1:], "left": x["left"], "right": x["right"]})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("form", pa.string()), ("n", pa.int64()), ("links", pa.list_(pa.string())), ("sizes", pa.list_(pa.int64())),
                ("vector", pa.list_(pa.float32())), ("vectors", pa.list_(pa.list_(pa.float32()))), ("left", pa.float64()), ("right", pa.float64()),
            ]))

    return all_.mapInArrow(find, TOLD)


def _numbers(vector: bytes | None) -> list[float]:
    return np.frombuffer(vector or b"", np.float32).tolist()


TOLD = "form string, n long, links array<string>, sizes array<long>, vector array<float>, vectors array<array<float>>, left double, right double"
HEADER_ROWS = 60_000  # papers whose header forms may be broadcast, of a few hundred bytes each


def mended(figures: DataFrame, blocks: DataFrame, words: int = WORDS, common: float = COMMON) -> DataFrame:
    """table_name, row_id, field_name, repaired, damage (array): every text repaired, with the kinds of damage it had.

    NULL and empty texts give no row. Rows without a paper have no header forms, rows without
    a page number no page numbers to find. Repeated rows are treated alike. words, common: of
    the lexicon that is broadcast; the result does not depend on them.
    """
    rows = corpus(figures, blocks)
    counts = settle(word_counts(rows))
    lex, learned = learn_apart(rows, counts, words, common)
    for word, n in lex.counts.items():
        if n >= max(LEAST, common * lex.total):
            lex.links(word)  # once here instead of in every worker
    shared = figures.sparkSession.sparkContext.broadcast(lex)
    bands = page_bands(blocks)
    forms = settle(header_forms(blocks, bands[0]))
    # As one text, which passes to the workers far cheaper than a list.
    joined = rows.join(small_side(forms.select("paper", F.array_join("forms", "\n").alias("forms")), HEADER_ROWS), "paper", "left")
    partial = lex.partial
    given = ["table_name", "row_id", "field_name", "page", "y0", "paper", "forms", "text"]
    result = "table_name string, row_id long, field_name string, repaired string, damage array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = shared.value
        keys: dict[tuple, set] = {}
        for b in batches:
            texts = _texts(b)
            page, y0, field, papers = (b.column(x).to_pylist() for x in ("page", "y0", "field_name", "paper"))
            listed = b.column("forms")
            told = b.column("told").to_pylist() if partial else []
            repaired, damage, asked = [], [], []
            for i, text in enumerate(texts):
                known = keys.get(papers[i])
                if known is None:
                    if len(keys) > 20_000:
                        keys.clear()
                    known = keys[papers[i]] = {k for k in map(header_key, (listed[i].as_py() or "").split("\n")) if len(k) >= 2}
                if partial:
                    lex.tell(told[i] or [])
                new, kinds = mend(text, field[i] != "referencing_context", page[i], known, y0[i], lex, field[i] == "figure_content_text", bands)
                repaired.append(new)
                damage.append(sorted(kinds))
                if partial:
                    asked.append(sorted(lex.asked))
            out = {"table_name": b.column("table_name"), "row_id": b.column("row_id"), "field_name": b.column("field_name"), "repaired": pa.array(repaired, pa.string()), "damage": pa.array(damage, pa.list_(pa.string()))}
            if partial:
                out |= {x: b.column(x) for x in ("page", "y0", "paper", "forms", "text", "told")} | {"asked": pa.array(asked, pa.list_(pa.string()))}
            yield pa.record_batch(out)

    if not partial:
        return joined.select(given).mapInArrow(run, result)
    # A text is mended again with what it asked, until it asks no more: a word may be cut more than once.
    todo = joined.select(given).withColumn("told", F.lit(None).cast(f"array<struct<{TOLD.replace(' ', ':').replace(',:', ',')}>>"))
    more = f"{result}, page {joined.schema['page'].dataType.simpleString()}, y0 double, paper string, forms string, text string, told array<struct<{TOLD.replace(' ', ':').replace(',:', ',')}>>, asked array<string>"
    done = None
    while True:
        out = settle(todo.mapInArrow(run, more))
        ready = out.filter(F.size("asked") == 0).select("table_name", "row_id", "field_name", "repaired", "damage")
        done = ready if done is None else done.unionByName(ready)
        left = out.filter(F.size("asked") > 0).withColumn("id", F.sha2(F.to_json(F.struct(*given)), 256))
        if left.isEmpty():
            return done
        asks = left.select("id", F.explode("asked").alias("form")).distinct()
        found = settle(answers(asks.select("form").distinct(), counts, lex.total, learned))
        news = asks.join(found, "form").groupBy("id").agg(F.collect_list(F.struct(*found.columns)).alias("news"))
        todo = left.join(news, "id").withColumn("told", F.concat(F.coalesce("told", F.array().cast(left.schema["told"].dataType)), "news")).select(*given, "told")


def damaged_fields(figures: DataFrame, blocks: DataFrame) -> DataFrame:
    """(table_name, row_id, field_name, damage): one row per damaged field and kind of damage."""
    return mended(figures, blocks).select("table_name", "row_id", "field_name", F.explode("damage").alias("damage"))
