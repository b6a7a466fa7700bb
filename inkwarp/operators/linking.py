"""Captions and figures in the text of their page: page text, spans, contexts, ordinals, title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .predicates import is_caption


def page_texts(blocks: DataFrame) -> DataFrame:
    """(paper, page_num, page_text, n_blocks): the non-empty texts of a page in reading order, a blank line between.

    Texts are stripped first. Rows with the same block_id follow by block_key.
    """
    clean = F.regexp_replace(T.text(F.col("text")), rf"^[{T.SPACE}]+|[{T.SPACE}]+$", "")
    parts = F.array_sort(F.collect_list(F.when(F.col("t") != "", F.struct("block_id", "block_key", "t"))))
    return (
        blocks.select("paper", "page_num", "block_id", "block_key", clean.alias("t")).groupBy("paper", "page_num")
        .agg(F.array_join(F.transform(parts, lambda x: x["t"]), "\n\n").alias("page_text"), F.count("*").alias("n_blocks"))
    )


def captions_of(blocks: DataFrame) -> DataFrame:
    """The caption blocks with figure_idx, their ordinal on the page from 0, counted before anything is dropped."""
    place = F.row_number().over(Window.partitionBy("paper", "page_num").orderBy("block_id", "block_key")) - 1
    return blocks.filter(is_caption(F.col("text"))).withColumn("figure_idx", place)


def span_of(part: Column, whole: Column) -> Column:
    """struct(begin_off, end_off) of the first place of part in whole, from 0; (-1, -1) if it has none or is NULL."""
    at = F.coalesce(F.when(F.length(part) > 0, F.position(part, whole)), F.lit(0)) - 1
    return F.struct(at.alias("begin_off"), F.when(at < 0, -1).otherwise(at + F.length(part)).alias("end_off"))


def context_of(page_text: Column, number: Column, around: int = 250) -> tuple[Column, Column]:
    """(context, span) of the first mention of a figure's number on its page.

    'Fig. N' is looked for first, then 'Figure N', then 'FIG. N', without a boundary on the
    right. The window reaches so many characters to both sides; line ends come out as blanks.
    Without a mention, or with NULL, ('', (-1, -1)).
    """
    page = T.text(page_text)
    forms = [F.concat(F.lit(p), number) for p in ("Fig. ", "Figure ", "FIG. ")]
    at, size = F.lit(0), F.lit(0)
    for form in reversed(forms):
        here = F.coalesce(F.position(form, page), F.lit(0))
        size = F.when(here > 0, F.length(form)).otherwise(size)
        at = F.when(here > 0, here).otherwise(at)
    begin = F.greatest(F.lit(0), at - 1 - around)
    end = F.least(F.length(page), at - 1 + size + around)
    found = at > 0
    span = F.struct(F.when(found, begin).otherwise(-1).alias("begin_off"), F.when(found, end).otherwise(-1).alias("end_off"))
    return F.when(found, F.replace(F.substring(page, begin + 1, end - begin), F.lit("\n"), F.lit(" "))).otherwise(F.lit("")), span


def title_of(declared: Column, first_page: Column, lines: int = 6, least: int = 5) -> Column:
    """A paper's title: the declared one unless blank or a placeholder, else the first likely line of its first page, else ''."""
    strip = lambda c: F.regexp_replace(c, rf"^[{T.SPACE}]+|[{T.SPACE}]+$", "")
    own = strip(T.text(declared))
    good = F.when((own != "") & ~F.contains(F.lower(own), F.lit("replace with")), own)
    likely = F.filter(F.transform(F.slice(F.split(T.text(first_page), "\n"), 1, lines), strip), lambda x: (F.length(x) > least) & ~F.contains(F.lower(x), F.lit("arxiv")))
    return F.coalesce(good, F.get(likely, F.lit(0)), F.lit(""))


def titles(pages: DataFrame) -> DataFrame:
    """(paper, title): the declared title where pages have a column `title`, else from the text of each paper's first page."""
    declared = F.max("title") if "title" in pages.columns else F.max(F.lit(None).cast("string"))
    first = pages.groupBy("paper").agg(F.min_by("page_text", "page_num").alias("text"), declared.alias("own"))
    return first.select("paper", title_of(F.col("own"), F.col("text")).alias("title"))
