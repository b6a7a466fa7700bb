"""From pages and their blocks to accepted, mined figures: one declarative plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import classify as C
from ..operators import geometry as G
from ..operators import linking as K
from ..operators import mining as M
from ..operators import predicates as P
from ..operators.ml import Scorer, constant_scorer
from ..session import paper, settle
from ..sources.readers import render


def with_paper(df: DataFrame) -> DataFrame:
    return df.withColumn("paper", paper(F.col("arxiv_id")))


def linked_figures(blocks: DataFrame, pages: DataFrame, width_mode: str = "compat") -> DataFrame:
    """caption_key, paper, page_num, figure_idx, box, kind, parts, caption, caption_box: drawings merged for each caption, padded and large enough.

    blocks and pages have a column paper; pages may have rasters (an array of boxes), drawings
    after the vector clusters. Captions without any drawing give no row; figure_idx counts them
    all the same.
    """
    widths = G.page_widths(blocks, pages if width_mode == "declared" else None)
    captions = K.captions_of(blocks).select("paper", "page_num", "figure_idx", F.col("block_key").alias("caption_key"), F.col("bbox").alias("box"), F.col("text").alias("caption"))
    keep = pages.filter(P.has_content(F.col("page_text"), F.col("vector_clusters")))
    rasters = "rasters" if "rasters" in pages.columns else None
    linked = G.link_captions(captions.select("paper", "page_num", "caption_key", "box"), G.components_of(keep, rasters), widths)
    merged = G.merge_upwards(linked)
    full = merged.join(captions.withColumnRenamed("box", "caption_box"), "caption_key").join(widths, G.PAGE)
    return full.withColumn("box", P.pad_box(F.col("box"), F.col("width"))).filter(P.large_enough(F.col("box"))).drop("width")


def described_figures(blocks: DataFrame, pages: DataFrame, width_mode: str = "compat") -> DataFrame:
    """linked_figures with inside text, context and spans, as candidates of the classifier."""
    figures = linked_figures(blocks, pages, width_mode)
    inside = G.texts_inside(figures.select("caption_key", "paper", "page_num", "box"), blocks, "caption_key")
    texts = K.page_texts(blocks).select("paper", "page_num", "page_text")
    both = figures.join(inside, "caption_key", "left").join(texts, G.PAGE, "left")
    context, span = K.context_of(F.col("page_text"), P.caption_number(F.col("caption"), F.col("figure_idx") + 1))
    return both.select(
        F.col("paper").alias("arxiv_id"), "page_num", "figure_idx", F.col("box").alias("bbox"), F.col("caption").alias("caption_text"), F.col("caption_box").alias("caption_bbox"),
        K.span_of(F.col("caption"), F.col("page_text")).alias("caption_span"), span.alias("context_span"), F.coalesce("inside_text", F.lit("")).alias("figure_content_text"),
        context.alias("referencing_context"), F.col("kind").alias("source_type"), "caption_key",
    )


def accepted_figures(candidates: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """The candidates with p and the classifier's columns, only the accepted ones.

    The vetoes come before the scorer, so that a costly model sees only what they leave.
    """
    low, t = C.lowered(candidates)
    open_ = low.filter(C.veto(t).isNull()).drop(*C.NAMES)
    scored = (scorer or constant_scorer())(open_, M.model_text(F.col("caption_text"), F.col("referencing_context")))
    return C.classify(scored, prob="p").filter("accepted")


def run(blocks: DataFrame, pages: DataFrame, scorer: Scorer | None = None, renderer: Callable | None = None) -> DataFrame:
    """The mined records of all accepted figures of the pages.

    With a renderer (see sources.readers.render; the paper stands for its path) figures whose
    image is missing or too small are dropped before they are classified.
    """
    blocks, pages = with_paper(blocks), with_paper(pages)
    found = described_figures(blocks, pages)
    if renderer is not None:
        found = render(found.withColumns({"path": F.col("arxiv_id"), "box": F.col("bbox")}), renderer).filter(P.enough_bytes(F.col("image_bytes"))).drop("path", "box", "image_bytes")
    # Kept once: a veto pushed below would repeat the search for each context in every rule.
    figures = accepted_figures(settle(found), scorer)
    named = figures.join(K.titles(pages).withColumnRenamed("paper", "arxiv_id"), "arxiv_id", "left")
    return M.mine(named, F.col("title"))
