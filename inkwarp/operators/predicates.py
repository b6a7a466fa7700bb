"""Row filters on captions, boxes and sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import lexicons as L
from ..functions import text as T


def is_caption(c: Column, pattern: str = L.CAPTION_PATTERN) -> Column:
    """Whether a block's text begins like a caption; tables count."""
    return T.text(c).rlike("(?i)" + T.spaced(pattern))


def caption_number(c: Column, ordinal: Column, pattern: str = L.CAPTION_PATTERN) -> Column:
    """The caption's own number as text, else its ordinal."""
    return F.coalesce(F.nullif(F.regexp_extract(T.text(c), "(?i)" + T.spaced(pattern), 1), F.lit("")), ordinal.cast("string"))


def has_content(page_text: Column, clusters: Column) -> Column:
    """A page is skipped if it has neither text nor drawings."""
    return (F.length(T.text(page_text)) > 0) | (F.coalesce(F.size(clusters), F.lit(0)) > 0)


def pad_box(box: Column, page_width: Column, left: float = 45.0, up: float = 15.0, right: float = 10.0, down: float = 10.0) -> Column:
    """The box grown on all sides; clamped at 0 and at the page's width, not at its foot."""
    return F.struct(
        F.greatest(F.lit(0.0), box["x0"] - left).alias("x0"), F.greatest(F.lit(0.0), box["y0"] - up).alias("y0"),
        F.least(page_width, box["x1"] + right).alias("x1"), (box["y1"] + down).alias("y1"),
    )


def large_enough(box: Column, width: float = L.MIN_WIDTH, height: float = L.MIN_HEIGHT) -> Column:
    return (box["x1"] - box["x0"] >= width) & (box["y1"] - box["y0"] >= height)


def enough_bytes(image: Column, least: int = L.MIN_BYTES) -> Column:
    """Whether an image was rendered and has enough bytes; NULL bytes do not pass."""
    return F.coalesce(F.octet_length(image) >= least, F.lit(False))


def visual_check(width: Column, height: Column, size: Column) -> Column:
    """struct(ok, reason) of an image of whole-pixel sides and so many bytes; NULL counts as 0."""
    w, h, n = (F.coalesce(x.cast("long"), F.lit(0)) for x in (width, height, size))
    aspect = F.when(h != 0, w / F.nullif(h, F.lit(0)))
    shown = F.format_string("%.1f", aspect)
    reason = (
        F.when((w < L.MIN_WIDTH) | (h < L.MIN_HEIGHT), F.format_string("Too small dimensions (%dx%d)", w, h))
        .when((n > 0) & (n < L.MIN_BYTES), F.format_string("File size too small (%d bytes)", n))
        .when(h == 0, F.lit("Height is zero"))
        .when(aspect > 5.0, F.concat(F.lit("Rejected: Extreme aspect ratio (Wide Strip: "), shown, F.lit(")")))
        .when(aspect < 0.2, F.concat(F.lit("Rejected: Extreme aspect ratio (Tall Tower: "), shown, F.lit(")")))
        .otherwise(F.lit("Valid"))
    )
    return F.struct((reason == "Valid").alias("ok"), reason.alias("reason"))
