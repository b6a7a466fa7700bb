"""Linking captions to the drawings above them, and other work on boxes.

Joins run per page: an equality on (paper, page) with the range conditions as a residual.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import lexicons as L

PAGE = ["paper", "page_num"]
BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def page_widths(blocks: DataFrame, declared: DataFrame | None = None, spare: float = 50.0, default: float = 612.0) -> DataFrame:
    """(paper, page_num, width): the right-most block edge plus a spare, or with `declared` its page_width."""
    if declared is not None:
        return declared.groupBy(*PAGE).agg(F.coalesce(F.max("page_width"), F.lit(default)).alias("width"))
    return blocks.groupBy(*PAGE).agg(F.coalesce(F.max("bbox.x1") + spare, F.lit(default)).alias("width"))


def components_of(pages: DataFrame, rasters: str | None = None) -> DataFrame:
    """(paper, page_num, pos, box, kind): the drawings of each page, vector clusters before rasters."""
    vector = pages.select(*PAGE, F.posexplode("vector_clusters").alias("pos", "box"), F.lit("vector").alias("kind"))
    if rasters:
        n = F.coalesce(F.greatest(F.size("vector_clusters"), F.lit(0)), F.lit(0))
        raster = pages.withColumn("_n", n).select(*PAGE, "_n", F.posexplode(rasters).alias("p", "box")).select(*PAGE, (F.col("p") + F.col("_n")).alias("pos"), "box", F.lit("raster").alias("kind"))
        vector = vector.unionByName(raster)
    return vector.filter(F.col("box").isNotNull())


def link_captions(captions: DataFrame, components: DataFrame, widths: DataFrame) -> DataFrame:
    """(caption_key, pos, box, kind, caption_box, paper, page_num): the drawings above a caption in its column.

    captions: paper, page_num, caption_key, box. A caption wider than 0.6 of the page takes the
    whole width, another the left or the right 0.65 of it by its middle; a narrow caption
    without any drawing in its column takes those of the whole width.
    """
    c = captions.join(widths, PAGE).select(*PAGE, "caption_key", F.col("box").alias("caption_box"), "width")
    b, w = F.col("caption_box"), F.col("width")
    wide = (b["x1"] - b["x0"]) > 0.6 * w
    left = (b["x0"] + b["x1"]) / 2 < w / 2
    lo = F.when(wide | left, F.lit(0.0)).otherwise(0.35 * w)
    hi = F.when(wide | ~left, w).otherwise(0.65 * w)
    c = c.withColumn("lo", lo).withColumn("hi", hi)
    d = F.col("box")
    above = c.join(components, PAGE).filter((d["y1"] <= b["y0"]) & (d["x1"] > 0) & (d["x0"] < w))
    inside = (d["x1"] > F.col("lo")) & (d["x0"] < F.col("hi"))
    any_inside = F.max(inside).over(Window.partitionBy("caption_key"))
    return above.withColumn("inside", inside).withColumn("some", any_inside).filter(F.col("inside") | ~F.col("some")).select("caption_key", "pos", "box", "kind", "caption_box", *PAGE)


def merge_upwards(linked: DataFrame, gap: float = 150.0) -> DataFrame:
    """(caption_key, box, kind, parts): from the lowest drawing up, as long as the next is less than the gap above.

    kind is that of the lowest drawing; of drawings with the same foot the first listed counts.
    """
    order = Window.partitionBy("caption_key").orderBy(F.desc("box.y1"), "pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    broken = F.coalesce((F.min("box.y0").over(before) - F.col("box.y1") >= gap).cast("int"), F.lit(0))
    kept = linked.withColumn("broken", broken).withColumn("breaks", F.sum("broken").over(so_far)).withColumn("first_kind", F.first("kind").over(order)).filter("breaks = 0")
    return kept.groupBy("caption_key").agg(
        F.struct(F.min("box.x0").alias("x0"), F.min("box.y0").alias("y0"), F.max("box.x1").alias("x1"), F.max("box.y1").alias("y1")).alias("box"),
        F.min("first_kind").alias("kind"), F.count("*").alias("parts"),
    )


def texts_inside(boxes: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """(key, inside_text): the texts of the blocks whose middle lies in the box, in reading order; edges count.

    boxes: key, paper, page_num, box; blocks: paper, page_num, block_id, block_key, bbox, text.
    A box without such a block gives no row.
    """
    mid = lambda a, b: (F.col(f"bbox.{a}") + F.col(f"bbox.{b}")) / 2
    b = F.col("box")
    hit = boxes.join(blocks.select(*PAGE, "block_id", "block_key", "bbox", "text"), PAGE).filter(
        mid("x0", "x1").between(b["x0"], b["x1"]) & mid("y0", "y1").between(b["y0"], b["y1"])
    )
    ordered = F.array_sort(F.collect_list(F.struct("block_id", "block_key", F.coalesce("text", F.lit("")).alias("text"))))
    return hit.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["text"]), " ").alias("inside_text"))


def closure(boxes: np.ndarray, margin: float = 15.0) -> np.ndarray:
    """Boxes (n, 4) merged until no two are nearer than the margin in both directions.

    The result doesn't depend on their order. Two boxes meet if the gap between them is less
    than the margin; boxes without width and height are left out. A row of the result may
    stand for any number of boxes, as a merged box reaches further than its parts.
    """
    live = boxes[(boxes[:, 2] > boxes[:, 0]) | (boxes[:, 3] > boxes[:, 1])]
    while len(live) > 1:
        x0, y0, x1, y1 = live.T
        meet = (x0[:, None] - margin < x1[None]) & (x0[None] < x1[:, None] + margin) & (y0[:, None] - margin < y1[None]) & (y0[None] < y1[:, None] + margin)
        label = np.arange(len(live))
        while True:
            least = np.where(meet, label[None], len(live)).min(1)
            least = np.minimum(least, least[least])
            if (least == label).all():
                break
            label = least
        groups = np.unique(label)
        if len(groups) == len(live):
            break
        live = np.array([[x0[label == g].min(), y0[label == g].min(), x1[label == g].max(), y1[label == g].max()] for g in groups])
    return live[np.lexsort(live.T[::-1])] if len(live) else live.reshape(0, 4)


def cluster_boxes(boxes: DataFrame, keys: list[str], margin: float = 15.0, most: int = L.MAX_PATHS) -> DataFrame:
    """keys, x0, y0, x1, y1: the closure of each group's boxes (columns x0..y1).

    A group of more than `most` boxes, a page full of fine lines, gives none; it is left out
    before any group is brought together.
    """
    few = boxes.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") <= most).select(*keys)

    def one(group: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(closure(group[["x0", "y0", "x1", "y1"]].dropna().to_numpy(float), margin), columns=["x0", "y0", "x1", "y1"])
        for k in reversed(keys):
            out.insert(0, k, group[k].iloc[0])
        return out

    schema = ", ".join(f"`{k}` {t}" for k, t in boxes.select(*keys).dtypes) + ", x0 double, y0 double, x1 double, y1 double"
    return boxes.join(few, keys, "left_semi").select(*keys, "x0", "y0", "x1", "y1").groupBy(*keys).applyInPandas(one, schema)


def box_columns(box: Column) -> list[Column]:
    return [box[c].alias(c) for c in ("x0", "y0", "x1", "y1")]
