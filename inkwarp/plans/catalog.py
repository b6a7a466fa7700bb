"""The queries of the engine's own operators, each over its whole tables, and their SQL.

No SQL is given where it can't say the same: Unicode NFKC (mined_records_full, mined_pipeline,
clean_text_full) and trained models (scorer_probability). What these do besides has SQL under
other names: cleaned_captions, gate_names, mined_problems, figure_descriptions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicons as L
from ..functions import text as T
from ..operators import classify as C
from ..operators import geometry as G
from ..operators import linking as K
from ..operators import mining as M
from ..operators import ml
from ..operators import predicates as P
from ..operators import state as S
from ..session import paper, settle, spread, table
from ..sources import readers, writers
from . import pipeline


def _figures(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "figure_candidates")


def _spread(spark: SparkSession, d: str) -> DataFrame:
    return spread(_figures(spark, d))


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.with_paper(table(spark, d, "text_blocks"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.with_paper(table(spark, d, "paper_pages"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """How many figures each rule rejects, how many are accepted and rejected by score."""
    verdict = F.coalesce("veto", F.when(F.col("accepted"), F.lit("accepted")).otherwise(F.lit("rejected")))
    return C.classify(_spread(spark, d)).groupBy(verdict.alias("verdict")).agg(F.count("*").alias("figures"), F.sum("score").alias("score"))


# --- text metrics and predicates ---
def densities(spark, d):
    inside = F.lower(T.text(F.col("figure_content_text")))
    return _figures(spark, d).select("candidate_id", T.numeric_dense(inside).alias("numeric"), T.prose_dense(inside).alias("prose"), T.math_dense(inside).alias("math"))


def density_of_documents(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", T.numeric_dense(t, share=0.0).alias("numeric"), T.prose_dense(t).alias("prose"), T.math_dense(t).alias("math"))


def strict_gate_count(spark, d):
    return _figures(spark, d).select("candidate_id", T.strict_gates(F.col("figure_content_text")).alias("gates"))


def lexicon_hits(spark, d):
    low = F.col("low")
    return _figures(spark, d).select("candidate_id", F.lower(T.text(F.col("caption_text"))).alias("low")).select("candidate_id", T.contains_any(low, L.HARDWARE_VETO).alias("hardware"), T.count_terms(low, L.PLOT_EVAL).alias("plot_terms"), T.count_terms(low, L.STATE_VIZ).alias("state_terms"))


def bullet_veto(spark, d):
    return _figures(spark, d).select("candidate_id", T.contains_any(F.col("figure_content_text"), L.BULLETS).alias("bullets"))


def caption_blocks(spark, d):
    return table(spark, d, "text_blocks").filter(P.is_caption(F.col("text"))).select("block_key", P.caption_number(F.col("text"), F.lit(0)).alias("number"))


# --- classifier ---
def veto_cascade(spark, d):
    low, t = C.lowered(_spread(spark, d))
    return low.select("candidate_id", F.coalesce(C.veto(t), F.lit("")).alias("veto"))


def score_ladder(spark, d):
    return C.classify(_spread(spark, d)).select("candidate_id", "score", "accepted", F.array_join("reasons", ",").alias("reasons"))


def degraded_decision(spark, d):
    """Without a model every probability is 0."""
    return C.classify(_spread(spark, d).withColumn("p", F.lit(0.0)), prob="p").select("candidate_id", "score", "accepted")


def accepted_per_paper(spark, d):
    return S.accepted_per_paper(C.classify(pipeline.with_paper(_spread(spark, d))))


def verdict_counts(spark, d):
    return flagship(spark, d)


# --- geometry ---
def visual_filter(spark, d):
    check = P.visual_check(F.floor(F.col("bbox.x1") - F.col("bbox.x0")), F.floor(F.col("bbox.y1") - F.col("bbox.y0")), F.octet_length("image_bytes"))
    return _figures(spark, d).select("candidate_id", check.alias("c")).select("candidate_id", "c.ok", "c.reason")


def padded_boxes(spark, d):
    box = P.pad_box(F.col("bbox"), F.lit(612.0))
    return _figures(spark, d).select("candidate_id", box.alias("box")).filter(P.large_enough(F.col("box"))).select("candidate_id", *G.box_columns(F.col("box")))


def large_images(spark, d):
    return _figures(spark, d).filter(P.enough_bytes(F.col("image_bytes"))).select("candidate_id")


def page_width(spark, d):
    return G.page_widths(_blocks(spark, d))


def _linked(spark, d):
    blocks, pages = _blocks(spark, d), _pages(spark, d)
    captions = K.captions_of(blocks).select("paper", "page_num", F.col("block_key").alias("caption_key"), F.col("bbox").alias("box"))
    return G.link_captions(captions, G.components_of(pages), G.page_widths(blocks))


def caption_drawings(spark, d):
    return _linked(spark, d).select("caption_key", "pos")


def merged_drawings(spark, d):
    return G.merge_upwards(_linked(spark, d)).select("caption_key", *G.box_columns(F.col("box")), "parts")


def inside_texts(spark, d):
    boxes = pipeline.with_paper(_figures(spark, d)).select("candidate_id", "paper", "page_num", F.col("bbox").alias("box"))
    return G.texts_inside(boxes, _blocks(spark, d), "candidate_id")


def box_clusters(spark, d):
    flat = _pages(spark, d).select("paper", "page_num", F.explode("vector_clusters").alias("b")).select("paper", "page_num", "b.*")
    return G.cluster_boxes(flat, ["paper", "page_num"])


# --- text of the page ---
def page_texts(spark, d):
    return K.page_texts(_blocks(spark, d))


def figure_ordinals(spark, d):
    return K.captions_of(_blocks(spark, d)).select("block_key", "figure_idx")


def _on_page(spark, d):
    return pipeline.with_paper(_figures(spark, d)).join(_pages(spark, d).select("paper", "page_num", "page_text"), ["paper", "page_num"], "left")


def caption_spans(spark, d):
    return _on_page(spark, d).select("candidate_id", K.span_of(F.col("caption_text"), F.col("page_text")).alias("s")).select("candidate_id", "s.begin_off", "s.end_off")


def context_windows(spark, d):
    context, span = K.context_of(F.col("page_text"), P.caption_number(F.col("caption_text"), F.col("figure_idx") + 1))
    return _on_page(spark, d).select("candidate_id", context.alias("context"), span.alias("s")).select("candidate_id", "context", "s.begin_off", "s.end_off")


def paper_titles(spark, d):
    return K.titles(_pages(spark, d))


def pipeline_figures(spark, d):
    """Captions to padded boxes, the whole linking chain."""
    return pipeline.linked_figures(_blocks(spark, d), _pages(spark, d)).select("caption_key", "figure_idx", *G.box_columns(F.col("box")), "parts")


# --- mining ---
def cleaned_captions(spark, d):
    return _figures(spark, d).select("candidate_id", T.clean_text(F.col("caption_text"), normalize=False).alias("cleaned"))


def clean_text_full(spark, d):
    return _figures(spark, d).select("candidate_id", T.clean_text(F.col("caption_text")).alias("cleaned"))


def gate_names(spark, d):
    blob = F.concat_ws(" ", *(T.text(F.col(c)) for c in ("caption_text", "figure_content_text", "referencing_context")))
    return M.with_gates(_spread(spark, d), F.col("figure_content_text"), blob).select("candidate_id", F.array_join("gates", ",").alias("gates"))


def known_problems(spark, d):
    low = _figures(spark, d).select("candidate_id", F.lower(T.text(F.col("caption_text"))).alias("low"))
    return low.select("candidate_id", F.coalesce(M.known_problem(F.col("low")), F.lit("Unknown")).alias("problem"))


def mined_problems(spark, d):
    """The problem of every figure by its texts, cleaned but for NFKC, beside the title of its paper."""
    texts = [T.clean_text(F.col(c), normalize=False) for c in ("caption_text", "figure_content_text", "referencing_context")]
    fig = pipeline.with_paper(_spread(spark, d)).select("candidate_id", "paper", F.concat_ws(" ", *texts).alias("t")).join(K.titles(_pages(spark, d)), "paper", "left")
    return M.with_problem(fig, F.col("t"), F.col("title")).select("candidate_id", "problem")


def problem_fallbacks(spark, d):
    """What documents say their circuits are for, or the words before 'problem'."""
    return M.with_problem(table(spark, d, "documents"), F.col("text"), F.lit("")).select("doc_id", "problem")


def figure_descriptions(spark, d):
    c, x = (T.clean_text(F.col(n), normalize=False) for n in ("caption_text", "referencing_context"))
    return _figures(spark, d).select("candidate_id", c.alias("c"), x.alias("x")).select("candidate_id", F.array_join(M.descriptions(F.col("c"), F.col("x")), "|").alias("descriptions"))


def positive_share(spark, d):
    """Softmax of two logits, here of the scores that figures have."""
    zero, one = F.lit(0.0), F.when(~F.isnan("classification_score"), F.col("classification_score")).cast("double")
    return _figures(spark, d).select("candidate_id", F.round(ml.positive_probability(zero, one), 9).alias("p"))


def mined_records_full(spark, d):
    fig = pipeline.with_paper(_spread(spark, d)).withColumn("arxiv_id", F.col("paper"))
    return M.mine(fig)


def mined_pipeline(spark, d):
    return pipeline.run(table(spark, d, "text_blocks"), table(spark, d, "paper_pages"))


def image_names(spark, d):
    return pipeline.with_paper(_figures(spark, d)).filter(F.col("paper").isNotNull()).select("candidate_id", M.file_name(F.col("paper"), F.col("page_num"), F.col("figure_idx")).alias("filename"))


def model_texts(spark, d):
    return _figures(spark, d).select("candidate_id", M.model_text(F.col("caption_text"), F.col("referencing_context")).alias("text"))


def latest_records(spark, d):
    """Mined records upserted by file name into an empty data set: the latest mined of each stays."""
    new = table(spark, d, "mined_records").select("filename", "record_id", "mined_at")
    return M.upsert(new.limit(0), new, ["mined_at", "record_id"]).select("filename", "record_id")


def upserted_records(spark, d):
    """The records of even pages with those of odd pages upserted: the later batch wins whatever its time."""
    new = table(spark, d, "mined_records").filter(F.col("filename").isNotNull()).select(F.col("arxiv_number").alias("paper"), "page_number", "record_id", "mined_at").filter(F.col("paper").isNotNull())
    order = ["mined_at", "record_id"]
    base = M.upsert(new.limit(0), new.filter("page_number % 2 = 0"), order, "paper")
    return M.upsert(base, new.filter("page_number % 2 <> 0"), order, "paper").select("paper", "record_id")


def merged_counts(spark, d):
    """The queue with the accepted figures of its papers put in as their counts."""
    found = S.accepted_per_paper(C.classify(pipeline.with_paper(_spread(spark, d)))).filter(F.col("paper").isNotNull())
    return S.merge_counts(_status(spark, d), found.withColumnRenamed("found", "fig_count"))


# --- files ---
def _written(spark, write) -> str:
    """Where a sink has put its files: a folder of its own in the checkpoint folder, shared and removed with it."""
    settle(spark.range(1))
    path = f"{spark.sparkContext.getCheckpointDir()}/files-{uuid.uuid4().hex}"
    write(path)
    return path


def paper_list_file(spark, d):
    """The paper list written as lines and read again: positions by rank, as typed ones may differ."""
    queue = table(spark, d, "paper_queue")
    path = _written(spark, lambda p: queue.select("arxiv_id").na.fill("").repartition(1).write.text(p))
    return readers.read_paper_list(spark, path).groupBy("paper").agg(F.count("*").alias("listed"))


def progress_file(spark, d):
    """The state of the queue written as counts and read again."""
    path = _written(spark, lambda p: writers.write_progress(_status(spark, d), p))
    return readers.read_progress(spark, path).select("paper", "fig_count")


def labels_file(spark, d):
    """The labels written as a file and read again; rows with a missing text or label go."""
    path = _written(spark, lambda p: table(spark, d, "labels_merged_new").select("text", "label").write.csv(p, header=True, escape='"', quoteAll=True))
    return readers.read_labels(spark, path).groupBy("label", "text").agg(F.count("*").alias("rows"))


def dataset_file(spark, d):
    """Mined records written one JSON object a line and read again."""
    path = _written(spark, lambda p: writers.write_dataset(table(spark, d, "mined_records").select("filename", "record_id", "quantum_problem", "page_number"), p))
    return readers.read_dataset(spark, path, "filename string, record_id long, quantum_problem string, page_number int")


def distinct_gates(spark, d):
    g = table(spark, d, "mined_records").select("arxiv_number", F.explode("quantum_gates").alias("gate")).filter(F.col("gate").isNotNull())
    return g.groupBy("arxiv_number").agg(F.array_join(F.array_sort(F.collect_set("gate")), "|").alias("gates"))


# --- state ---
def _status(spark, d):
    queue = table(spark, d, "paper_queue").select("pos", paper(F.col("arxiv_id")).alias("paper")).filter(F.col("paper").isNotNull())
    return S.with_status(queue, pipeline.with_paper(table(spark, d, "paper_progress")))


def queue_status(spark, d):
    return _status(spark, d)


def unprocessed_papers(spark, d):
    return S.unprocessed(_status(spark, d))


def next_claim(spark, d):
    return S.claim(_status(spark, d), 64)


def progress_total(spark, d):
    return S.total_collected(_status(spark, d))


def soft_target(spark, d):
    return S.within_target(_status(spark, d).select("pos", F.col("fig_count").alias("n")))


# --- learning ---
def stratified_split(spark, d):
    return ml.stratified_split(ml.labelled(table(spark, d, "labels_merged_new")).select("label_id", "label"), "label_id").select("label_id", "is_test")


def class_weights(spark, d):
    return ml.class_weights(ml.labelled(table(spark, d, "labels_merged_new")))


def decision_metrics(spark, d):
    both = table(spark, d, "labels_merged_new").select("candidate_id", "label").join(C.classify(_figures(spark, d)).select("candidate_id", "accepted"), "candidate_id")
    return ml.binary_metrics(both, F.col("label"), F.col("accepted").cast("int"))


def decision_loss(spark, d):
    """The mean loss of the given probabilities on the labels, weighted as for training."""
    labels = table(spark, d, "labels_merged_new")
    both = labels.select("candidate_id", "label").join(_figures(spark, d).select("candidate_id", F.coalesce("bert_circuit_prob", F.lit(0.0)).alias("p")), "candidate_id")
    loss = ml.mean_loss(both, F.col("label"), F.col("p"), ml.class_weights(ml.labelled(labels)).first()["weight"] or 1.0)
    return loss.select("n", F.round("loss", 6).alias("loss"))


def scorer_probability(spark, d):
    model = ml.train_scorer(table(spark, d, "labels_merged_new"))
    return ml.model_scorer(model)(_figures(spark, d).select("candidate_id", "caption_text", "referencing_context"), M.model_text(F.col("caption_text"), F.col("referencing_context"))).select("candidate_id", "p")


_NAMES = (
    "densities density_of_documents strict_gate_count lexicon_hits bullet_veto caption_blocks veto_cascade score_ladder degraded_decision accepted_per_paper "
    "verdict_counts visual_filter padded_boxes large_images page_width caption_drawings merged_drawings inside_texts box_clusters page_texts figure_ordinals "
    "caption_spans context_windows paper_titles pipeline_figures cleaned_captions clean_text_full gate_names known_problems mined_records_full mined_pipeline "
    "image_names model_texts latest_records distinct_gates queue_status unprocessed_papers next_claim progress_total soft_target stratified_split class_weights "
    "decision_metrics scorer_probability mined_problems problem_fallbacks figure_descriptions positive_share upserted_records merged_counts paper_list_file "
    "progress_file labels_file dataset_file decision_loss"
).split()


from .oracle import oracle_sql  # noqa: E402, F401


def queries() -> dict:
    return {n: globals()[n] for n in _NAMES}
