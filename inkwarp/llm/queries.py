"""The pN_ queries, each over its whole tables with production parameters, and their SQL.

pN_found is given only where SQL can say the same over whole tables: P2. P1, P3, P4, P5, P6
and P8 rest on algorithms or tokenizers that SQL lacks; they are tested by brute force on
fixtures in tests/llm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import paper, settle, table
from . import canonical, capping, glyphs, mixing, packing, scans, splits, subjects
from .tokens import token_count

SCORES = ["classification_score", "bert_circuit_prob"]
TEXTS = ["caption_text", "figure_content_text", "referencing_context"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.map_records(table(spark, d, "mined_records"), table(spark, d, "canonical_terms")).select("record_id", F.col("slot").cast("int").alias("slot"), "ref_id")


def p1_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return canonical.unmatched(table(spark, d, "mined_records"), table(spark, d, "canonical_terms"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return capping.over_cap(table(spark, d, "figure_candidates"), paper(F.col("arxiv_id")), "candidate_id", SCORES, cap=10)


def p2_share(spark: SparkSession, d: str) -> DataFrame:
    """Rows to drop so that no paper keeps more than a fiftieth of all rows that stay."""
    return capping.over_cap(table(spark, d, "figure_candidates"), paper(F.col("arxiv_id")), "candidate_id", SCORES, cap=None, share=0.02)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.spanning_groups(table(spark, d, "labels_merged_new"), table(spark, d, "figure_candidates"))


def p3_splits(spark: SparkSession, d: str) -> DataFrame:
    return splits.assign_splits(splits.labelled_groups(table(spark, d, "labels_merged_new"), table(spark, d, "figure_candidates"))).select("label_id", "root", "split")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.damaged_fields(table(spark, d, "figure_candidates"), table(spark, d, "text_blocks"))


def p4_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scans.mended(table(spark, d, "figure_candidates"), table(spark, d, "text_blocks")).select("table_name", "row_id", "field_name", "repaired")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return glyphs.changed_fields(table(spark, d, "figure_candidates"), "candidate_id", TEXTS)


def p5_unified(spark: SparkSession, d: str) -> DataFrame:
    return glyphs.unify_columns(table(spark, d, "figure_candidates").select("candidate_id", *TEXTS), TEXTS)


def _packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), "doc_id", token_count(F.col("text")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d).filter("parts > 1").select("doc_id").distinct()


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill(_packed(spark, d))


def p7_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"), token_count(F.col("text")))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(table(spark, d, "documents"), table(spark, d, "mix_targets"), token_count(F.col("text")))


def p7_tempered(spark: SparkSession, d: str) -> DataFrame:
    """The shares where the sources' own shares are tempered to the entropy of the targets."""
    return mixing.shares(table(spark, d, "documents"), table(spark, d, "mix_targets"), token_count(F.col("text")), by_entropy=True)


def p7_whole(spark: SparkSession, d: str) -> DataFrame:
    """The shares of a mixture of the corpus' size, for which the limits of repetition draw the targets towards what the sources hold."""
    documents, targets = table(spark, d, "documents"), table(spark, d, "mix_targets")
    counted = settle(documents.select("doc_id", "source", token_count(F.col("text")).alias("n")))
    return mixing.shares(counted, targets, F.col("n"), total=counted.agg(F.sum("n")).first()[0] or 0)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return subjects.assign_subjects(*(table(spark, d, x) for x in ("documents", "doc_subjects", "subject_areas"))).select("doc_id", "subject_id")


def p8_composition(spark: SparkSession, d: str) -> DataFrame:
    return subjects.composition(*(table(spark, d, x) for x in ("documents", "doc_subjects", "subject_areas")))


def queries() -> dict:
    names = ("p1_found", "p1_unmatched", "p2_found", "p2_share", "p3_found", "p3_splits", "p4_found", "p4_repaired", "p5_found", "p5_unified", "p6_found", "p6_containers", "p6_fill", "p7_mixture", "p7_shares", "p7_tempered", "p7_whole", "p8_found", "p8_composition")
    return {n: globals()[n] for n in names}


_PAPER = r"""coalesce(nullif(regexp_extract(lower(arxiv_id), '(\d{4}\.\d{4,5}|[a-z][a-z\-]*(?:\.[a-z]{2})?/\d{7})', 1), ''), nullif(trim(lower(arxiv_id)), ''))"""


def oracle_sql() -> dict[str, str]:
    low = "CASE WHEN {0} IS NULL OR isnan({0}) THEN NULL ELSE {0} END DESC NULLS LAST"
    return {
        "p2_found": f"""
            SELECT candidate_id FROM (
              SELECT candidate_id, row_number() OVER (PARTITION BY paper ORDER BY {low.format("classification_score")}, {low.format("bert_circuit_prob")}, candidate_id) AS place
              FROM (SELECT *, {_PAPER} AS paper FROM figure_candidates) WHERE paper IS NOT NULL
            ) WHERE place > 10""",
        "p2_share": f"""
            WITH f AS (SELECT *, {_PAPER} AS paper FROM figure_candidates), n AS (SELECT count(*) AS n FROM f WHERE paper IS NOT NULL GROUP BY paper),
              c AS (SELECT coalesce(max(c), 0) AS cap FROM (SELECT c, sum(least(n, c)) AS kept FROM n, (SELECT unnest(range(1, (SELECT max(n) + 1 FROM n))) AS c) GROUP BY c) WHERE c <= 0.02::DOUBLE * kept)
            SELECT candidate_id FROM (
              SELECT candidate_id, row_number() OVER (PARTITION BY paper ORDER BY {low.format("classification_score")}, {low.format("bert_circuit_prob")}, candidate_id) AS place FROM f WHERE paper IS NOT NULL
            ), c WHERE place > cap""",
    }
