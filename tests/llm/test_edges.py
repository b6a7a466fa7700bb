"""Every operator with NULLs in all columns, empty and very long texts, repeated rows, empty tables and columns whose names clash."""

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwarp.llm import canonical, capping, glyphs, mixing, packing, scans, splits, subjects
from inkwarp.session import paper

LONG = "The proof proceeds by induction over the register. " * 4000
CLASH = (
    "key root entity raw rid w words whole first path n g id lo hi cut need tied salt tokens part parts block rest h epoch place until source text lift terms uses sizes f s0 subjects paper page y0 "
    "forms damage told asked vid fid form kind value affix plain at size ref_id tok pos side slot field_name table_name row_id label split b s l t weight exponent used held whole_a"
).split()
BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
FIGURE = "candidate_id long, arxiv_id string, page_num int, caption_text string, figure_content_text string, referencing_context string, classification_score double, bert_circuit_prob double"


def clashing(df: DataFrame) -> DataFrame:
    """df with columns that are named like what the operators use inside; none of its own is touched."""
    return df.withColumns({c: F.lit("x") for c in CLASH if c not in df.columns})


@pytest.fixture(scope="module")
def tables(spark):
    captions = ["Fig. 1: A box folds into nine copies of the register today", "FIG. 8. a box folds into nine copies of the register today", "", None, LONG, "x", "Fig. 3"]
    figures = [(i, p, 1, c, None if i % 2 else "q​0", "", s, b) for i, (p, c, s, b) in enumerate(zip(["2001.00001", "2002.00002", None, "2001.00001", "2003.00003", " ", "2001.00001v2"], captions, [1.0, None, 2.0, float("nan"), 1.0, 0.0, 1.0], [0.5, None, float("nan"), 0.5, 0.5, 0.1, 0.5], strict=True))]
    return {
        "figures": spark.createDataFrame([*figures, figures[0], (None,) * 8], FIGURE),
        "labels": spark.createDataFrame([(10 + i, i, [0, 1, None][i % 3]) for i in range(8)] + [(10, 0, 0), (99, None, 1), (None, 1, 1), (None, None, None)], "label_id long, candidate_id long, label int"),
        "blocks": spark.createDataFrame([(1, "2001.00001", 1, 0, (0.0, 30.0, 9.0, 42.0), "Drift and Echo"), (2, None, None, None, None, None), (3, "2001.00001", 1, 1, (0.0, 99.0, 9.0, 120.0), LONG), (1, "2001.00001", 1, 0, (0.0, 30.0, 9.0, 42.0), "Drift and Echo")],
                                        f"block_key long, arxiv_id string, page_num int, block_id int, bbox {BOX}, text string"),
        "records": spark.createDataFrame([(1, "grover", ["H gate", None, " ", "H gate"]), (2, None, None), (3, LONG, []), (1, "grover", ["H gate", None, " ", "H gate"]), (None, "Unknown", [LONG])], "record_id long, quantum_problem string, quantum_gates array<string>"),
        "reference": spark.createDataFrame([(1, "problem", "Grover", None), (2, "gate", "H", ["Hadamard", None]), (3, None, None, None), (None, "gate", "Lens", [])], "ref_id int, kind string, term string, aliases array<string>"),
        "documents": spark.createDataFrame([(1, "Goals and referees. A match was lost.", "Feed"), (2, None, None), (3, "", "feed"), (4, LONG, " feed"), (1, "Goals and referees. A match was lost.", "Feed"), (None, "Goals and referees.", "")], "doc_id long, text string, source string"),
        "ratings": spark.createDataFrame([(1, 7), (1, 7), (None, 7), (4, None), (77, 7), (1, 99)], "doc_id long, subject_id int"),
        "areas": spark.createDataFrame([(7, "sport"), (8, "law"), (None, None)], "subject_id int, subject string"),
        "targets": spark.createDataFrame([("feed", 0.9, None), ("ghost", 0.1, 3), (None, 0.5, 1), ("other", None, 1)], "source string, target_share double, max_repeats int"),
    }


TEXTS = ["caption_text", "figure_content_text", "referencing_context"]
OPERATORS = {
    "map_records": (lambda t: canonical.map_records(t["records"], t["reference"]).select("record_id", "slot", "ref_id"), ["records", "reference"]),
    "unmatched": (lambda t: canonical.unmatched(t["records"], t["reference"]), ["records", "reference"]),
    "over_cap": (lambda t: capping.over_cap(t["figures"], paper(F.col("arxiv_id")), "candidate_id", ["classification_score", "bert_circuit_prob"], cap=2), ["figures"]),
    "over_share": (lambda t: capping.over_cap(t["figures"], paper(F.col("arxiv_id")), "candidate_id", ["classification_score"], cap=None, share=0.4), ["figures"]),
    "groups": (lambda t: splits.spanning_groups(t["labels"], t["figures"]), ["labels", "figures"]),
    "splits": (lambda t: splits.assign_splits(splits.labelled_groups(t["labels"], t["figures"])).groupBy("label_id").agg(F.count("*").alias("rows")), ["labels", "figures"]),
    "damaged": (lambda t: scans.damaged_fields(t["figures"], t["blocks"]), ["figures", "blocks"]),
    "mended": (lambda t: scans.mended(t["figures"], t["blocks"]).select("table_name", "row_id", "field_name", F.md5("repaired").alias("r")), ["figures", "blocks"]),
    "unified": (lambda t: glyphs.unify_columns(t["figures"], TEXTS).select("candidate_id", F.md5("figure_content_text").alias("r")), ["figures"]),
    "changed": (lambda t: glyphs.changed_fields(t["figures"], "candidate_id", TEXTS), ["figures"]),
    "packed": (lambda t: packing.pack(t["documents"], "doc_id", F.length("text"), capacity=4096).select("doc_id", "part", "parts", "tokens", "bucket"), ["documents"]),
    "mixture": (lambda t: mixing.mixture(t["documents"], t["targets"], F.length("text")).select("doc_id", "source", "epoch", "tokens"), ["documents", "targets"]),
    "shares": (lambda t: mixing.shares(t["documents"], t["targets"], F.length("text")).select("source", "held", "used", "repeats"), ["documents", "targets"]),
    "subjects": (lambda t: subjects.assign_subjects(t["documents"], t["ratings"], t["areas"]).select("doc_id", "subject_id"), ["documents", "ratings", "areas"]),
    "composition": (lambda t: subjects.composition(t["documents"], t["ratings"], t["areas"]).select("subject_id", "docs"), ["documents", "ratings", "areas"]),
}


def rows(df: DataFrame) -> list:
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_defined_results(name, tables):
    run, used = OPERATORS[name]
    got = rows(run(tables))
    assert rows(run(tables | {t: clashing(tables[t]) for t in used})) == got
    # Without any row in the first table there is none in the result, but for reports that list what is asked for.
    empty = rows(run(tables | {used[0]: tables[used[0]].limit(0)}))
    assert len(empty) == {"shares": 4, "composition": 3, "damaged": len([r for r in got if "text_blocks" in r]), "mended": len([r for r in got if "text_blocks" in r])}.get(name, 0)


def test_results_on_odd_rows(tables):
    """What the rows above come out as."""
    of = {n: rows(OPERATORS[n][0](tables)) for n in ("map_records", "over_cap", "groups", "splits", "damaged", "changed", "packed", "mixture")}
    assert of["map_records"].count("Row(record_id=1, slot=0, ref_id=1)") == 2  # repeated rows map alike
    assert of["map_records"].count("Row(record_id=1, slot=1, ref_id=2)") == 2 and not any("slot=2" in r for r in of["map_records"])
    assert "Row(record_id=3, slot=0, ref_id=-1)" in of["map_records"] and "Row(record_id=None, slot=1, ref_id=-1)" in of["map_records"]
    # Figure 0 is there twice and stays so; of the others of its paper all go, and no row without a paper.
    assert of["over_cap"] == ["Row(candidate_id=3)", "Row(candidate_id=6)"]
    assert {r for r in of["groups"]} >= {"Row(label_id=10, group_paper='2001.00001')", "Row(label_id=11, group_paper='2001.00001')"}
    assert "Row(label_id=99" not in " ".join(of["splits"]) and "Row(label_id=17, rows=1)" in of["splits"]
    assert any("text_blocks" in r and "header" in r for r in of["damaged"])
    assert of["changed"].count("Row(candidate_id=0, field_name='figure_content_text')") == 2
    assert len([r for r in of["packed"] if "doc_id=4" in r]) == -(-len(LONG) // 4096)
    assert all("source='feed'" in r for r in of["mixture"]) and any("doc_id=4" in r for r in of["mixture"])
