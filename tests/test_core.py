"""Golden rows, boundaries and properties of the engine's own operators."""

import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwarp.functions import text as T
from inkwarp.operators import classify as C
from inkwarp.operators import geometry as G
from inkwarp.operators import linking as K
from inkwarp.operators import mining as M
from inkwarp.operators import ml
from inkwarp.operators import predicates as P
from inkwarp.operators import state as S
from inkwarp.plans import pipeline
from inkwarp.session import paper
from inkwarp.sources import readers, writers

GOLD = [  # caption, inside, p, veto or score, accepted
    ("Fig. 1. Quantum circuit for Grover search", "H X CNOT |0⟩", 0.9, 10, True), ("FIG. 2. Optical micrograph of the chip", "", 0.9, "HardwareTerms", False),
    ("Figure 3: Device", "5 nm", 0.9, "ScaleUnit(nm)", False), ("Figure 4", "0 1 2 3 a", 0.9, "NumericDensity(Plot/Table)", False),
    ("Figure 5", "the cat and the dog of the house is in a box", 0.9, "ProseDensity", False), ("Figure 6", "a = b + c - d", 0.9, "MathSymbolDensity", False),
    ("Figure 7: Fidelity of the state", "H", 0.9, "Viz/PlotKeyword", False), ("Figure 8: List of symbols", "", 0.9, "Definition/Math", False),
    ("Figure 9", "trunk line", 0.9, "PlotKeywordsInside", False), ("Figure 10: Square lattice", "", 0.9, "LatticeNoCircuit", False),
    ("Figure 11", "• first", 0.9, "BulletPointsFound", False), ("Table 1: Quantum circuit truth table", "0 1 1 0 1", 0.9, 7, True),
    ("Figure 8: circuit diagram", "", 0.22, 3, False), ("Figure 8: circuit diagram", "", 0.25, 3, True), ("Figure 9: schematic", "H", 0.30, 2, False),
    ("Figure 9: schematic", "H", 0.31, 2, True), ("Figure 10", "H", 0.35, 1, False), ("Figure 10", "H", 0.36, 1, True),
    ("Figure 11: accuracy per qubit", "", 0.92, 0, False), ("Figure 11: accuracy per qubit", "", 0.93, 0, True), ("Figure 12: Quantum circuit", "H CNOT", 0.0, 3, True),
    ("Figure 13", "x", 0.36, 1, True),
]


def test_golden_figures(spark):
    df = spark.createDataFrame([(i, c, t, None, p) for i, (c, t, p, _, _) in enumerate(GOLD)], "i int, caption_text string, figure_content_text string, referencing_context string, bert_circuit_prob double")
    for r in C.classify(df).collect():
        _, _, _, want, yes = GOLD[r["i"]]
        assert (r["veto"] if isinstance(want, str) else r["score"]) == want, r
        assert r["accepted"] == yes, r


def test_null_and_nan_probability(spark):
    df = spark.createDataFrame([("Figure 8: circuit diagram", None, None, None), ("Figure 8: circuit diagram", None, None, float("nan")), (None, None, None, None)], "caption_text string, figure_content_text string, referencing_context string, bert_circuit_prob double")
    rows = C.classify(df).collect()
    assert [(r["score"], r["accepted"]) for r in rows] == [(1, False), (3, True), (-2, False)]
    assert C.classify(df.limit(0)).count() == 0


def test_density_edges(spark):
    cases = ["1 a b c", "1 a b c d", " ".join(["1"] * 3 + ["a"] * 17), " ".join(["1"] * 4 + ["a"] * 16), "", None]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in cases], "t string").select(T.numeric_dense(F.col("t"))).collect()]
    assert got == [False, True, False, True, False, False]
    edge = ["=" * 2 + "a" * 47, "=" * 3 + "a" * 46, "==" + "a" * 48, "===" + "a" * 47, "=====" + "a" * 95]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in edge], "t string").select(T.math_dense(F.col("t"))).collect()]
    assert got == [False, True, False, True, False]


@pytest.mark.parametrize(("raw", "want"), [("Figure 2: Teleportation\nprotocol", "Figure 2: Teleportationprotocol"), ("a ... b", "a b"), ("U†|ψ⟩", "U^dag|psi>"), ("𝐇 ⊗ 𝐗", "H (x) X"), (None, ""), ("", "")])
def test_clean(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(T.clean_text(F.col("t"))).first()[0] == want


def test_mining(spark):
    row = [("Fig. 1. Quantum circuit for Grover search", "H X CNOT |0>", "")]
    df = spark.createDataFrame(row, "c string, i string, x string")
    assert M.with_gates(df, F.col("i"), F.concat_ws(" ", "c", "i")).first()["gates"] == ["Basis State", "CNOT", "Hadamard", "Pauli-X"]
    both = M.with_gates(spark.createDataFrame([("controlled-not", ""), (None, None)], "c string, i string"), F.col("i"), F.col("c")).collect()
    assert [r["gates"] for r in both] == [["Controlled-NOT", "controlled-NOT"], []]
    cases = [("A short note", "", "Shor"), ("", "circuit for multi-qubit parity checks on chips", "Multi-Qubit Parity Checks On"), ("", "solving the hidden subgroup problem", "Solving The Hidden Subgroup Problem"), ("", "nothing here", "Unknown"), (None, None, "Unknown")]
    got = M.with_problem(spark.createDataFrame(cases, "title string, t string, want string"), F.col("t"), F.col("title")).collect()
    assert all(r["problem"] == r["want"] for r in got), got


def test_title_case_and_two_decimals_like_python(spark):
    texts = ["multi-qubit parity", "3d maps", "don't", "über öl", "a_b c", "", "x" * 3000]
    assert [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.title_case(F.col("t"))).collect()] == [t.title() for t in texts]
    numbers = [i / 1000 for i in range(1001)] + [i / 8 for i in range(8)] + [float(x) for x in np.random.default_rng(1).random(500)]
    assert [r[0] for r in spark.createDataFrame([(x,) for x in numbers], "p double").select(C.two_decimals(F.col("p"))).collect()] == [f"{x:.2f}" for x in numbers]


def test_reasons(spark):
    cases = [
        ("Fig. 1. Quantum circuit for Grover search", "H X CNOT |0⟩", 0.9, ["GatesIn:3", "StrongCircuitKW", "BERTStrong:0.90"]),
        ("Figure 8: circuit diagram", "", 0.125, ["StrongCircuitKW", "BERTNegative:0.12"]), ("Figure 8: circuit diagram", "", 0.22, ["StrongCircuitKW", "HighKeywordScore_But_VisualsFail"]),
        ("Figure 9: schematic", "H", 0.30, ["GatesIn:1", "WeakDiagramKW", "Score2_But_BERT_Low"]), ("Figure 10", "H", 0.35, ["GatesIn:1", "LonelyGate_RejectedByBERT"]),
        ("Figure 10", "H", 0.45, ["GatesIn:1", "BERTWeak:0.45", "Score2"]), ("Figure 13", "x", 0.36, ["GatesIn:1", "LonelyGate_ConfirmedByBERT"]),
        ("Figure 11: accuracy per qubit", "", 0.93, ["BERTStrong:0.93", "PlotEvalKW", "QubitsNoGates", "BERT_Rescue"]), ("Figure 2: polytope and simplex", "", 0.7, ["BERTMedium:0.70", "StateViz:2"]),
        ("Figure 4", "0 1 2 3 a", 0.9, ["HardVeto:NumericDensity(Plot/Table)"]),
    ]
    df = spark.createDataFrame([(i, c, t, None, p) for i, (c, t, p, _) in enumerate(cases)], "i int, caption_text string, figure_content_text string, referencing_context string, bert_circuit_prob double")
    for r in C.classify(df).collect():
        assert r["reasons"] == [x for x in cases[r["i"]][3] if x != "Score2"], r


def test_upsert_last_wins(spark):
    make = lambda rows: spark.createDataFrame(rows, "filename string, n int, at int")
    got = M.upsert(make([("a", 1, 9), ("b", 2, 1)]), make([("b", 3, 1), ("b", 4, 2), ("b", 5, None), ("c", 6, 1), (None, 7, 1)]), ["at", "n"])
    assert sorted((r["filename"], r["n"]) for r in got.collect()) == [("a", 1), ("b", 4), ("c", 6)]
    assert M.upsert(make([("a", 1, 9)]), make([]), ["at"]).count() == 1


def test_pipeline_with_rasters_and_renderer(spark):
    blocks = spark.createDataFrame([("2001.00001", 1, i, i, (50.0, y, 300.0, y + 10), t) for i, (y, t) in enumerate([(20.0, "A title of some length"), (400.0, "Fig. 1. Quantum circuit for Grover search"), (250.0, "H X CNOT |0⟩")])],
                                   f"arxiv_id string, page_num int, block_id int, block_key long, bbox {G.BOX}, text string")
    pages = spark.createDataFrame([("2001.00001", 1, "text", [], [(60.0, 200.0, 290.0, 380.0)])], f"arxiv_id string, page_num int, page_text string, vector_clusters array<{G.BOX}>, rasters array<{G.BOX}>")
    got = pipeline.run(blocks, pages).collect()
    assert len(got) == 1 and got[0]["quantum_problem"] == "Grover" and "CNOT" in got[0]["quantum_gates"]
    assert pipeline.run(blocks, pages.drop("rasters")).count() == 0
    for size, n in ((3000, 1), (10, 0)):
        assert pipeline.run(blocks, pages, renderer=lambda path, page, box, zoom, size=size: b"x" * size).count() == n
    titled = pages.withColumns({"paper": F.col("arxiv_id"), "title": F.lit("Own title")})
    assert K.titles(titled).first()["title"] == "Own title"


def test_boxes_and_names(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    box = F.struct(*(F.lit(v).alias(n) for n, v in zip(("x0", "y0", "x1", "y1"), (20.0, 5.0, 608.0, 790.0), strict=True)))
    assert tuple(one(P.pad_box(box, F.lit(612.0)))) == (0.0, 0.0, 612.0, 800.0)
    assert one(P.visual_check(F.lit(99), F.lit(200), F.lit(0)))["reason"].startswith("Too small")
    assert one(P.visual_check(F.lit(600), F.lit(100), F.lit(5000)))["reason"] == "Rejected: Extreme aspect ratio (Wide Strip: 6.0)"
    assert one(M.file_name(F.lit("quant-ph/9733123"), F.lit(3), F.lit(0))) == "quantph_quant-ph9733123_p3_f0.png"
    assert [one(paper(F.lit(x))) for x in ("ARXIV: 2502.98617v3", " quant-ph/9883115v4 ", "2511.65094.pdf", " ", "Odd")] == ["2502.98617", "quant-ph/9883115", "2511.65094", None, "odd"]
    assert abs(one(ml.positive_probability(F.lit(0.0), F.lit(0.0))) - 0.5) < 1e-12


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 200)] * 2, st.integers(1, 30), st.integers(1, 30)), min_size=1, max_size=14), st.randoms())
def test_closure_order_free(raw, rnd):
    boxes = np.array([(x, y, x + w, y + h) for x, y, w, h in raw], float)
    a = G.closure(boxes)
    order = list(range(len(boxes)))
    rnd.shuffle(order)
    assert np.array_equal(a, G.closure(boxes[order]))
    assert np.array_equal(a, G.closure(a))
    for i in range(len(a)):
        for j in range(i):
            assert max(max(a[i][0], a[j][0]) - min(a[i][2], a[j][2]), max(a[i][1], a[j][1]) - min(a[i][3], a[j][3])) >= 15


def test_gap_merge_equals_fold(spark):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for key in range(40):
        parts = [(float(y), float(y + h)) for y, h in zip(rng.integers(0, 900, 6), rng.integers(1, 120, 6), strict=True)]
        rows += [(key, i, (0.0, a, 10.0, b), "vector" if i % 2 else "raster") for i, (a, b) in enumerate(parts)]
        ordered = sorted(enumerate(parts), key=lambda x: (-x[1][1], x[0]))
        top, n = ordered[0][1][0], 1
        for _, (a, b) in ordered[1:]:
            if top - b >= 150:
                break
            top, n = min(top, a), n + 1
        want[key] = (top, n)
    df = spark.createDataFrame(rows, f"caption_key int, pos int, box {G.BOX}, kind string")
    assert {r["caption_key"]: (r["box"]["y0"], r["parts"]) for r in G.merge_upwards(df).collect()} == want


def test_context_and_span(spark):
    df = spark.createDataFrame([("x" * 300 + "Fig. 12" + "y" * 10, "1"), ("Figure 3\nnow. Fig. 3", "3"), ("none", "1"), (None, "1")], "page string, n string")
    context, span = K.context_of(F.col("page"), F.col("n"))
    got = df.select(context.alias("c"), span.alias("s")).collect()
    assert got[0]["s"] == (50, 317) and got[0]["c"].endswith("Fig. 12" + "y" * 10)
    assert got[1]["c"] == "Figure 3 now. Fig. 3" and got[2]["c"] == "" and got[2]["s"] == (-1, -1) and got[3]["s"] == (-1, -1)
    spans = spark.createDataFrame([("b", "abc"), ("z", "abc"), (None, "abc"), ("", "abc")], "a string, b string").select(K.span_of(F.col("a"), F.col("b")).alias("s")).collect()
    assert [tuple(r["s"]) for r in spans] == [(1, 2), (-1, -1), (-1, -1), (-1, -1)]


def test_state(spark):
    queue = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a"), (3, "c")], "pos long, paper string")
    progress = spark.createDataFrame([("a", 3, 1), ("a", None, 0), ("c", None, 5), ("zz", 9, 1)], "paper string, fig_count int, logged_at int")
    status = S.with_status(queue, progress)
    assert sorted((r["pos"], r["fig_count"]) for r in status.collect()) == [(0, 3), (1, None), (2, 3), (3, None)]
    assert [r["paper"] for r in S.claim(status, 1).collect()] == ["b"]
    assert S.total_collected(status).first()["total"] == 3
    assert S.total_collected(status.limit(0)).first()["total"] == 0
    done = S.merge_counts(status, spark.createDataFrame([("b", 0)], "paper string, fig_count int"))
    assert {r["paper"]: r["fig_count"] for r in done.collect()} == {"a": 3, "b": 0, "c": None}
    counts = spark.createDataFrame([(i, 100) for i in range(2500)], "pos long, n int")
    assert sorted(r["pos"] for r in S.within_target(counts).collect()) == [0, 1, 2]


def test_split_weights_metrics(spark):
    rows = spark.createDataFrame([(i, "t", i % 3 == 0) for i in range(300)], "id long, text string, l boolean").withColumn("label", F.col("l").cast("int"))
    split = ml.stratified_split(rows, "id")
    assert {(r["label"], r["is_test"]): r["count"] for r in split.groupBy("label", "is_test").count().collect()} == {(1, True): 20, (1, False): 80, (0, True): 40, (0, False): 160}
    assert ml.class_weights(rows).first()["weight"] == 2.0
    m = ml.binary_metrics(rows, F.col("label"), F.col("label")).first()
    assert m["accuracy"] == 1.0 and m["f1"] == 1.0
    text = spark.createDataFrame([("good circuit", 1), ("bad plot", 0)] * 20, "text string, label int")
    scored = ml.model_scorer(ml.train_scorer(text, 256, 5))(spark.createDataFrame([("good circuit",), ("bad plot",)], "c string"), F.col("c")).collect()
    assert scored[0]["p"] > 0.5 > scored[1]["p"]


def test_saved_scorer_and_loss(spark, tmp_path):
    text = spark.createDataFrame([("good circuit", 1), ("bad plot", 0)] * 20, "text string, label int")
    model, new = ml.train_scorer(text, 256, 5), spark.createDataFrame([("good circuit",), (None,)], "c string")
    writers.save_model(model, str(tmp_path / "model"))
    ask = lambda s: [r["p"] for r in s(new, F.col("c")).collect()]
    assert ask(ml.load_scorer(str(tmp_path / "model"))) == ask(ml.model_scorer(model))
    assert ask(ml.load_scorer(str(tmp_path / "none"))) == [0.0, 0.0]
    rows = spark.createDataFrame([(1, 0.5), (0, 0.25), (None, 0.5), (1, None), (0, float("nan")), (1, 0.0)], "label int, p double")
    got = ml.mean_loss(rows, F.col("label"), F.col("p"), 3.0).first()
    want = (3 * -np.log(0.5) - np.log(0.75) + 3 * -np.log(1e-7)) / 7
    assert got["n"] == 3 and abs(got["loss"] - want) < 1e-9
    assert ml.mean_loss(rows.limit(0), F.col("label"), F.col("p")).first()["n"] == 0


def test_files(spark, tmp_path):
    (tmp_path / "list.txt").write_text("arXiv:2403.00001\n\n 2403.00002 \n")
    queue = readers.read_paper_list(spark, str(tmp_path / "list.txt"))
    assert [r["paper"] for r in queue.orderBy("pos").collect()] == ["2403.00001", "2403.00002"]
    (tmp_path / "p.csv").write_text("arxiv_id,count\n2403.00001,4\n2403.00002,\n")
    assert {r["paper"]: r["fig_count"] for r in readers.read_progress(spark, str(tmp_path / "p.csv")).collect()} == {"2403.00001": 4, "2403.00002": None}
    writers.write_progress(spark.createDataFrame([(0, "a", 3), (1, "b", None)], "pos long, paper string, fig_count int"), str(tmp_path / "out"), one_file=True)
    text = "".join(f.read_text() for f in (tmp_path / "out").glob("*.csv"))
    assert text.split() == ["arxiv_id,count", "a,3", "b,"]
    n = writers.write_images(spark.createDataFrame([("a.png", bytearray(b"x")), ("b.png", None)], "filename string, image_bytes binary"), str(tmp_path / "img"))
    assert n == 1 and (tmp_path / "img" / "a.png").read_bytes() == b"x"


def test_fetch():
    waits, answers = [], iter([(500, b""), (200, b"%PDF-1")])
    assert readers.fetch("u", get=lambda u: next(answers), sleep=waits.append) == b"%PDF-1" and waits == [2.0, 2.0]
    assert readers.fetch("u", get=lambda u: (404, b""), sleep=waits.append) is None
    assert readers.fetch("u", get=lambda u: (200, b"<html>"), sleep=waits.append) is None


def test_unprintable_like_python():
    import re

    pattern = re.compile("[     -   　]")
    for c in map(chr, range(0x20, 0x600)):
        gone = unicodedata.category(c) in ("Cc", "Cf", "Cs", "Co") or bool(pattern.match(c))
        assert gone == (not c.isprintable()) or unicodedata.category(c) == "Cn", hex(ord(c))
