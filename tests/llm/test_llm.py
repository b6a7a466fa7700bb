"""The training-data operators against brute force, round trips and planted cases."""

import random
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwarp.llm import canonical, capping, components, glyphs, mixing, packing, scans, splits, subjects
from inkwarp.llm.tokens import encoding, token_count


# --- P5 ---
def test_unify_known_forms():
    cases = {"ｆull ｗidth": "full width", "𝐛old": "bold", "caf" + "é": "café", "а​bс": "abc", "a b c": "a b c", "Å µ": "Å μ", "ﬁne": "fine", "СΧ": "CX", "ψ⊗φ ¬ ⟩ † — naïve": "ψ⊗φ ¬ ⟩ † — naïve", "жук": "жук", "ν eνen": "ν even"}
    got, flags = glyphs.unify_arrow(pa.array([*cases, None, ""]))
    assert got.to_pylist() == [*cases.values(), None, ""]
    assert flags.tolist() == [a != b for a, b in cases.items()] + [False, False]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aé́̈ｅ𝐞оΑ​  ﬁжψ", max_size=12)), max_size=6), st.integers(0, 3))
def test_unify_is_stable_and_per_row(texts, skip):
    column = pa.array(texts, pa.string())
    once, changed = glyphs.unify_arrow(column)
    twice, again = glyphs.unify_arrow(once)
    assert twice.to_pylist() == once.to_pylist() and not again.any()
    assert [a != b for a, b in zip(texts, once.to_pylist(), strict=True)] == changed.tolist()
    assert glyphs.unify_arrow(column.slice(skip))[0].to_pylist() == once.to_pylist()[skip:]
    for t in texts:
        assert t is None or glyphs.unify_list([t]) == [once.to_pylist()[texts.index(t)]]
        assert t is None or unicodedata.is_normalized("NFC", glyphs.unify_list([t])[0]) or any(unicodedata.combining(c) for c in t)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aeoqǘệêạ한글가각" + "\u0301\u0302\u0323\u0327\u0308\u0304\u1100\u1161\u11a8\u0345", max_size=14), st.randoms())
def test_unify_canonically_equal(x, rnd):
    """However its marks are composed or ordered, a text comes out as its composed form."""
    want = unicodedata.normalize("NFC", x)
    apart = unicodedata.normalize("NFD", x)
    shuffled, run = [], []
    for c in [*apart, "."]:
        if unicodedata.combining(c):
            run.append(c)
        else:
            # Marks of one class keep their order, as another order says something else.
            order = sorted(range(len(run)), key=lambda i: rnd.random())
            by_class = {k: iter([c for c in run if unicodedata.combining(c) == k]) for k in map(unicodedata.combining, run)}
            shuffled += [next(by_class[unicodedata.combining(run[i])]) for i in order]
            shuffled.append(c)
            run = []
    assert glyphs.unify_list([x, apart, want, "".join(shuffled[:-1])]) == [want] * 4


def test_unify_spark(spark):
    df = spark.createDataFrame([(1, "ａ" * 50_000, "x"), (2, None, ""), (3, "plain", "ｅ")], "candidate_id long, a string, b string")
    assert {tuple(r) for r in glyphs.changed_fields(df, "candidate_id", ["a", "b"]).collect()} == {(1, "a"), (3, "b")}
    assert glyphs.changed_fields(df.limit(0), "candidate_id", ["a", "b"]).count() == 0


# --- P2 ---
def test_capping_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["hot"] * 6 + ["a", "b", "c", None]), rng.choice([None, float("nan"), 1.0, 2.0, 2.5, -1e308, float("inf")]), rng.choice([None, 0.0, 0.5, 0.5])) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, g string, s double, p double").withColumn("n", F.lit(1)).withColumn("lo", F.lit(2))
    low = lambda v: -np.inf if v is None or v != v else v
    for cap in (1, 7, 1000):
        want = set()
        for g in ("hot", "a", "b", "c"):
            mine = sorted((r for r in rows if r[1] == g), key=lambda r: (-low(r[2]), -low(r[3]), r[0]))
            want |= {r[0] for r in mine[cap:]}
        assert {r[0] for r in capping.over_cap(df, F.col("g"), "id", ["s", "p"], cap=cap, mids=4).collect()} == want
    kept = capping.cap_rows(df.filter("g is not null"), F.col("g"), "id", ["s"], cap=None, share=0.4)
    top = kept.groupBy("g").count().agg(F.max("count")).first()[0]
    assert top <= 0.4 * kept.count()
    assert capping.over_cap(df.limit(0), F.col("g"), "id", ["s"]).count() == 0


# --- P1 ---
def test_canonical(spark):
    ref = spark.createDataFrame([(1, "gate", "Pauli-X", ["NOT gate"]), (2, "gate", "Controlled-Phase", None), (3, "gate", "Reset", []), (4, "problem", "Order Finding", ["Period Finding"]), (5, "gate", "Superposition State", [])], "ref_id int, kind string, term string, aliases array<string>")
    values = ["pauli-x", "Cntrolled-Phhase", "the Pauli-X", "the Reset", "the Controlled-Phase", "the superposition state", "Super. State", "State of superposition", "not GATE", "Mach Box", "???", "", None, "x" * 5000]
    df = spark.createDataFrame([("gate", v) for v in values] + [("problem", "Finding, order"), ("problem", "Pauli-X")], "kind string, value string")
    got = {(r["kind"], r["value"]): r["ref_id"] for r in canonical.map_to_reference(df, ref).collect()}
    want = [1, 2, 1, 3, 2, 5, 5, 5, 1, -1, -1]
    assert [got["gate", v] for v in values[:11]] == want
    assert got["gate", "x" * 5000] == -1 and ("gate", "") not in got and len(got) == 14
    assert got["problem", "Finding, order"] == 4 and got["problem", "Pauli-X"] == -1
    assert {r["ref_id"] for r in canonical.map_to_reference(df, ref.limit(0)).collect()} == {-1}


def test_canonical_additions(spark):
    """Additions of any length come off, rare ones where what is left is exactly an entry; a closer entry goes first."""
    ref = spark.createDataFrame([(1, "gate", "SWAP", []), (2, "gate", "Fermionic Swap", []), (3, "gate", "Phase Shift", [])], "ref_id int, kind string, term string, aliases array<string>")
    want = {"one very long and rambling introduction to the phase shift in seven acts": 3, "Phase Shift (2 qubits)": 3, "Ferminoic Swap": 2, "phase box": -1, "swap of the phase": -1, "word " * 400 + "swap": 1, "word " * 400: -1}
    got = {r["value"]: r["ref_id"] for r in canonical.map_to_reference(spark.createDataFrame([("gate", v) for v in want], "kind string, value string"), ref).collect()}
    assert got == want


def test_similar_forms_brute_force(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))) for _ in range(120)]
    left, right = words[:80], words[60:]
    make = lambda w: spark.createDataFrame([("k", x) for x in w], "kind string, form string")
    tok = lambda w: {f"^{w}$"[i : i + 2] for i in range(len(w) + 1)}
    for t in (0.25, 0.6):
        got = {(r["l"], r["r"]) for r in canonical.similar_forms(make(left), make(right), t).collect()}
        want = {(a, b) for a in left for b in right if len(tok(a) & tok(b)) / len(tok(a) | tok(b)) >= t}
        assert got == want


def test_edits():
    assert canonical.osa("measurement", "masurmeent", 3) == 2 and canonical.osa("abc", "xyz", 1) == 2


# --- P3 ---
def test_components_brute_force(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(200, i) for i in range(300, 400)] + [(i, i + 1) for i in range(500, 540)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in links:
        parent[find(a)] = find(b)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame([(str(a), str(b)) for a, b in links] + [(None, "1")], "a string, b string")).collect()}
    assert len(got) == len(parent)
    same = {(int(n), find(int(n))) for n in got}
    assert len({(got[str(n)], r) for n, r in same}) == len(set(got.values())) == len({r for _, r in same})


CAPTION = "Fig. {}: Wiring of the {} with 12 inputs; the interleaved ansatz corrects the phase information after the first round. Arrows tell which rotation the low-depth schedule verifies at round {}."


def test_same_captions(spark):
    base = CAPTION.format(1, "lookup table", 12)
    variants = [
        base, base.replace("Fig. 1:", "FIGURE 33."), base.replace("corrects", "corr-\nects").upper(), base.replace("phase", "phasc").replace("round", "rouncl"), base.replace("inputs", "ｉnputs"),
        base.replace("interleaved", "modified").replace("12.", "13."), base + " Adapted from our companion paper.", base.replace("after the", "after\n- 4 -\nthe"),
    ]
    other = [CAPTION.format(2, "fan-out gadget", 99).replace("interleaved", "sparse").replace("corrects", "rotates"), "Fig. 1", "", None]
    rows = [(i, f"2001.0000{i}", c) for i, c in enumerate(variants)] + [(20 + i, f"2002.0000{i}", c) for i, c in enumerate(other)]
    figs = spark.createDataFrame(rows, "candidate_id long, arxiv_id string, caption_text string")
    labels = spark.createDataFrame([(100 + r[0], r[0], r[0] % 2) for r in rows] + [(1, None, 1), (2, 777, 0)], "label_id long, candidate_id long, label int")
    got = {r["label_id"]: r["group_paper"] for r in splits.spanning_groups(labels, figs).collect()}
    assert got == {100 + i: "2001.00000" for i in range(len(variants))}
    assert splits.spanning_groups(labels.limit(0), figs).count() == 0


def _same(a, b):
    return any((x or y) and len(u) == len(v) and sum(p != q for p, q in zip(u, v, strict=True)) <= splits.allowed(len(u)) for u, x in splits.forms(a) for v, y in splits.forms(b))


def test_same_texts_brute_force(spark):
    """All links between texts of 3 to 60 words, however many share a key; the closure is that of all pairs compared."""
    rng = random.Random(8)
    word = [f"{a}{b}{c}" for a in "kvxz" for b in "yx" for c in "kvyz"]
    texts = []
    for n in (3, 4, 5, 7, 9, 10, 12, 15, 20, 33, 60):
        for _ in range(4):
            base = [rng.choice(word) for _ in range(n)]
            texts.append(" ".join(base))
            for changes in (1, 1, 2, 2, 3, 3):
                other = list(base)
                for i in rng.sample(range(n), min(changes, n)):
                    other[i] = rng.choice(word) + "w"
                texts.append(" ".join(other))
            texts += [" ".join(base) + ". Kxv zyk vyz.", " ".join(base) + ". " + " ".join(["Xyk"] * 11), " ".join(base[: n // 2]) + "\nVxz kyv\n" + " ".join(base[n // 2 :])]
    texts += ["kyk vyv xyx zyz kxk vxv xxx zxz " + f"run{i}" + " kyv vyk" for i in range(60)]  # one hot key: all but a word alike
    parent = list(range(len(texts)))
    find = lambda i: i if parent[i] == i else find(parent[i])
    for i in range(len(texts)):
        for j in range(i):
            if find(i) != find(j) and _same(texts[i], texts[j]):
                parent[find(i)] = find(j)
    df = spark.createDataFrame([(i, f"e{i}", t) for i, t in enumerate(texts)], "key long, entity string, text string")
    for most in (splits.PAIRS, 2):
        root = {r["key"]: r["root"] for r in splits.group_records(df, "key", F.col("entity"), F.col("text"), most).collect()}
        pairs = {(root[i], find(i)) for i in range(len(texts))}
        assert len(pairs) == len(set(root.values())) == len({find(i) for i in range(len(texts))})


def test_damaged_words_and_lines_do_not_count(spark):
    base = "the quick register folds into nine copies of a box\nand waits in the frame"
    assert _same(base, "the quick register folds into nine\nPage 7\ncopies of a box and waits in thc fraine".replace("fraine", "frarne"))
    assert _same("Wiring of the box\nand waits in the frame", "Wiring of the box\nDrift and Echo, Vol. 7\nand waits in the frame")
    assert not _same("Wiring of the box.\nHere it denotes the input of\nthe frame", "Wiring of the box.\nthe frame")
    assert list(splits.forms("Fig. 3")) == list(splits.forms("")) == []
    assert _same("wiring of the wide box in a narrow\nframe of nine copies", "wiring of the wide box in a narrow\ndrift and echo\nframe of nine copies")
    assert len(list(splits.forms("\n".join(["some words of a long text that goes on and on"] * 400)))) < 50
    assert not _same("the adder folds into nine copies of a box today", "the ladder unfolds into ten copies of a box today")


def test_short_captions_group_if_they_are_the_same(spark):
    texts = ["Figure 1: Toffoli gate", "Fig. 7. TOFFOLI  gate.", "Figure 2: Toffoli box", "Figure 3", "Fig. 9", None]
    rows = [(i, f"2001.0000{i}", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "key long, entity string, text string")
    root = {r["key"]: r["root"] for r in splits.group_records(df, "key", F.col("entity"), F.col("text")).collect()}
    assert root[0] == root[1] and len(set(root.values())) == 5


def test_splits_keep_groups(spark):
    rng = random.Random(4)
    rows = [(i, f"g{0 if i < 300 else rng.randint(1, 200)}", rng.choice([0, 1, None])) for i in range(1000)]
    out = splits.assign_splits(spark.createDataFrame(rows, "label_id long, root string, label int")).toPandas()
    assert len(out) == 1000 and out.groupby("root").split.nunique().max() == 1
    share = out.split.value_counts(normalize=True)
    assert abs(share["train"] - 0.8) < 0.05 and abs(share["test"] - 0.1) < 0.05
    assert (out.dropna().groupby("split").label.nunique() == 2).all()


# --- P4 ---
def _lexicon():
    words = "the proof proceeds by induction over register starting from controlled phase measurement box noise-aware prepare round qubits with multi-controlled".split()
    return scans.Lexicon({w: 500 for w in words} | {"repeat": 900}, 10_000)


def test_scan_pieces():
    lex = _lexicon()
    form = {scans.header_key("Notes on the sparse encoder")}
    mend = lambda t, lined=True, page=7, y0=100.0: scans.mend(t, lined, page, form, y0, lex)
    assert mend("The proof proce-\neds by induction") == ("The proof proceeds by induction", {"break"})
    assert mend("noise-\naware register") == ("noise-aware register", set())
    assert mend("prepa¬\nre the register") == ("prepare the register", {"break"})
    assert mend("tbe rcgister wifh qu6its") == ("the register with qubits", {"misread"})
    assert mend("The proof proceeds by\nNotes on the sparse encoder   7\ninduction") == ("The proof proceeds by induction", {"header", "folio"})
    assert mend("over the\n- 7 -\nregister") == ("over the register", {"folio"})
    assert mend("over the\n- 8 -\nregister")[1] == set()
    assert mend("the proof Notes on the sparse encoder proceeds - 7 - by induction", lined=False) == ("the proof proceeds by induction", {"header", "folio"})
    assert mend("Notes on the sparse encoder", y0=30.0)[1] == {"header"} and mend("Notes on the sparse encoder", y0=75.0)[1] == set()
    assert mend("7", y0=762.0)[1] == {"folio"} and mend("7", y0=300.0)[1] == set()
    assert mend("one\n\ntwo") == ("one\n\ntwo", set()) and mend("", page=None) == ("", set())


def test_scans_spark(spark):
    sentence = "The proof proceeds by induction over the register starting from the controlled phase."
    figs = [(i, "2001.00001", 3, sentence, None, "") for i in range(30)] + [(99, None, None, sentence.replace("proof", "pr0of"), "over the reg- ister", None)]
    df = spark.createDataFrame(figs, "candidate_id long, arxiv_id string, page_num int, caption_text string, referencing_context string, figure_content_text string")
    blocks = spark.createDataFrame([(1, "2001.00001", 3, 0, (0.0, 30.0, 9.0, 42.0), "A. Nobody et al. — The register"), (2, "2001.00001", 3, 1, None, None)], "block_key long, arxiv_id string, page_num int, block_id int, bbox struct<x0:double,y0:double,x1:double,y1:double>, text string")
    got = {tuple(r) for r in scans.damaged_fields(df, blocks).collect()}
    assert got == {("figure_candidates", 99, "caption_text", "misread"), ("figure_candidates", 99, "referencing_context", "break"), ("text_blocks", 1, "text", "header")}
    assert scans.damaged_fields(df.limit(0), blocks.limit(0)).count() == 0


def test_frequent_and_long_forms_are_searched_to_full_depth():
    lex = scans.Lexicon({"charm": 100_000, "cborm": 200}, 10_000_000)
    assert lex.links("cborm") == ["charm"]
    word = "inconsistentialisationalities" * 3
    read = word[:-7] + word[-7:].replace("a", "o").replace("l", "1").replace("t", "f")
    assert scans.Lexicon({word: 100}, 10_000_000).links(read) == [word]


def test_glyph_key_survives_misreading():
    assert all(scans.glyph_key(a) == scans.glyph_key(b) for a, b in scans.MISREAD)


def test_rare_words_are_known_at_any_size(spark):
    """Words far under the broadcast share are repaired and joined as with all words at hand."""
    many = "the gate and the register of the box " * 20
    figs = [(i, "2001.00001", 3, many, None, None) for i in range(60)] + [(100 + i, "2001.00001", 3, "a bidirectional thermostat and the broadband counter with a band width", None, None) for i in range(12)]
    figs += [(200, None, None, "a bidirectional thermosfat and the broadband counter", "the thermo- stat and the broad- band gate", "bidi- rec- tional register")]
    df = spark.createDataFrame(figs, "candidate_id long, arxiv_id string, page_num int, caption_text string, referencing_context string, figure_content_text string")
    blocks = spark.createDataFrame([], "block_key long, arxiv_id string, page_num int, block_id int, bbox struct<x0:double,y0:double,x1:double,y1:double>, text string")
    of = lambda **x: sorted((r["row_id"], r["field_name"], r["repaired"], tuple(r["damage"])) for r in scans.mended(df, blocks, **x).collect())
    got = of(words=5, common=5e-2)
    assert [x[1:] for x in got if x[0] == 200] == [
        ("caption_text", "a bidirectional thermostat and the broadband counter", ("misread",)), ("figure_content_text", "bidirectional register", ("break",)), ("referencing_context", "the thermostat and the broadband gate", ("break",)),
    ]
    assert got == of()


def test_neighbours_decide_what_is_misread(spark):
    """A genuine word a glyph edit from a commoner one is left; the same edit in the commoner word's place is not."""
    rng = random.Random(5)
    pick = lambda words: rng.choice(words.split())
    rows = [f"the {pick('gate phase box')} and {pick('qubit register')} of the {pick('proof code')}" for _ in range(4000)]
    rows += [f"hot {pick('dry sandy')} arid {pick('desert climate')} with rain" for _ in range(600)]
    lex = scans.learn(spark.createDataFrame([(r,) for r in rows], "text string"))
    assert lex.links("arid") == ["and"]
    assert scans.correct_words("hot dry arid desert with rain", lex) == ("hot dry arid desert with rain", False)
    assert scans.correct_words("the gate arid qubit of the proof", lex) == ("the gate and qubit of the proof", True)
    assert scans.correct_words("the phose and register of the code", lex) == ("the phase and register of the code", True)


def test_every_known_word_has_a_vector(spark):
    """However many words and contexts there are."""
    word = lambda i: "".join(chr(97 + int(c)) for c in f"{i:05}")
    lex = scans.learn(spark.createDataFrame([(" ".join(word(i) for i in range(k, 1200)) + " " + " ".join(word(i) for i in range(k)),) for k in range(6)], "text string"))
    assert len(lex.counts) == 1200 and all(w in lex.vectors[2] for w in lex.counts)
    lex = scans.learn(spark.createDataFrame([(" ".join(f"the {word(i)}" for i in range(k, 21000, 7)),) for k in range(7)] * 5, "text string"))
    assert len(lex.counts) == 21001 and all(w in lex.vectors[0] for w in lex.counts)
    assert np.isfinite(lex.vectors[1]).all() and np.abs(lex.vectors[1]).max() > 0.2


def test_rare_words_stand_beside_numbers(spark):
    """A number after a word of few uses that numbers follow is no page number; after another it is one."""
    rows = [("the gate and the register of the box " * 100,)] * 700 + [(f"so by corollary {i} of the proof and by duality of the box",) for i in range(8)]
    lex = scans.learn(spark.createDataFrame(rows, "text string"))
    assert lex.counts["corollary"] < scans.CENTER * lex.total
    mend = lambda t: scans.mend(t, False, 7, set(), None, lex)[1]
    assert mend("so by corollary 7 of the proof") == set() and mend("so by duality 7 of the proof") == {"folio"}


def test_vectors_learned_by_the_workers_are_those_of_the_driver(spark, monkeypatch):
    rng = random.Random(5)
    rows = [" ".join(rng.choice("the gate phase box and qubit register of proof code theorem 3".split()) for _ in range(12)) for _ in range(300)]
    figs = [(i, "2001.00001", 3, r, None, None) for i, r in enumerate(rows)]
    figs += [(1000 + i, "2001.00001", 3, "hot arid desert with a lemma 3 of rain", "hot arid desert the boundary condition", None) for i in range(12)]
    figs += [(1500, None, 3, "alone/alone/alone alone/alone/alone", None, None)]
    figs += [(2000, None, 7, "hot arid desert", "the boundory gate by lemma 7 of boun- dary and by rain 7 hot code", None)]
    df = spark.createDataFrame(figs, "candidate_id long, arxiv_id string, page_num int, caption_text string, referencing_context string, figure_content_text string")
    blocks = spark.createDataFrame([], "block_key long, arxiv_id string, page_num int, block_id int, bbox struct<x0:double,y0:double,x1:double,y1:double>, text string")
    texts = scans.corpus(df, blocks)
    of = lambda **x: sorted((r["row_id"], r["field_name"], r["repaired"], tuple(r["damage"])) for r in scans.mended(df, blocks, **x).collect())
    here, got = scans.learn(texts), of()
    assert [x[2:] for x in got if x[0] == 2000] == [("hot arid desert", ()), ("the boundary gate by lemma 7 of boundary and by rain hot code", ("break", "folio", "misread"))]
    monkeypatch.setattr(scans, "CELLS", 0)
    there = scans.learn(texts)
    rows, center, columns, context = here.vectors
    assert set(there.vectors[0]) == set(rows) and there.vectors[2] == columns and np.allclose(there.vectors[3], context, atol=1e-2)
    assert all(np.allclose(there.vectors[1][i], center[rows[w]], atol=1e-2) for w, i in there.vectors[0].items())
    assert all({w: x for w, x in a.items() if x} == {w: x for w, x in b.items() if x} for a, b in zip(here.beside, there.beside, strict=True))
    assert of(words=5, common=5e-2) == got


def test_skip_gram_groups_like_words():
    counts = np.zeros((4, 4), np.float32)
    counts[:2, :2] = 50
    counts[2:, 2:] = 50
    w, x = scans.skip_gram(counts, dims=4)
    assert (w[0] @ x[1]) > (w[0] @ x[3])


# --- P6 ---
def test_bounds_are_optimal():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 5, 9)
    counts[0] = 0
    sizes = [i for i in range(9) if counts[i]]
    cost = lambda bounds: sum(counts[s] * (min(b for b in bounds if b >= s) - s) for s in sizes)
    from itertools import combinations

    for k in (1, 2, 3):
        best = min(cost((*c, sizes[-1])) for c in combinations(sizes[:-1], k - 1))
        assert cost(packing.bucket_bounds(counts, k)) == best


def test_packing(spark):
    rng = random.Random(3)
    sizes = [rng.choice([1, 5, 5, 5, 40, 99, 100, 101, 250, 0]) for _ in range(900)] + [None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id long, n long")
    p = packing.pack(df, "doc_id", F.col("n"), capacity=100, buckets=4).toPandas()
    assert p.groupby("container").tokens.sum().max() <= 100
    assert p.groupby("doc_id").tokens.sum().to_dict() == {i: n for i, n in enumerate(sizes) if n}
    assert not p.duplicated(["doc_id", "part"]).any()
    assert set(p[p.parts > 1].doc_id) == {i for i, n in enumerate(sizes) if n and n > 100}
    used = p.tokens.sum()
    assert p.container.nunique() <= used / 100 * 1.15 + 1
    assert packing.pack(df.limit(0), "doc_id", F.col("n")).count() == 0


def test_tokens_round_trip(spark):
    texts = ["", "Zwei Qubits – naïve ψ⊗φ", "a b\n\n c" * 50, None]
    own = encoding("/opt/tokenizers/byte_bpe_50k.tiktoken")
    assert all(own.decode(own.encode_ordinary(t)) == t for t in texts if t is not None)
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(token_count(F.col("t"))).collect()]
    assert got == [None if t is None else len(own.encode_ordinary(t)) for t in texts]


# --- P7 ---
def test_mixing(spark):
    rng = random.Random(9)
    docs = [(i, rng.choice(["big"] * 8 + ["Small", " small", "other", None]), rng.randint(1, 50)) for i in range(2000)] + [(9999, "big", 4000), (10000, "big", None)]
    df = spark.createDataFrame(docs, "doc_id long, source string, n long")
    goal = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 3), ("ghost", 0.1, 2)], "source string, target_share double, max_repeats int")
    m = mixing.mixture(df, goal, F.col("n")).toPandas()
    assert not m.duplicated(["doc_id", "epoch"]).any() and m.groupby("source").epoch.max().to_dict()["small"] <= 2
    share = m.groupby("source").tokens.sum() / m.tokens.sum()
    assert abs(share["big"] - 0.5 / 0.9) < 0.01 and set(share.index) == {"big", "small"}
    report = {r["source"]: r for r in mixing.shares(df, goal, F.col("n")).collect()}
    assert report["ghost"]["used"] == 0 and report["other"]["target_share"] is None and abs(report["big"]["actual_share"] - share["big"]) < 1e-9
    assert mixing.mixture(df.limit(0), goal, F.col("n")).count() == 0


def test_weights():
    w, size, a = mixing.weigh({"a": 100, "b": 1000}, {"a": (0.5, 2), "b": (0.5, 1)}, 800)
    assert w["a"] * size <= 200.001 and abs(sum(w.values()) - 1) < 1e-9 and size == 800 and 0 < a < 1
    w, size, a = mixing.weigh({"a": 100, "b": 1000}, {"a": (0.5, 2), "b": (0.5, 1)})
    assert w == {"a": 0.5, "b": 0.5} and size == 400 and a == 1
    p = {"a": 0.7, "b": 0.2, "c": 0.1}
    a = mixing.exponent_for_entropy(p, 1.0)
    assert abs(mixing.entropy(mixing.tempered(p, a)) - 1.0) < 1e-6
    w, size, a = mixing.weigh({"a": 700, "b": 200, "c": 100}, {"a": (0.2, 1), "b": (0.3, 2), "c": (0.5, 9)}, by_entropy=True)
    assert abs(mixing.entropy(w) - mixing.entropy({"a": 0.2, "b": 0.3, "c": 0.5})) < 1e-6 and w["a"] > w["b"] > w["c"] and w["b"] * size <= 400.001


def test_mixture_fills_its_budget(spark, monkeypatch):
    """No record that is left would fit, however many turns that takes; and the exponent is searched."""
    rng = random.Random(3)
    docs = [(i, "ab"[i % 2], 2 ** rng.randint(0, 11)) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, source string, n long")
    goal = spark.createDataFrame([("a", 0.7, 1), ("b", 0.3, 1)], "source string, target_share double, max_repeats int")
    calls = []
    search = mixing.bisect
    monkeypatch.setattr(mixing, "bisect", lambda *x: calls.append(search(*x)) or calls[-1])
    held = {s: sum(n for _, x, n in docs if x == s) for s in "ab"}
    budget = min(held["a"] / 0.7, held["b"] / 0.3)
    used = mixing.mixture(df, goal, F.col("n")).toPandas()
    for s, share in (("a", 0.7), ("b", 0.3)):
        mine = used[used.source == s]
        left = int(share * budget + 1e-6) - mine.tokens.sum()
        assert 0 <= left < min([n for i, x, n in docs if x == s and i not in set(mine.doc_id)], default=1 << 40)
    assert calls == [1.0]
    tempered = {r["source"]: r for r in mixing.shares(df, goal, F.col("n"), by_entropy=True).collect()}
    assert len(calls) == 2 and abs(tempered["a"]["weight"] - tempered["a"]["actual_share"]) < 0.05


# --- P8 ---
def _corpus(n=900, seed=0):
    """Documents about none, one or two of eight subjects, with passing comparisons."""
    rng = random.Random(seed)
    terms = {k: [f"{a}{b}" for a in ("bor", "cal", "dun") for b in (chr(96 + k) * 2 + "it", chr(96 + k) * 2 + "on")] for k in range(1, 9)}
    frames = ["The annex covers the {} and the {}.", "Earlier work treated the {} alone and not the {}.", "Without a reliable {} nothing is said about the {}."]
    filler = ["Residual errors come from the flag qubit.", "We repeat the experiment twenty times.", "The proof proceeds by induction.", "Replacing one gate would double the depth."]
    docs, truth = [], {}
    for i in range(n):
        about = set(rng.sample(range(1, 9), rng.choice([0, 1, 1, 1, 2])))
        s = rng.sample(filler, 2)
        for k in about:
            s += [rng.choice(frames).format(*rng.sample(terms[k], 2)) for _ in range(3)]
        if rng.random() < 0.3:
            s.append(f"One referee jokingly called the oracle a {rng.choice(terms[rng.randint(1, 8)])} in a manner of speaking.")
        rng.shuffle(s)
        docs.append((i, " ".join(s), "feed"))
        truth[i] = about
    return docs, truth


def test_subjects_held_out(spark):
    docs, truth = _corpus()
    df = spark.createDataFrame([*docs, (1000, None, "feed"), (1001, "", None)], "doc_id long, text string, source string").repartition(4)
    labels = spark.createDataFrame([(i, k) for i in range(200) for k in truth[i]] + [(5000, 1), (None, 1), (3, 99)], "doc_id long, subject_id int")
    areas = spark.createDataFrame([(k, str(k)) for k in range(1, 9)], "subject_id int, subject string")
    got = {(r["doc_id"], r["subject_id"]) for r in subjects.assign_subjects(df, labels, areas).collect()}
    want = {(i, k) for i in truth if i >= 200 for k in truth[i]}
    held = {x for x in got if x[0] >= 200}
    assert len(held & want) / len(held) > 0.85 and len(held & want) / len(want) > 0.9
    assert subjects.assign_subjects(df, labels.limit(0), areas).count() == 0


def test_logistic_and_sentences():
    a = np.array([[1.0, x] for x in np.linspace(-2, 2, 40)])
    w = subjects._logistic(a, (a[:, 1] > 0).astype(float))
    assert w[1] > 1
    texts = ["One two. <b>x</b>\nThree four five!", None, "", "alone. two\x1ewords", "Is this\nit? yes no"]
    words, sizes, per = subjects.words_of(texts, subjects._Hashes())
    assert sizes.tolist() == [2, 3, 2, 2, 2] and per.tolist() == [2, 0, 0, 1, 2] and len(words) == 11
    both, sentence = subjects.with_pairs(words, sizes)
    assert len(both) == 11 + 6 and len(set(both.tolist())) == 16 and np.bincount(sentence).tolist() == [3, 5, 3, 3, 3]


def test_reading_keeps_every_known_term(spark):
    """Encoded documents hold what a plain reading of them does."""
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["ab", "cd.", "ef", "gh\n", "ij", f"rare{i}"]) for _ in range(rng.randint(0, 40))) for i in range(120)]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)] + [(999, None, "x")], "doc_id long, text string, source string")
    docs, size = subjects.read(df)
    got = {}
    for r in docs.toArrow().to_batches():
        d = subjects.Docs(r)
        at = np.concatenate(([0], np.cumsum(d.sentences)))
        for i, key in enumerate(r.column("doc_id").to_pylist()):
            got[key] = [sorted(d.word[d.sentence == s].tolist()) for s in range(at[i], at[i + 1])]
    plain, uses = {}, {}
    import re

    for i, t in enumerate(texts):
        plain[i] = []
        for s in re.split(r"(?<=[.!?])\s+|\n+", t):
            w = re.findall(r"[^\W\d_]+", s.lower())
            if len(w) > 1:
                both = w + list(zip(w, w[1:], strict=False))
                plain[i].append(set(both))
                for f in both:
                    uses[f] = uses.get(f, 0) + 1
    known = {f for f, n in uses.items() if n >= subjects.USES}
    assert size == len(known)
    assert {i: [len(s & known) for s in x] for i, x in plain.items() if texts[i]} == {i: [len(s) for s in x] for i, x in got.items()}


def test_beam_search_finds_the_best_combination():
    rng = np.random.default_rng(4)
    k = 5
    m = subjects.Model(subjects.Terms(np.zeros(0, int), np.zeros(0), k), np.zeros(0), 1.0, np.full(k, 0.2))
    m.weights, m.lift, m.order = rng.normal(0, 1, (k, subjects.FEATURES + 4)), rng.normal(0, 0.2, (k, k)), [3, 0, 4, 1, 2]
    x = rng.normal(0, 1, (6, k, subjects.FEATURES))
    best, p = m.decode(x)
    for d in range(6):
        def total(y, d=d):
            before, score = np.zeros(k, bool), 0.0
            for j in m.order:
                t = m.logit(x[d], j, before)
                score -= np.logaddexp(0, -t if y[j] else t)
                before[j] = y[j]
            return score
        every = [np.array([i >> j & 1 for j in range(k)], bool) for i in range(2**k)]
        assert total(best[d]) >= max(map(total, every)) - 0.05
    assert ((p > 0) & (p < 1)).all()
