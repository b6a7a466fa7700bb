"""Vetoes, score and decision for figure candidates: one CASE chain, one sum, one ladder; no UDF."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal
from math import nextafter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicons as L
from ..functions import text as T


@dataclass(frozen=True)
class Rules:
    """Lists and limits of the classifier."""

    strong: list[str] = field(default_factory=lambda: L.STRONG_CIRCUIT)
    weak: list[str] = field(default_factory=lambda: L.WEAK_DIAGRAM)
    bullets: list[str] = field(default_factory=lambda: L.BULLETS)
    hardware: list[str] = field(default_factory=lambda: L.HARDWARE_VETO)
    units: list[str] = field(default_factory=lambda: L.SCALE_UNITS)
    viz: list[str] = field(default_factory=lambda: L.VIZ_VETO)
    math: list[str] = field(default_factory=lambda: L.MATH_VETO)
    plot_inside: list[str] = field(default_factory=lambda: L.PLOT_INSIDE)
    plot_caption: list[str] = field(default_factory=lambda: L.PLOT_CAPTION)
    plot_words: list[str] = field(default_factory=lambda: L.PLOT_WORDS)
    plot_eval: list[str] = field(default_factory=lambda: L.PLOT_EVAL)
    plot_strong: list[str] = field(default_factory=lambda: L.PLOT_STRONG)
    lattice: list[str] = field(default_factory=lambda: L.LATTICE_WORDS)
    state_viz: list[str] = field(default_factory=lambda: L.STATE_VIZ)


DEFAULT = Rules()


@dataclass(frozen=True)
class Texts:
    """The texts of a candidate; NULL counts as empty. With `lowered`, the columns that hold them in lower case."""

    caption: Column
    inside: Column
    context: Column
    lowered: tuple[Column, Column, Column, Column] | None = None

    @property
    def low(self) -> tuple[Column, Column, Column, Column]:
        if self.lowered:
            return self.lowered
        a, b, c = (F.lower(T.text(x)) for x in (self.caption, self.inside, self.context))
        return a, b, c, F.concat_ws(" ", a, b, c)


def unit_pattern(unit: str) -> str:
    return T.whole_word(rf"\d+[{T.SPACE}]*{T.spaced(unit)}")


def veto(t: Texts, r: Rules = DEFAULT) -> Column:
    """The first rule that rejects the candidate, as its label; NULL if none does."""
    caption, inside, _, blob = t.low
    has_strong = T.contains_any(blob, r.strong)
    chain = F.when(T.contains_any(t.inside, r.bullets), "BulletPointsFound").when(T.contains_any(inside, r.hardware) | T.contains_any(caption, r.hardware), "HardwareTerms")
    for unit in r.units:
        chain = chain.when(inside.rlike(unit_pattern(unit)), f"ScaleUnit({unit})")
    return (
        chain.when(~has_strong & T.numeric_dense(inside), "NumericDensity(Plot/Table)")
        .when(~has_strong & T.prose_dense(inside), "ProseDensity")
        .when(~has_strong & T.math_dense(inside), "MathSymbolDensity")
        .when(T.contains_any(caption, r.viz), "Viz/PlotKeyword")
        .when(T.contains_any(caption, r.math), "Definition/Math")
        .when(T.contains_any(inside, r.plot_inside), "PlotKeywordsInside")
        .when(F.contains(blob, F.lit("lattice")) & ~F.contains(blob, F.lit("circuit")), "LatticeNoCircuit")
    )


def number(p: Column) -> Column:
    """A probability as the rules see it: NULL is the model's default 0.0, NaN is no statement (NULL)."""
    return F.when(p.isNull(), F.lit(0.0)).when(~F.isnan(p), p)


def _up_from() -> list[float]:
    """For each hundredth the least double above it that is written as the next one with two decimals, half to even."""
    out = []
    for k in range(101):
        tie = Decimal(2 * k + 1) / 200
        x = float(tie)
        out.append(x if Decimal(x) > tie or Decimal(x) == tie and k % 2 else nextafter(x, 2.0))
    return out


def two_decimals(p: Column) -> Column:
    """A number written with two decimals by its exact value, as C and Python do; the engine's own rounds its shortest digits."""
    base = F.floor(p * 100).cast("int")
    n = base + (p >= F.get(F.array(*map(F.lit, _up_from())), base)).cast("int")
    return F.when(p.between(0, 1), F.concat(F.floor(n / 100).cast("string"), F.lit("."), F.lpad((n % 100).cast("string"), 2, "0"))).otherwise(F.format_string("%.2f", p))


def parts(t: Texts, p: Column, g: Column, r: Rules = DEFAULT) -> list[tuple[Column, Column]]:
    """(reason, points) of every rule of the score, in order; points are NULL where a rule does not apply. g: gate hits."""
    caption, _, context, blob = t.low
    p = number(p)
    strong = T.contains_any(blob, r.strong)
    on = lambda cond, points: F.when(cond, F.lit(points))
    level = F.when(p >= 0.8, "Strong").when(p >= 0.6, "Medium").when(p >= 0.4, "Weak").otherwise("Negative")
    views = T.count_terms_in((caption, context), r.state_viz)
    listed = [
        (F.concat(F.lit("GatesIn:"), g), F.when(g > 0, F.least(g, F.lit(3)))),
        ("StrongCircuitKW", on(strong, 3)),
        ("WeakDiagramKW", on(~strong & T.contains_any(blob, r.weak), 1)),
        (F.concat(F.lit("BERT"), level, F.lit(":"), two_decimals(p)), F.when(p >= 0.8, 4).when(p >= 0.6, 2).when(p >= 0.4, 1).when(p < 0.2, -2)),
        (F.concat(F.lit("StateViz:"), views), on(views > 0, -1)),
        ("PlotCaption", on(T.contains_any(caption, r.plot_caption), -3)),
        ("PlotKW", on(T.contains_any(blob, r.plot_words), -2)),
        ("PlotEvalKW", on(T.contains_any(blob, r.plot_eval), -2)),
        ("PlotEvalStrong", on(T.contains_any(blob, r.plot_strong), -3)),
        ("QubitsNoGates", on(F.contains(blob, F.lit("qubit")) & (g == 0), -2)),
        ("LatticeDiagram", on(T.contains_any(blob, r.lattice), -8)),
    ]
    return [(F.lit(name) if isinstance(name, str) else name, points) for name, points in listed]


def decide(score: Column, gates: Column, p: Column) -> Column:
    """The ladder: a high score is accepted unless nothing supports it, a lower one needs a likely text."""
    p = number(p)
    yes = lambda c: F.coalesce(c, F.lit(False))
    return F.when(score >= 3, ~((gates == 0) & yes(p < 0.25))).when(score >= 2, yes(p > 0.3)).when(gates > 0, yes(p > 0.35)).otherwise(yes(p > 0.92))


def ladder_note(score: Column, gates: Column, p: Column) -> Column:
    """The reason that the ladder itself adds; NULL where it adds none."""
    p = number(p)
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(score >= 3, F.when((gates == 0) & yes(p < 0.25), "HighKeywordScore_But_VisualsFail"))
        .when(score >= 2, F.when(~yes(p > 0.3), "Score2_But_BERT_Low"))
        .when(gates > 0, F.when(yes(p > 0.35), "LonelyGate_ConfirmedByBERT").otherwise("LonelyGate_RejectedByBERT"))
        .when(yes(p > 0.92), "BERT_Rescue")
    )


NAMES = ("_caption", "_inside", "_context", "_blob")


def lowered(df: DataFrame, caption: str = "caption_text", inside: str = "figure_content_text", context: str = "referencing_context") -> tuple[DataFrame, Texts]:
    """df with its texts once in lower case (columns NAMES), and the Texts that use them."""
    plain = Texts(F.col(caption), F.col(inside), F.col(context))
    return df.withColumns(dict(zip(NAMES, plain.low, strict=True))), Texts(plain.caption, plain.inside, plain.context, tuple(map(F.col, NAMES)))


def classify(df: DataFrame, caption: str = "caption_text", inside: str = "figure_content_text", context: str = "referencing_context", prob: str = "bert_circuit_prob", rules: Rules = DEFAULT) -> DataFrame:
    """df with veto, gates, score, accepted and reasons (an array in rule order, then what the ladder adds).

    A vetoed row keeps score 0 and is not accepted; its gates are NULL, as they were not counted.
    Columns of these names in df are replaced.
    """
    # Lowered once and the rules in steps, so that each step stays within generated code.
    df, t = lowered(df, caption, inside, context)
    p = F.col(prob).cast("double")
    found = parts(t, p, F.col("gates"), rules)
    rule = [f"_r{i}" for i in range(len(found))]
    fine = F.col("veto").isNull()
    total = sum((F.coalesce(F.col(r), F.lit(0)) for r in rule), F.lit(0))
    named = F.array_compact(F.array(*(F.when(F.col(r).isNotNull(), n) for r, (n, _) in zip(rule, found, strict=True)), ladder_note(F.col("score"), F.col("gates"), p)))
    df = df.withColumn("veto", veto(t, rules)).withColumn("gates", F.when(fine, T.strict_gates(t.inside)))
    df = df.withColumns({r: F.when(fine, points) for r, (_, points) in zip(rule, found, strict=True)})
    return (
        df.withColumn("score", F.when(fine, total).otherwise(F.lit(0)))
        .withColumn("accepted", F.when(fine, decide(F.col("score"), F.col("gates"), p)).otherwise(F.lit(False)))
        .withColumn("reasons", F.when(fine, named).otherwise(F.array(F.concat(F.lit("HardVeto:"), "veto"))))
        .drop(*NAMES, *rule)
    )
