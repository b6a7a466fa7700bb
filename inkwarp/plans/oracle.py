"""The same queries as ANSI SQL, written out from the lists and limits they share."""

from __future__ import annotations

from .. import lexicons as L
from ..functions import text as T
from ..operators import classify as C
from ..operators import mining as M


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def any_of(c: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({c}, {quote(t)})" for t in terms) + ")"


def count_of(c: str, terms: list[str]) -> str:
    return "(" + " + ".join(f"contains({c}, {quote(t)})::INT" for t in terms) + ")"


PAPER = rf"coalesce(nullif(regexp_extract(lower(arxiv_id), '(\d{{4}}\.\d{{4,5}}|[a-z][a-z\-]*(?:\.[a-z]{{2}})?/\d{{7}})', 1), ''), nullif(trim(lower(arxiv_id)), ''))"


def tokens(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '[{T.SPACE}]+'), lambda x: x <> '')"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{T.SPACE}]+|[{T.SPACE}]+$', '', 'g')"


def numeric(c: str, least: int = 5, share: float = 0.15) -> str:
    t = tokens(c)
    hit = r"regexp_matches(regexp_replace(x, '^[.,()\[\]]+|[.,()\[\]]+$', '', 'g'), '^-?[0-9]+(\.[0-9]+)?(e-?[0-9]+)?$')"
    return f"(len({t}) >= {least} AND len(list_filter({t}, lambda x: {hit})) / greatest(len({t}), 1)::DOUBLE > {share}::DOUBLE)"


def prose(c: str) -> str:
    t = tokens(c)
    words = ", ".join(map(quote, L.STOP_WORDS))
    return f"(len({t}) >= 10 AND len(list_filter({t}, lambda x: lower(x) IN ({words}))) / greatest(len({t}), 1)::DOUBLE > 0.25::DOUBLE)"


def math(c: str) -> str:
    hits = f"(length({c}) - length(translate({c}, {quote(L.MATH_SYMBOLS)}, '')))"
    return f"(CASE WHEN length({c}) < 50 THEN {hits} > 2 ELSE {hits} / greatest(length({c}), 1)::DOUBLE > 0.05::DOUBLE END)"


def gates(c: str) -> str:
    return "(" + " + ".join(f"regexp_matches({c}, {quote(p)})::INT" for p in T.STRICT_GATES) + ")"


FIG = """SELECT candidate_id, arxiv_id, coalesce(figure_content_text, '') AS inside_raw, lower(coalesce(caption_text, '')) AS caption, lower(coalesce(figure_content_text, '')) AS inside,
  lower(coalesce(referencing_context, '')) AS context, lower(coalesce(caption_text, '')) || ' ' || lower(coalesce(figure_content_text, '')) || ' ' || lower(coalesce(referencing_context, '')) AS blob,
  {p} AS p FROM figure_candidates"""
PROB = "CASE WHEN bert_circuit_prob IS NULL THEN 0.0::DOUBLE WHEN isnan(bert_circuit_prob) THEN NULL ELSE bert_circuit_prob END"


def veto() -> str:
    weak = f"NOT {any_of('blob', L.STRONG_CIRCUIT)}"
    units = " ".join(f"WHEN regexp_matches(inside, {quote(C.unit_pattern(u))}) THEN {quote(f'ScaleUnit({u})')}" for u in L.SCALE_UNITS)
    return f"""CASE WHEN {any_of("inside_raw", L.BULLETS)} THEN 'BulletPointsFound' WHEN {any_of("inside", L.HARDWARE_VETO)} OR {any_of("caption", L.HARDWARE_VETO)} THEN 'HardwareTerms' {units}
      WHEN {weak} AND {numeric("inside")} THEN 'NumericDensity(Plot/Table)' WHEN {weak} AND {prose("inside")} THEN 'ProseDensity' WHEN {weak} AND {math("inside")} THEN 'MathSymbolDensity'
      WHEN {any_of("caption", L.VIZ_VETO)} THEN 'Viz/PlotKeyword' WHEN {any_of("caption", L.MATH_VETO)} THEN 'Definition/Math' WHEN {any_of("inside", L.PLOT_INSIDE)} THEN 'PlotKeywordsInside'
      WHEN contains(blob, 'lattice') AND NOT contains(blob, 'circuit') THEN 'LatticeNoCircuit' END"""


def classified(p: str = PROB) -> str:
    """candidate_id, arxiv_id, veto, g, score, accepted, reasons."""
    strong = any_of("blob", L.STRONG_CIRCUIT)
    views = "(" + " + ".join(f"(contains(caption, {quote(t)}) OR contains(context, {quote(t)}))::INT" for t in L.STATE_VIZ) + ")"
    level = "CASE WHEN p >= 0.8 THEN 'Strong' WHEN p >= 0.6 THEN 'Medium' WHEN p >= 0.4 THEN 'Weak' ELSE 'Negative' END"
    rules = [
        ("'GatesIn:' || g", "CASE WHEN g > 0 THEN least(g, 3) END"),
        ("'StrongCircuitKW'", f"CASE WHEN {strong} THEN 3 END"),
        ("'WeakDiagramKW'", f"CASE WHEN NOT {strong} AND {any_of('blob', L.WEAK_DIAGRAM)} THEN 1 END"),
        (f"'BERT' || {level} || ':' || printf('%.2f', p)", "CASE WHEN p >= 0.8 THEN 4 WHEN p >= 0.6 THEN 2 WHEN p >= 0.4 THEN 1 WHEN p < 0.2 THEN -2 END"),
        (f"'StateViz:' || {views}", f"CASE WHEN {any_of('caption', L.STATE_VIZ)} OR {any_of('context', L.STATE_VIZ)} THEN -1 END"),
        ("'PlotCaption'", f"CASE WHEN {any_of('caption', L.PLOT_CAPTION)} THEN -3 END"),
        ("'PlotKW'", f"CASE WHEN {any_of('blob', L.PLOT_WORDS)} THEN -2 END"),
        ("'PlotEvalKW'", f"CASE WHEN {any_of('blob', L.PLOT_EVAL)} THEN -2 END"),
        ("'PlotEvalStrong'", f"CASE WHEN {any_of('blob', L.PLOT_STRONG)} THEN -3 END"),
        ("'QubitsNoGates'", "CASE WHEN contains(blob, 'qubit') AND g = 0 THEN -2 END"),
        ("'LatticeDiagram'", f"CASE WHEN {any_of('blob', L.LATTICE_WORDS)} THEN -8 END"),
    ]
    each = ", ".join(f"{q} AS r{i}" for i, (_, q) in enumerate(rules))
    total = " + ".join(f"coalesce(r{i}, 0)" for i in range(len(rules)))
    note = """CASE WHEN total >= 3 THEN CASE WHEN g = 0 AND coalesce(p < 0.25, false) THEN 'HighKeywordScore_But_VisualsFail' END WHEN total >= 2 THEN CASE WHEN NOT coalesce(p > 0.3, false) THEN 'Score2_But_BERT_Low' END
      WHEN g > 0 THEN CASE WHEN coalesce(p > 0.35, false) THEN 'LonelyGate_ConfirmedByBERT' ELSE 'LonelyGate_RejectedByBERT' END WHEN coalesce(p > 0.92, false) THEN 'BERT_Rescue' END"""
    names = "concat_ws(',', " + ", ".join(f"CASE WHEN r{i} IS NOT NULL THEN {n} END" for i, (n, _) in enumerate(rules)) + f", {note})"
    return f"""(WITH f AS ({FIG.format(p=p)}), v AS (SELECT *, {veto()} AS veto, {gates("inside_raw")} AS g FROM f), r AS (SELECT *, {each} FROM v), s AS (SELECT *, {total} AS total FROM r)
      SELECT candidate_id, arxiv_id, veto, g, CASE WHEN veto IS NULL THEN total ELSE 0 END AS score,
        CASE WHEN veto IS NOT NULL THEN false WHEN total >= 3 THEN NOT (g = 0 AND coalesce(p < 0.25, false)) WHEN total >= 2 THEN coalesce(p > 0.3, false)
             WHEN g > 0 THEN coalesce(p > 0.35, false) ELSE coalesce(p > 0.92, false) END AS accepted,
        CASE WHEN veto IS NULL THEN {names} ELSE 'HardVeto:' || veto END AS reasons FROM s)"""


CAPTION = "(?i)" + T.spaced(L.CAPTION_PATTERN)
BLOCKS = f"(SELECT *, {PAPER} AS paper FROM text_blocks)"
PAGES = f"(SELECT *, {PAPER} AS paper FROM paper_pages)"
WIDTHS = f"(SELECT paper, page_num, coalesce(max(bbox.x1) + 50, 612.0) AS width FROM {BLOCKS} GROUP BY 1, 2)"
CAPTIONS = f"(SELECT paper, page_num, block_key AS caption_key, bbox AS cb, row_number() OVER (PARTITION BY paper, page_num ORDER BY block_id, block_key) - 1 AS figure_idx FROM {BLOCKS} WHERE regexp_matches(coalesce(text, ''), {quote(CAPTION)}))"
DRAWINGS = f"(SELECT paper, page_num, vector_clusters[i] AS box, i - 1 AS pos FROM (SELECT *, unnest(range(1, len(vector_clusters) + 1)) AS i FROM {PAGES}))"
TURNS = 8  # by then nothing changes any more on these pages; a box takes in the boxes of all it meets each turn
LINKED = f"""(WITH c AS (SELECT *, (cb.x1 - cb.x0) > 0.6::DOUBLE * width AS wide, (cb.x0 + cb.x1) / 2 < width / 2 AS lft FROM {CAPTIONS} JOIN {WIDTHS} USING (paper, page_num)),
  j AS (SELECT caption_key, figure_idx, pos, box, cb, width, box.x1 > (CASE WHEN wide OR lft THEN 0.0 ELSE 0.35::DOUBLE * width END) AND box.x0 < (CASE WHEN wide OR NOT lft THEN width ELSE 0.65::DOUBLE * width END) AS inside
        FROM c JOIN {DRAWINGS} USING (paper, page_num) WHERE box.y1 <= cb.y0 AND box.x1 > 0 AND box.x0 < width)
  SELECT * FROM (SELECT *, max(inside::INT) OVER (PARTITION BY caption_key) AS anywhere FROM j) WHERE inside OR anywhere = 0)"""
MERGED = f"""(WITH o AS (SELECT *, coalesce((min(box.y0) OVER (PARTITION BY caption_key ORDER BY box.y1 DESC, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - box.y1 >= 150)::INT, 0) AS broken FROM {LINKED}),
  k AS (SELECT *, sum(broken) OVER (PARTITION BY caption_key ORDER BY box.y1 DESC, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS breaks FROM o)
  SELECT caption_key, any_value(figure_idx) AS figure_idx, any_value(width) AS width, min(box.x0) AS x0, min(box.y0) AS y0, max(box.x1) AS x1, max(box.y1) AS y1, count(*) AS parts FROM k WHERE breaks = 0 GROUP BY caption_key)"""
ON_PAGE = f"(SELECT f.*, g.page_text FROM (SELECT *, {PAPER} AS paper FROM figure_candidates) f LEFT JOIN {PAGES} g USING (paper, page_num))"
QUEUE = f"(SELECT pos, {PAPER} AS paper FROM paper_queue WHERE {PAPER} IS NOT NULL)"
STATUS = f"""(SELECT pos, q.paper, fig_count FROM {QUEUE} q LEFT JOIN (SELECT paper, fig_count FROM (SELECT {PAPER} AS paper, fig_count, row_number() OVER (PARTITION BY {PAPER} ORDER BY logged_at DESC NULLS LAST, fig_count DESC NULLS LAST) AS k
  FROM paper_progress) WHERE k = 1) USING (paper))"""
GOOD_LABELS = "(SELECT * FROM labels_merged_new WHERE text IS NOT NULL AND label IS NOT NULL)"


def cleaned(c: str) -> str:
    t = f"coalesce({c}, '')"
    for a, b in L.MATH_SPELLING.items():
        t = f"replace({t}, {quote(a)}, {quote(b)})"
    t = f"regexp_replace({t}, {quote(T.LEADERS)}, ' ', 'g')"
    t = f"regexp_replace({t}, {quote(T.UNPRINTABLE)}, '', 'g')"
    return f"trim(regexp_replace({t}, ' +', ' ', 'g'), ' ')"


def gate_list() -> str:
    left, right = rf"(?:^|[{T.SPACE}(\[\].,])", rf"(?:$|[{T.SPACE})\].,])"
    items = [f"CASE WHEN regexp_matches(upper(inside_raw), {quote(left + c + right)}) THEN {quote(n)} END" for c, n in L.LETTER_GATES.items()]
    items += [f"CASE WHEN regexp_matches(blob, {quote(M.name_pattern(n))}) THEN {quote(n)} END" for n in L.GATE_NAMES]
    items += [rf"CASE WHEN regexp_matches(inside_raw, '\|[01][{T.SPACE}]*>') THEN 'Basis State' END", rf"CASE WHEN regexp_matches(inside_raw, '\|[+\-][{T.SPACE}]*>') THEN 'Superposition State' END"]
    return f"array_to_string(list_sort(list_distinct(list_filter([{', '.join(items)}], lambda x: x IS NOT NULL))), ',')"


def problem(c: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({c}, {quote(n.lower())}) THEN {quote(n)}" for n in sorted(L.PROBLEM_NAMES, key=len, reverse=True)) + " ELSE 'Unknown' END"


def titled(c: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all({c}, {quote(T.RUNS)}), lambda x: upper(x[1]) || x[2:]), '')"


def problem_of(source: str, key: str) -> str:
    """source: key and `words`, the lower-case text."""
    aim = rf"regexp_replace(regexp_extract(words, {quote(M.AIM)}, 1), '[{T.SPACE}]+$', '')"
    before = rf"CASE WHEN contains(words, ' problem') THEN regexp_extract(words, {quote(M.BEFORE)}, 1) ELSE '' END"
    junk = ", ".join(map(quote, L.PROBLEM_JUNK))
    return f"""SELECT {key}, coalesce(nullif({problem("words")}, 'Unknown'), CASE WHEN aim <> '' AND aim NOT IN ({junk}) THEN {titled("aim")} END,
      CASE WHEN before <> '' AND length(before) < 30 THEN {titled(strip("before"))} || ' Problem' END, 'Unknown') AS problem FROM (SELECT *, {aim} AS aim, {before} AS before FROM {source})"""


def context() -> str:
    number = f"coalesce(nullif(regexp_extract(coalesce(caption_text, ''), {quote(CAPTION)}, 1), ''), (figure_idx + 1)::VARCHAR)"
    forms = [f"strpos(coalesce(page_text, ''), '{p}' || num)" for p in ("Fig. ", "Figure ", "FIG. ")]
    at = f"CASE WHEN {forms[0]} > 0 THEN {forms[0]} WHEN {forms[1]} > 0 THEN {forms[1]} ELSE {forms[2]} END"
    size = f"CASE WHEN {forms[0]} > 0 THEN 5 WHEN {forms[1]} > 0 THEN 7 ELSE 5 END + length(num)"
    return f"""SELECT candidate_id, CASE WHEN a > 0 THEN replace(substring(page_text, b + 1, e - b), chr(10), ' ') ELSE '' END AS context, CASE WHEN a > 0 THEN b ELSE -1 END AS begin_off, CASE WHEN a > 0 THEN e ELSE -1 END AS end_off
      FROM (SELECT *, greatest(0, a - 251) AS b, least(length(coalesce(page_text, '')), a - 1 + s + 250) AS e FROM (SELECT *, {at} AS a, {size} AS s FROM (SELECT *, {number} AS num FROM {ON_PAGE})))"""


def visual() -> str:
    w, h, n = "floor(bbox.x1 - bbox.x0)::BIGINT", "floor(bbox.y1 - bbox.y0)::BIGINT", "coalesce(octet_length(image_bytes), 0)"
    return f"""SELECT candidate_id, reason = 'Valid' AS ok, reason FROM (SELECT candidate_id, CASE WHEN w < 100 OR h < 100 THEN printf('Too small dimensions (%dx%d)', w, h) WHEN n > 0 AND n < 2000 THEN printf('File size too small (%d bytes)', n)
      WHEN h = 0 THEN 'Height is zero' WHEN w / h::DOUBLE > 5.0 THEN printf('Rejected: Extreme aspect ratio (Wide Strip: %.1f)', w / h::DOUBLE) WHEN w / h::DOUBLE < 0.2 THEN printf('Rejected: Extreme aspect ratio (Tall Tower: %.1f)', w / h::DOUBLE)
      ELSE 'Valid' END AS reason FROM (SELECT candidate_id, {w} AS w, {h} AS h, {n} AS n FROM figure_candidates))"""


def oracle_sql() -> dict[str, str]:
    low = "lower(coalesce(figure_content_text, ''))"
    cap = "lower(coalesce(caption_text, ''))"
    doc = "coalesce(text, '')"
    verdict = "coalesce(veto, CASE WHEN accepted THEN 'accepted' ELSE 'rejected' END)"
    queue_id = r"trim(replace(lower(regexp_replace(coalesce(arxiv_id, ''), '^[ \t-\r]+|[ \t-\r]+$', '', 'g')), 'arxiv:', ''), ' ')"
    texts = " || ' ' || ".join(cleaned(c) for c in ("caption_text", "figure_content_text", "referencing_context"))
    last = lambda where: f"(SELECT paper, record_id FROM (SELECT arxiv_number AS paper, record_id, row_number() OVER (PARTITION BY arxiv_number ORDER BY mined_at DESC NULLS LAST, record_id DESC) AS k FROM mined_records WHERE filename IS NOT NULL AND arxiv_number IS NOT NULL AND {where}) WHERE k = 1)"
    title = f"coalesce(list_filter(list_transform(list_slice(string_split(coalesce(t, ''), chr(10)), 1, 6), lambda y: {strip('y')}), lambda x: length(x) > 5 AND NOT contains(lower(x), 'arxiv'))[1], '')"
    return {
        "densities": f"SELECT candidate_id, {numeric(low)} AS numeric, {prose(low)} AS prose, {math(low)} AS math FROM figure_candidates",
        "density_of_documents": f"SELECT doc_id, {numeric(doc, share=0.0)} AS numeric, {prose(doc)} AS prose, {math(doc)} AS math FROM documents",
        "strict_gate_count": f"SELECT candidate_id, {gates(chr(39).join(['coalesce(figure_content_text, ', '', ')']))} AS gates FROM figure_candidates",
        "lexicon_hits": f"SELECT candidate_id, {any_of(cap, L.HARDWARE_VETO)} AS hardware, {count_of(cap, L.PLOT_EVAL)} AS plot_terms, {count_of(cap, L.STATE_VIZ)} AS state_terms FROM figure_candidates",
        "bullet_veto": f"SELECT candidate_id, coalesce({any_of('figure_content_text', L.BULLETS)}, false) AS bullets FROM figure_candidates",
        "caption_blocks": f"SELECT block_key, coalesce(nullif(regexp_extract(text, {quote(CAPTION)}, 1), ''), '0') AS number FROM text_blocks WHERE regexp_matches(coalesce(text, ''), {quote(CAPTION)})",
        "veto_cascade": f"SELECT candidate_id, coalesce(veto, '') AS veto FROM {classified()}",
        "score_ladder": f"SELECT candidate_id, score, accepted, reasons FROM {classified()}",
        "degraded_decision": f"SELECT candidate_id, score, accepted FROM {classified('0.0::DOUBLE')}",
        "accepted_per_paper": f"SELECT {PAPER} AS paper, count(*) FILTER (WHERE accepted) AS found FROM {classified()} GROUP BY 1",
        "verdict_counts": f"SELECT {verdict} AS verdict, count(*) AS figures, sum(score)::BIGINT AS score FROM {classified()} GROUP BY 1",
        "visual_filter": visual(),
        "padded_boxes": "SELECT * FROM (SELECT candidate_id, greatest(0.0::DOUBLE, bbox.x0 - 45) AS x0, greatest(0.0::DOUBLE, bbox.y0 - 15) AS y0, least(612.0::DOUBLE, bbox.x1 + 10) AS x1, bbox.y1 + 10 AS y1 FROM figure_candidates) WHERE x1 - x0 >= 100 AND y1 - y0 >= 100",
        "large_images": "SELECT candidate_id FROM figure_candidates WHERE coalesce(octet_length(image_bytes), 0) >= 2000",
        "page_width": f"SELECT * FROM {WIDTHS}",
        "caption_drawings": f"SELECT caption_key, pos FROM {LINKED}",
        "merged_drawings": f"SELECT caption_key, x0, y0, x1, y1, parts FROM {MERGED}",
        "pipeline_figures": f"""SELECT * FROM (SELECT caption_key, figure_idx, greatest(0.0::DOUBLE, x0 - 45) AS x0, greatest(0.0::DOUBLE, y0 - 15) AS y0, least(width, x1 + 10) AS x1, y1 + 10 AS y1, parts FROM {MERGED}) WHERE x1 - x0 >= 100 AND y1 - y0 >= 100""",
        "box_clusters": f"""WITH RECURSIVE b AS (SELECT paper, page_num, row_number() OVER () AS id, box.x0 AS x0, box.y0 AS y0, box.x1 AS x1, box.y1 AS y1 FROM {DRAWINGS} WHERE box.x1 > box.x0 OR box.y1 > box.y0),
          g AS (SELECT *, 0 AS turn FROM b UNION ALL
                SELECT a.paper, a.page_num, a.id, min(o.x0), min(o.y0), max(o.x1), max(o.y1), a.turn + 1 FROM g a JOIN g o ON a.paper = o.paper AND a.page_num = o.page_num AND a.x0 - 15 < o.x1 AND o.x0 < a.x1 + 15 AND a.y0 - 15 < o.y1 AND o.y0 < a.y1 + 15
                WHERE a.turn < {TURNS} GROUP BY a.paper, a.page_num, a.id, a.turn)
          SELECT DISTINCT paper, page_num, x0, y0, x1, y1 FROM g WHERE turn = {TURNS}""",
        "inside_texts": f"""SELECT candidate_id, string_agg(coalesce(text, ''), ' ' ORDER BY block_id, block_key) AS inside_text FROM (SELECT candidate_id, {PAPER} AS paper, page_num, bbox AS box FROM figure_candidates) f JOIN {BLOCKS} b USING (paper, page_num)
          WHERE (bbox.x0 + bbox.x1) / 2 BETWEEN box.x0 AND box.x1 AND (bbox.y0 + bbox.y1) / 2 BETWEEN box.y0 AND box.y1 GROUP BY candidate_id""",
        "page_texts": f"SELECT paper, page_num, coalesce(string_agg(t, chr(10) || chr(10) ORDER BY block_id, block_key) FILTER (WHERE t <> ''), '') AS page_text, count(*) AS n_blocks FROM (SELECT *, {strip(doc)} AS t FROM {BLOCKS}) GROUP BY 1, 2",
        "figure_ordinals": f"SELECT caption_key AS block_key, figure_idx FROM {CAPTIONS}",
        "caption_spans": f"SELECT candidate_id, p AS begin_off, CASE WHEN p < 0 THEN -1 ELSE p + length(caption_text) END AS end_off FROM (SELECT *, coalesce(CASE WHEN length(caption_text) > 0 THEN strpos(page_text, caption_text) END, 0) - 1 AS p FROM {ON_PAGE})",
        "context_windows": context(),
        "paper_titles": f"SELECT paper, {title} AS title FROM (SELECT paper, arg_min(page_text, page_num) AS t FROM {PAGES} GROUP BY 1)",
        "cleaned_captions": f"SELECT candidate_id, {cleaned('caption_text')} AS cleaned FROM figure_candidates",
        "gate_names": f"SELECT candidate_id, {gate_list()} AS gates FROM ({FIG.format(p='0')})",
        "known_problems": f"SELECT candidate_id, {problem(cap)} AS problem FROM figure_candidates",
        "mined_problems": problem_of(f"(SELECT candidate_id, lower(coalesce(title, '') || ' ' || t) AS words FROM (SELECT candidate_id, {PAPER} AS paper, {texts} AS t FROM figure_candidates) LEFT JOIN (SELECT paper, {title} AS title FROM (SELECT paper, arg_min(page_text, page_num) AS t FROM {PAGES} GROUP BY 1)) USING (paper))", "candidate_id"),
        "problem_fallbacks": problem_of("(SELECT doc_id, lower(' ' || coalesce(text, '')) AS words FROM documents)", "doc_id"),
        "figure_descriptions": f"SELECT candidate_id, concat_ws('|', nullif(c, ''), CASE WHEN x <> '' THEN 'Context: ' || x END) AS descriptions FROM (SELECT candidate_id, {cleaned('caption_text')} AS c, {cleaned('referencing_context')} AS x FROM figure_candidates)",
        "positive_share": "SELECT candidate_id, round(exp(s - greatest(s, 0)) / (exp(0 - greatest(s, 0)) + exp(s - greatest(s, 0))), 9) AS p FROM (SELECT candidate_id, CASE WHEN NOT isnan(classification_score) THEN classification_score END AS s FROM figure_candidates)",
        "upserted_records": f"SELECT * FROM {last('page_number % 2 <> 0')} UNION ALL SELECT * FROM {last('page_number % 2 = 0')} WHERE paper NOT IN (SELECT paper FROM {last('page_number % 2 <> 0')})",
        "merged_counts": f"SELECT pos, paper, coalesce(found, fig_count) AS fig_count FROM {STATUS} LEFT JOIN (SELECT {PAPER} AS paper, count(*) FILTER (WHERE accepted) AS found FROM {classified()} GROUP BY 1) USING (paper)",
        "paper_list_file": f"SELECT paper, count(*) AS listed FROM (SELECT {queue_id} AS paper FROM paper_queue WHERE trim(coalesce(arxiv_id, '')) <> '') GROUP BY 1",
        "progress_file": f"SELECT paper, max(fig_count) AS fig_count FROM {STATUS} GROUP BY 1",
        "labels_file": f"SELECT label, text, count(*) AS rows FROM {GOOD_LABELS} GROUP BY 1, 2",
        "dataset_file": "SELECT filename, record_id, quantum_problem, page_number FROM mined_records",
        "decision_loss": f"""SELECT n, round(loss, 6) AS loss FROM (SELECT count(*) AS n, -sum(CASE WHEN label = 1 THEN w * ln(q) ELSE ln(1 - q) END) / sum(CASE WHEN label = 1 THEN w ELSE 1 END) AS loss FROM (SELECT label, greatest(least({PROB}, 1 - 1e-7::DOUBLE), 1e-7::DOUBLE) AS q
          FROM labels_merged_new JOIN figure_candidates USING (candidate_id) WHERE label IS NOT NULL AND NOT isnan(coalesce(bert_circuit_prob, 0))), (SELECT (count(*) - count(*) FILTER (WHERE label = 1)) / greatest(count(*) FILTER (WHERE label = 1), 1)::DOUBLE AS w FROM {GOOD_LABELS}))""",
        "image_names": f"SELECT candidate_id, 'quantph_' || replace(paper, '/', '') || '_p' || page_num || '_f' || figure_idx || '.png' AS filename FROM (SELECT *, {PAPER} AS paper FROM figure_candidates) WHERE paper IS NOT NULL",
        "model_texts": "SELECT candidate_id, replace(coalesce(caption_text, '') || ' ' || coalesce(referencing_context, ''), chr(10), ' ') AS text FROM figure_candidates",
        "latest_records": "SELECT filename, record_id FROM (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY mined_at DESC NULLS LAST, record_id DESC) AS k FROM mined_records WHERE filename IS NOT NULL) WHERE k = 1",
        "distinct_gates": "SELECT arxiv_number, array_to_string(list_sort(list_distinct(list(gate))), '|') AS gates FROM (SELECT arxiv_number, unnest(quantum_gates) AS gate FROM mined_records) WHERE gate IS NOT NULL GROUP BY 1",
        "queue_status": f"SELECT * FROM {STATUS}",
        "unprocessed_papers": f"SELECT min(pos) AS pos, paper FROM {STATUS} WHERE fig_count IS NULL GROUP BY paper",
        "next_claim": f"SELECT min(pos) AS pos, paper FROM {STATUS} WHERE fig_count IS NULL GROUP BY paper ORDER BY pos LIMIT 64",
        "progress_total": f"SELECT coalesce(sum(c), 0)::BIGINT AS total, count(c) AS papers_done FROM (SELECT paper, max(fig_count) AS c FROM {STATUS} GROUP BY 1)",
        "soft_target": f"SELECT pos, n, before FROM (SELECT pos, coalesce(fig_count, 0) AS n, coalesce(sum(coalesce(fig_count, 0)) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM {STATUS}) WHERE before < 250",
        "stratified_split": f"SELECT label_id, k <= round(n * 0.2::DOUBLE) AS is_test FROM (SELECT label_id, row_number() OVER (PARTITION BY label ORDER BY md5(label_id::VARCHAR), label_id) AS k, count(*) OVER (PARTITION BY label) AS n FROM {GOOD_LABELS})",
        "class_weights": f"SELECT n, positive, n - positive AS negative, (n - positive) / greatest(positive, 1)::DOUBLE AS weight FROM (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1) AS positive FROM {GOOD_LABELS})",
        "decision_metrics": f"""SELECT n, tp, fp, fn, (n - fp - fn) / n::DOUBLE AS accuracy, CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0.0 END AS f1 FROM (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1 AND accepted) AS tp,
          count(*) FILTER (WHERE label <> 1 AND accepted) AS fp, count(*) FILTER (WHERE label = 1 AND NOT accepted) AS fn FROM labels_merged_new JOIN {classified()} USING (candidate_id) WHERE label IS NOT NULL)""",
    }
