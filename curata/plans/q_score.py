"""Queries of scored records: every document as a label and an entry of a paper of four, told from its whole text."""

from __future__ import annotations

from pyspark.sql import functions as F

from curata.operators import metrics, scoring
from curata.plans.catalogue import query, table

_NAMES = ["Smith", "Jones", "Lee"]
_RESULTS = ["success", "failure", "inconclusive", "reversal", ""]
_TYPES = ["direct", "close experiment", "direct or close", "conceptual", ""]


def _pick(values, k):
    return F.get(F.array(*map(F.lit, values)), k.cast("int"))


def _capitals(c):
    """In capitals, but for letters whose capitals are others in lower case again, such as the German sharp s."""
    return F.translate(c, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _entries(spark, d):
    """(gt, ext, aliases, matches, papers). w: blanks of the text, m: its length; they decide every field."""
    rows = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "source")
    w, m, n = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))), F.length("text"), F.col("doc_id") % 4
    key = F.substring(F.md5("text"), 1, 12)
    rows = rows.withColumns({"w": w, "m": m, "key": key, "paper": F.expr("doc_id div 4").cast("string")})
    w, m, key = F.col("w"), F.col("m"), F.col("key")
    s = lambda c: c.cast("string")
    doi = F.when(w % 5 == 0, "").otherwise(F.concat(F.lit("10.1000/"), key))
    gt = rows.select(
        "paper", n.alias("gt"), s(F.col("doc_id")).alias("row_id"), "source", F.lit("dev").alias("split"), F.lit("other").alias("discipline_group"), F.lit("unknown").alias("year_bucket"), F.when(F.expr("doc_id div 4") % 3 == 0, "paper").otherwise("effect").alias("granularity"),
        F.when(w % 7 == 0, "boundary").otherwise("").alias("gt_ambiguity"), (w % 2 == 0).alias("effects_complete"), (F.expr("doc_id div 4") % 2 == 0).alias("has_reversal_class"), F.lit("").alias("provenance"),
        _pick(_RESULTS, w % 5).alias("g_result"), _pick(_TYPES, w % 5).alias("g_type"), doi.alias("g_doi"), F.left("text", F.lit(60)).alias("g_title"), _pick([f"{x}, A" for x in _NAMES], w % 3).alias("g_authors"), s(1990 + w % 3).alias("g_year"), F.lit("Journal").alias("g_journal"), F.col("text").alias("g_description"), F.lit("").alias("g_citation"),
        s(w).alias("g_original_n"), s((w % 100) / 100).alias("g_original_es"), F.lit("d").alias("g_original_es_type"), s((w % 10) / 100).alias("g_original_p_value"), F.lit("=").alias("g_original_p_value_type"), s(m).alias("g_replication_n"), *(F.lit(None).cast("string").alias(f"g_replication_{x}") for x in ("es", "es_type", "p_value", "p_value_type")),
    )
    other = F.when(m % 7 == 0, "").when(m % 7 == 1, F.concat(F.lit("10.2000/"), key)).when(m % 7 == 2, F.concat(F.lit("10.3000/"), key)).otherwise(F.concat(F.lit("10.1000/"), key))
    ext = rows.select(
        "paper", n.alias("ext"), F.col("text").alias("e_explanation"), F.when(m % 6 == 5, "Odd").otherwise(F.concat(F.lit(" "), F.upper(_pick(_RESULTS, F.when(m % 6 < 3, w % 5).otherwise(m % 5))))).alias("e_result"), _pick(["direct", "Close", "conceptual", "close extension"], m % 4).alias("e_type"), other.alias("e_doi"),
        F.when(m % 3 == 0, _capitals(F.left("text", F.lit(60)))).otherwise("#" * 40).alias("e_title"), _pick([f"{x}, B" for x in _NAMES], m % 3).alias("e_authors"), s(1990 + m % 3).alias("e_year"), F.when(m % 2 == 0, "JOURNAL ").otherwise("#####").alias("e_journal"), F.col("text").alias("e_description"),
        F.when(m % 2 == 0, F.concat(F.lit("As "), _pick(_NAMES, m % 3), F.lit(" ("), s(1990 + m % 3), F.lit(") says"))).otherwise(" ").alias("e_citation"),
        s(w + m % 3 - 1).alias("e_original_n"), s((w % 100) / 100 + (m % 4) * 0.03).alias("e_original_es"), F.when(m % 5 == 0, "R").otherwise("d").alias("e_original_es_type"), s((m % 10) / 100).alias("e_original_p_value"), F.when(m % 2 == 0, "=").otherwise("<").alias("e_original_p_value_type"), *(F.lit(None).cast("string").alias(f"e_replication_{x}") for x in ("n", "es", "es_type", "p_value", "p_value_type")),
    )
    aliases = rows.select(F.col("doc_id").alias("seq"), F.concat(F.lit("10.2000/"), key).alias("alias"), F.concat(F.lit("10.1000/"), key).alias("canonical"), F.lit("preprint").alias("kind"))
    matches = rows.select("paper", n.alias("gt"), n.alias("ext"), F.lit("doi").alias("method"), F.lit("same_effect").alias("relation"), F.lit("high").alias("confidence"), F.lit(0.0).alias("cost"))
    papers = rows.select("paper").distinct().withColumns({"tier": F.lit("xml"), "model": F.lit("m")})
    return gt, ext, aliases, matches, papers


def _records(spark, d):
    gt, ext, aliases, matches, papers = _entries(spark, d)
    return scoring.scored(matches, gt, ext, aliases, papers)


_PICK = lambda values, k: f"list_extract({[str(v) for v in values]}, ({k}) + 1)"
_SQL = f"""x AS (SELECT *, length(text) - length(replace(text, ' ', '')) AS w, length(text) AS m, substr(md5(text), 1, 12) AS key, (doc_id // 4)::VARCHAR AS paper FROM (SELECT doc_id, coalesce(text, '') AS text, source FROM documents)),
f AS (SELECT paper, doc_id % 4 AS gt, text, w, m, source, CASE WHEN (doc_id // 4) % 3 = 0 THEN 'paper' ELSE 'effect' END AS gran, w % 7 = 0 AS boundary, w % 2 = 0 AS complete, (doc_id // 4) % 2 = 0 AS reversal_class, {_PICK(_RESULTS, "w % 5")} AS g_result,
 {_PICK(["direct", "close experiment", "direct_or_close", "conceptual", ""], "w % 5")} AS g_type, {_PICK(["direct", "close experiment", "conceptual", "close extension"], "m % 4")} AS e_type, CASE WHEN w % 5 = 0 THEN '' ELSE '10.1000/' || key END AS g_doi,
 CASE m % 7 WHEN 0 THEN '' WHEN 1 THEN '10.2000/' || key WHEN 2 THEN '10.3000/' || key ELSE '10.1000/' || key END AS e_doi, CASE WHEN m % 7 = 0 THEN '' WHEN m % 7 = 2 THEN '10.3000/' || key ELSE '10.1000/' || key END AS e_canon,
 CASE WHEN m % 6 = 5 THEN 'odd' ELSE {_PICK(_RESULTS, "CASE WHEN m % 6 < 3 THEN w % 5 ELSE m % 5 END")} END AS raw FROM x),
v AS (SELECT paper, e_canon, list(raw) FILTER (raw <> '') AS l, count(*) AS n FROM f WHERE e_canon <> '' GROUP BY ALL UNION ALL SELECT paper, NULL, list(raw) FILTER (raw <> ''), count(*) FROM f GROUP BY paper),
k AS (SELECT paper, e_canon, n, CASE WHEN l IS NULL THEN '' WHEN len(list_distinct(l)) = 1 THEN l[1] WHEN (list_contains(l, 'success') AND list_contains(l, 'failure')) OR list_contains(l, 'reversal') THEN 'inconclusive'
 WHEN 2 * len(list_filter(l, lambda y: y = 'inconclusive')) <= len(l) THEN CASE WHEN list_contains(l, 'success') THEN 'success' ELSE 'failure' END ELSE 'inconclusive' END AS verdict FROM v),
o AS (SELECT paper, g_doi, count(*) AS labels FROM f WHERE g_doi <> '' GROUP BY ALL),
p AS (SELECT f.*, NOT reversal_class AND raw = 'reversal' AS collapsed, CASE WHEN NOT reversal_class AND raw = 'reversal' THEN 'failure' ELSE raw END AS ext, g_type <> '' AS typed, g_type = 'direct_or_close' AS two, s.n IS NOT NULL AND (gran = 'paper' OR (labels = 1 AND NOT complete)) AS by_same,
 CASE WHEN s.n IS NOT NULL AND (gran = 'paper' OR (labels = 1 AND NOT complete)) THEN s.verdict WHEN gran = 'paper' THEN h.verdict END AS pooled, f.g_doi <> '' AND f.g_doi = f.e_canon AS doi_ok FROM f LEFT JOIN k s ON s.paper = f.paper AND s.e_canon = f.g_doi LEFT JOIN o ON o.paper = f.paper AND o.g_doi = f.g_doi JOIN k h ON h.paper = f.paper AND h.e_canon IS NULL),
r AS (SELECT *, CASE WHEN typed THEN CASE WHEN two THEN e_type IN ('direct', 'close experiment', 'close extension') ELSE g_type = e_type END END AS type_ok,
 CASE WHEN typed AND NOT two THEN abs(list_position(['direct', 'close experiment', 'close extension', 'conceptual'], g_type) - list_position(['direct', 'close experiment', 'close extension', 'conceptual'], e_type)) <= 1 END AS near_ok,
 trim(left(text, 60)) <> '' AND m % 3 = 0 AS title_ok, w % 3 = m % 3 AS name_ok, text <> '' AS bib, m % 2 = 0 AS cited FROM p)"""


@query("scored_records", f"WITH {_SQL} SELECT paper, gt, g_result AS gt_result, ext AS ext_result, raw AS ext_result_raw, collapsed AS collapse_applied, g_result <> '' AND g_result = ext AS result_ok, g_type AS gt_type, e_type AS ext_type, doi_ok, doi_ok AND g_doi <> e_doi AS doi_alias_used, g_doi <> '' AND e_doi = '' AS doi_missing_ext, title_ok, name_ok AS authors_ok, name_ok AS year_ok, cited AS journal_ok, type_ok, near_ok AS type_adjacent_ok, cited AS cit_present, CASE WHEN cited THEN name_ok END AS cit_author_year_ok, pooled AS ext_result_paper, md5(left(text, 400)) AS explanation FROM r")
def scored_records(spark, d):
    names = ["paper", "gt", "gt_result", "ext_result", "ext_result_raw", "collapse_applied", "result_ok", "gt_type", "ext_type", "doi_ok", "doi_alias_used", "doi_missing_ext", "title_ok", "authors_ok", "year_ok", "journal_ok", "type_ok", "type_adjacent_ok", "cit_present", "cit_author_year_ok", "ext_result_paper"]
    return _records(spark, d).select(*names, F.md5("ext_explanation").alias("explanation"))


_BLOCKS = """b AS (SELECT 'result_3class' AS block, 3 AS k, g_result AS a, ext AS b FROM r WHERE g_result <> '' UNION ALL SELECT 'result_3class_paper', 3, g_result, pooled FROM r WHERE g_result <> '' AND pooled <> '' UNION ALL SELECT 'result_3class_clear', 3, g_result, ext FROM r WHERE g_result <> '' AND NOT boundary
 UNION ALL SELECT 'result_4class', 4, g_result, raw FROM r WHERE g_result <> '' AND NOT collapsed AND coalesce(source, '') <> '' AND gran <> 'paper' AND reversal_class UNION ALL SELECT 'result_all_rows_raw', 4, g_result, raw FROM r WHERE g_result <> ''),
c AS (SELECT block, n, unnest(['success', 'failure', 'inconclusive', 'reversal'][:k]) AS class FROM (SELECT block, any_value(k) AS k, count(*) AS n FROM b GROUP BY block)),
y AS (SELECT c.block, c.class, count(*) FILTER (a = class) AS support, count(*) FILTER (b = class) AS predicted, count(*) FILTER (a = class AND b = class) AS tp FROM c JOIN b USING (block) GROUP BY ALL),
z AS (SELECT *, tp::DOUBLE / nullif(predicted, 0) AS precision, tp::DOUBLE / nullif(support, 0) AS recall FROM y),
u AS (SELECT *, CASE WHEN precision > 0 AND recall > 0 THEN 2 * precision * recall / (precision + recall) WHEN support > 0 OR predicted > 0 THEN 0 END AS f1 FROM z)"""


def _blocks(spark, d):
    s = scoring.summary(_records(spark, d))
    return s.select(F.explode(F.array(*(F.struct(F.lit(n).alias("block"), F.col(n).alias("m")) for n in ("result_3class", "result_3class_paper", "result_3class_clear")))).alias("x")).select("x.block", "x.m.*").unionByName(
        s.select(F.explode(F.array(*(F.struct(F.lit(n).alias("block"), F.col(n).alias("m")) for n in ("result_4class", "result_all_rows_raw")))).alias("x")).select("x.block", "x.m.*")
    )


@query("summary_classes", f"WITH {_SQL}, {_BLOCKS} SELECT block, class, support, predicted, tp, precision, recall, f1 FROM u")
def summary_classes(spark, d):
    return _blocks(spark, d).where("n > 0").select("block", F.explode("per_class").alias("p")).select("block", "p.*")


@query("summary_results", f"""WITH {_SQL}, {_BLOCKS}, t AS (SELECT block, count(*) AS n, avg((a = b)::INT) AS po FROM b GROUP BY 1),
e AS (SELECT block, sum(n_a * n_b)::DOUBLE AS s FROM (SELECT block, a AS l, count(*) AS n_a FROM b GROUP BY ALL) JOIN (SELECT block, b AS l, count(*) AS n_b FROM b GROUP BY ALL) USING (block, l) GROUP BY 1)
SELECT block, n, round(po, 9) AS accuracy, round(CASE WHEN coalesce(s, 0) / (n * n) < 1 THEN (po - coalesce(s, 0) / (n * n)) / (1 - coalesce(s, 0) / (n * n)) ELSE 1 END, 9) AS cohen_kappa, (SELECT round(avg(coalesce(f1, 0)), 9) FROM u WHERE u.block = t.block AND support > 0) AS macro_f1 FROM t LEFT JOIN e USING (block)""")
def summary_results(spark, d):
    return _blocks(spark, d).where("n > 0").select("block", "n", *(F.round(c, 9).alias(c) for c in ("accuracy", "cohen_kappa", "macro_f1")))


@query("summary_confusion", f"WITH {_SQL}, {_BLOCKS} SELECT block, a AS gt, b AS ext, count(*) AS n FROM b WHERE list_contains(['success', 'failure', 'inconclusive', 'reversal'][:k], a) AND list_contains(['success', 'failure', 'inconclusive', 'reversal'][:k], b) GROUP BY ALL")
def summary_confusion(spark, d):
    return _blocks(spark, d).select("block", F.explode("confusion").alias("c")).select("block", "c.*").where("n > 0")


_AVG = lambda x, where: f"round(avg(({x})::INT) FILTER ({where}), 9)"


@query("summary_fields", f"""WITH {_SQL}, q AS (SELECT g_type AS a, e_type AS b FROM r WHERE typed AND NOT two), pe AS (SELECT sum(x * y)::DOUBLE / (SELECT count(*) FROM q) ** 2 AS pe FROM (SELECT a AS l, count(*) AS x FROM q GROUP BY 1) JOIN (SELECT b AS l, count(*) AS y FROM q GROUP BY 1) USING (l))
SELECT count(*) AS n, count_if(typed) AS n_typed, count_if(typed AND NOT two) AS n_4class, {_AVG("type_ok", "typed AND NOT two")} AS accuracy_4class, {_AVG("near_ok", "typed AND NOT two")} AS adjacent_accuracy, (SELECT round(((SELECT avg((a = b)::INT) FROM q) - pe) / (1 - pe), 9) FROM pe) AS kappa_4class, {_AVG("type_ok", "two")} AS accuracy_2class, count_if(two) AS n_2class,
count_if(g_doi <> '') AS n_doi, {_AVG("doi_ok", "g_doi <> ''")} AS doi_accuracy, {_AVG("e_doi = ''", "g_doi <> ''")} AS doi_missing, count_if(bib) AS n_bib, {_AVG("title_ok", "bib")} AS title_ok, {_AVG("name_ok", "bib")} AS authors_ok, {_AVG("name_ok", "bib")} AS year_ok, {_AVG("cited", "bib")} AS journal_ok, round(avg(cited::INT), 9) AS cited, {_AVG("name_ok", "cited")} AS cited_right,
count_if(g_result <> '' AND boundary) AS boundary_rows, count_if(g_result <> '' AND collapsed) AS collapsed, count_if(gran <> 'paper' AND NOT complete) > 0 AS lower_bound FROM r""")
def summary_fields(spark, d):
    r = lambda c, to: F.round(c, 9).alias(to)
    t, b = "replication_type", "bibliographic"
    return scoring.summary(_records(spark, d)).select(
        F.col("n_matched_rows").alias("n"), F.col(f"{t}.n").alias("n_typed"), f"{t}.n_4class", r(f"{t}.accuracy_4class", "accuracy_4class"), r(f"{t}.adjacent_accuracy", "adjacent_accuracy"), r(f"{t}.kappa_4class", "kappa_4class"), r(f"{t}.accuracy_2class_direct_or_close", "accuracy_2class"), f"{t}.n_2class",
        F.col("original_doi.n").alias("n_doi"), r("original_doi.accuracy", "doi_accuracy"), r("original_doi.ext_missing_rate", "doi_missing"), F.col(f"{b}.n").alias("n_bib"), *(r(f"{b}.{c}", c) for c in ("title_ok", "authors_ok", "year_ok", "journal_ok")), r("citation_sentence.present_rate", "cited"), r("citation_sentence.author_year_ok_rate", "cited_right"),
        F.col("boundary_rows_excluded").alias("boundary_rows"), F.col("collapse_applied_n").alias("collapsed"), F.col("precision_is_lower_bound").alias("lower_bound"),
    )


@query("summary_statistics", f"""WITH {_SQL}, s AS (SELECT 'original_n' AS field, w::DOUBLE AS g, (w + m % 3 - 1)::DOUBLE AS e, FALSE AS bad, FALSE AS apart FROM r UNION ALL SELECT 'original_es', (w % 100) / 100.0::DOUBLE, (w % 100) / 100.0::DOUBLE + (m % 4) * 0.03::DOUBLE, m % 5 = 0, FALSE FROM r
 UNION ALL SELECT 'original_p_value', (w % 10) / 100.0::DOUBLE, (m % 10) / 100.0::DOUBLE, FALSE, m % 2 = 1 FROM r UNION ALL SELECT 'replication_n', m::DOUBLE, NULL, FALSE, FALSE FROM r UNION ALL SELECT unnest(['replication_es', 'replication_p_value']), NULL, NULL, FALSE, FALSE FROM r),
t AS (SELECT *, abs(g - e) AS d, g IS NOT NULL AND e IS NOT NULL AS pair FROM s)
SELECT field, count(g) AS gt_has, count(e) AS ext_has, count_if(pair) AS both_present, count_if(g IS NOT NULL AND e IS NULL) AS gt_has_ext_missing, count_if(e IS NOT NULL AND g IS NULL) AS ext_has_gt_missing, count_if(pair AND bad) AS type_mismatch_unscored,
round(avg((CASE WHEN field LIKE '%_es' THEN d <= 0.01 WHEN field LIKE '%_n' THEN d < 0.5 ELSE d <= 1e-4 AND NOT apart END)::INT) FILTER (pair AND NOT bad), 9) AS tier1, round(avg((CASE WHEN field LIKE '%_es' THEN d <= 0.05 WHEN field LIKE '%_n' THEN d <= 0.05 * abs(g) ELSE d <= 1e-4 END)::INT) FILTER (pair AND NOT bad), 9) AS tier2,
round(avg((CASE WHEN field LIKE '%_es' THEN d <= 0.10 WHEN field LIKE '%_n' THEN d <= 0.2 * abs(g) ELSE (g < 0.05) = (e < 0.05) END)::INT) FILTER (pair AND NOT bad), 9) AS tier3 FROM t GROUP BY field""")
def summary_statistics(spark, d):
    return scoring.summary(_records(spark, d)).select(F.explode("statistics").alias("s")).select("s.*").withColumns({c: F.round(c, 9) for c in ("tier1", "tier2", "tier3")})


@query("headline_intervals")
def headline_intervals(spark, d):
    """Intervals of the eight headline metrics, resampling papers; tests hold them against plain Python with the same weights."""
    return scoring.intervals(_records(spark, d))


_SETS = "g AS (SELECT DISTINCT paper, g_doi AS item FROM r WHERE g_doi <> ''), e AS (SELECT DISTINCT paper, e_canon AS item FROM r WHERE e_canon <> ''), n AS (SELECT paper, count(DISTINCT g.item) AS n_gt, count(e.item) AS tp, (SELECT count(*) FROM e y WHERE y.paper = g.paper) AS n_ext FROM g LEFT JOIN e USING (paper, item) GROUP BY paper), h AS (SELECT DISTINCT g.paper FROM g JOIN e USING (paper) WHERE (length(g.item) >= 12 AND e.item LIKE g.item || '%' AND length(e.item) - length(g.item) <= 3) OR (length(e.item) >= 12 AND g.item LIKE e.item || '%' AND length(g.item) - length(e.item) <= 3))"


def _sets(spark, d):
    gt, ext, aliases, _, _ = _entries(spark, d)
    from curata.operators.matching import canonical

    g, e = canonical(gt, "g_doi", aliases, "item").where("item <> ''"), canonical(ext, "e_doi", aliases, "item").where("item <> ''")
    return g.select("paper", "item"), e.select("paper", "item"), ext.where("e_doi = ''").groupBy("paper").agg(F.count("*").alias("n"))


@query("set_extras", f"WITH {_SQL}, {_SETS} SELECT round(avg((h.paper IS NOT NULL)::INT), 9) AS hit_rate_lenient, round(avg((tp > 0)::INT) FILTER (n_ext > 0), 9) AS hit_rate_when_extracted, count_if(n_ext = 0) AS extracted_none, (SELECT count(*) FROM r WHERE e_doi = '' AND paper IN (SELECT paper FROM g)) AS ext_rows_without_doi FROM n LEFT JOIN h USING (paper)")
def set_extras(spark, d):
    g, e, without = _sets(spark, d)
    row = metrics.set_extras(metrics.set_scores(g, e, "paper", "item"), metrics.lenient(g, e, "paper", "item"), "paper", without)
    return row.withColumns({c: F.round(c, 9) for c in ("hit_rate_lenient", "hit_rate_when_extracted")})


@query("set_intervals")
def set_intervals(spark, d):
    """Intervals of the five rates of set scores; tests hold them against plain Python with the same weights."""
    g, e, _ = _sets(spark, d)
    return metrics.set_intervals(metrics.set_scores(g, e, "paper", "item"), "paper")


@query("enhanced_labels")
def enhanced_labels(spark, d):
    """Labels of papers of four with what entries fill and add; tests hold it against plain Python."""
    from curata.operators import gold

    gt, ext, *_ = _entries(spark, d)
    return gold.enhanced(gt, ext, ["doi", "journal", "original_es", "replication_n"])


_REPORT = "s AS (SELECT paper, m % 4 = 0 AS lost, m % 4 = 1 AS spare, g_result, ext FROM r)"


@query("report_tables", f"WITH {_SQL}, {_REPORT} SELECT 'matched' AS name, count_if(NOT lost AND NOT spare) AS n FROM s UNION ALL SELECT 'disagreements', count_if(NOT lost AND NOT spare AND g_result <> '' AND g_result <> ext) FROM s UNION ALL SELECT 'unmatched', count_if(lost) FROM s UNION ALL SELECT 'extra', count_if(spare) FROM s UNION ALL SELECT 'per_paper', count(DISTINCT paper) FROM s")
def report_tables(spark, d):
    """Rows of the five tables of a scoring run, as observed while they are written."""
    from curata.functions.storage import new_folder

    gt, ext, aliases, matches, papers = _entries(spark, d)
    kind = gt.select("paper", "gt", (F.length("g_description") % 4).alias("k"))
    matched = matches.join(kind.where("k > 1"), ["paper", "gt"], "left_semi")
    records = scoring.scored(matched, gt, ext, aliases, papers)
    none = F.lit(None).cast("long")
    outcomes = matched.select("paper", F.lit("match").alias("outcome"), "gt", "ext").unionByName(kind.where("k = 0").select("paper", F.lit("gt_unmatched").alias("outcome"), "gt", none.alias("ext")))
    outcomes = outcomes.unionByName(kind.where("k = 1").select("paper", F.lit("ext_unmatched").alias("outcome"), none.alias("gt"), F.col("gt").alias("ext")))
    found = scoring.write_reports(scoring.reports(outcomes, records, gt, ext), new_folder(spark, "reports"))
    return spark.createDataFrame(sorted(found.items()), "name string, n long")
