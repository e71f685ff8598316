"""Queries of auditing, review and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from curata.operators import extraction, review
from curata.plans import fixtures as fx
from curata.plans.catalogue import query, table

docs = lambda spark, d: table(spark, d, "documents")


@query("duplicate_rows", "SELECT doc_id, first FROM (SELECT doc_id, row_number() OVER w AS n, first_value(doc_id) OVER w AS first FROM documents WINDOW w AS (PARTITION BY text ORDER BY doc_id)) WHERE n > 1")
def duplicate_rows(spark, d):
    return review.duplicates(docs(spark, d), "doc_id", ["text"])


@query("field_conflicts", "SELECT l_orderkey, 'l_returnflag' AS field, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY 1 HAVING n > 1 UNION ALL SELECT l_orderkey, 'l_linestatus', count(DISTINCT l_linestatus) AS n FROM lineitem GROUP BY 1 HAVING n > 1")
def field_conflicts(spark, d):
    return review.conflicts(table(spark, d, "lineitem"), "l_orderkey", ["l_returnflag", "l_linestatus"])


@query("enumeration_agreement", "SELECT conv_id, count_if(role = 'user') AS n_a, count_if(role = 'assistant') AS n_b, count_if(role = 'user') = count_if(role = 'assistant') AS equal FROM conversations GROUP BY 1")
def enumeration_agreement(spark, d):
    return review.enumeration(table(spark, d, "conversations"), "conv_id", "role", ("user", "assistant"))


@query("frame_composition", "SELECT source, lang, count(*) AS n FROM documents GROUP BY CUBE (source, lang)")
def frame_composition(spark, d):
    return docs(spark, d).cube("source", "lang").agg(F.count("*").alias("n"))


@query("truth_audit", "SELECT doc_id, CASE WHEN n > 1 THEN 'duplicate_row' WHEN doc_id % 7 = 0 THEN 'no_original' WHEN doc_id % 5 = 0 THEN 'doi_unknown' WHEN doc_id % 3 = 0 AND coalesce(c, FALSE) THEN 'mismatch_resolved' WHEN doc_id % 3 = 0 THEN 'mismatch' WHEN NOT coalesce(c, TRUE) THEN 'not_cited' ELSE 'ok' END AS finding FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n, CASE WHEN length(text) >= 2000 THEN contains(lower(text), 'hein') END AS c FROM documents)")
def truth_audit(spark, d):
    rows = docs(spark, d)
    rows = rows.join(review.duplicates(rows, "doc_id", ["text"]), "doc_id", "left")
    i = F.col("doc_id")
    c = review.cited(F.col("text"), F.lit(""), F.array(F.lit("hein")), 2000)
    return rows.select("doc_id", review.finding(F.col("first").isNotNull(), F.when(i % 7 != 0, "x"), i % 5 != 0, c, i % 3 != 0).alias("finding"))


@query("decision_errors", "SELECT doc_id, array_to_string(list_filter([CASE WHEN lang = 'de' THEN 'bad language' END, CASE WHEN n_chars < 500 THEN 'too short' END, CASE WHEN source = 'src1' THEN 'wrong source' END], lambda x: x IS NOT NULL), '; ') AS errors FROM documents")
def decision_errors(spark, d):
    e = review.errors(("wrong source", F.col("source") == "src1"), ("too short", F.col("n_chars") < 500), ("bad language", F.col("lang") == "de"), ("too short", F.col("n_chars") < 500))
    return docs(spark, d).select("doc_id", F.array_join(e, "; ").alias("errors"))


@query("import_reasons", f"WITH {fx.CANDIDATES}, {fx.NORMED} SELECT seq, CASE WHEN nd IS NULL THEN 'not a DOI' WHEN row_number() OVER (PARTITION BY doi, source_query ORDER BY seq) > 1 THEN 'duplicate' END AS reason FROM normed")
def import_reasons(spark, d):
    from curata.functions.ids import normalize_doi

    return review.imported(fx.candidates(spark, d), normalize_doi(F.col("doi")), ["doi", "source_query"], "seq").select("seq", "reason")


@query("run_recovery", "SELECT n_regionkey AS run, 5::BIGINT AS logged, count_if(n_nationkey % 7 <> 3) AS counted, count_if(n_nationkey % 7 <> 3) = 5 AS accepted FROM nation GROUP BY 1")
def run_recovery(spark, d):
    n = table(spark, d, "nation").select(F.col("n_regionkey").alias("run"), (F.col("n_nationkey") % 7 == 3).alias("marked"))
    logs = table(spark, d, "region").select(F.col("r_regionkey").alias("run"), F.explode(F.array(F.lit("start"), F.lit("coded 5 rows"))).alias("line"))
    return review.recovered(n, logs, "run", r"coded (\d+) rows")


@query("review_packets", "SELECT conv_id, count(*)::INT AS n, string_agg(role, ',' ORDER BY turn, role, text) AS roles FROM conversations GROUP BY 1")
def review_packets(spark, d):
    p = review.packets(table(spark, d, "conversations"), "conv_id", "turn", ["role", "text"])
    return p.select("conv_id", "n", F.array_join("candidates.role", ",").alias("roles"))


@query("decisions_kept", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'started' ELSE 'new' END AS content FROM documents")
def decisions_kept(spark, d):
    old = docs(spark, d).where("doc_id % 3 <> 0 or doc_id % 2 = 0").select("doc_id", F.when(F.col("doc_id") % 2 == 0, "started").otherwise("template").alias("content"))
    return review.refreshed(old, docs(spark, d).select("doc_id", F.lit("new").alias("content")), "doc_id", F.col("content") == "template")


@query("blinded_sheet", "SELECT n_regionkey AS row_id, unnest(list_sort(list(n_nationkey::VARCHAR))) AS anchor FROM nation GROUP BY 1")
def blinded_sheet(spark, d):
    rows = table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("row_id")).agg(F.array_join(F.collect_list(F.col("n_nationkey").cast("string")), " ; ").alias("ids"), F.max("n_name").alias("result"))
    out = review.sheet(rows, "ids", ["row_id"])
    if extraction.wrong_schema_fields(out.schema, {"row_id", "anchor"}):
        raise ValueError("the sheet isn't blind")
    return out


@query("label_completeness", "SELECT source AS unit, count_if(quality IS NULL) = 0 AND coalesce(bool_and(toxic = 0), FALSE) AS complete FROM (SELECT d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.doc_id IN (SELECT doc_id FROM labels) OR d.source IN ('src1', 'src2')) GROUP BY 1")
def label_completeness(spark, d):
    j = docs(spark, d).join(table(spark, d, "labels"), "doc_id", "left")
    wanted = j.where("quality is not null or source in ('src1', 'src2')").select(F.col("source").alias("unit"), F.col("doc_id").alias("row"))
    given = j.where("quality is not null").select(F.col("source").alias("unit"), F.col("doc_id").alias("row"), F.when(F.col("toxic") == 0, "fine").otherwise("odd").alias("label"))
    return review.complete(given, wanted, "unit", "row", ["fine"])


@query("outcome_transcription", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'failure' ELSE 'it worked' END AS outcome FROM documents")
def outcome_transcription(spark, d):
    return docs(spark, d).select("doc_id", review.transcribed(F.when(F.col("doc_id") % 2 == 0, "A clear FAILURE to see it").otherwise(" It worked ")).alias("outcome"))


@query("headline_summary", f"WITH {fx.OUTCOMES} SELECT count(*) AS n, avg((gt = ext)::INT) AS accuracy, avg((gt = ext)::INT) FILTER (row % 5 <> 0) AS accuracy_clear, count_if(row % 5 = 0) AS n_boundary, avg((row % 3 = 0)::INT) FILTER (row % 2 = 0) AS type_accuracy, avg((row % 4 <> 1)::INT) AS doi_accuracy FROM outcomes")
def headline_summary(spark, d):
    r = F.col("row")
    return review.summary(fx.outcomes(spark, d).select("gt", "ext", F.when(r % 2 == 0, r % 3 == 0).alias("type_ok"), (r % 4 != 1).alias("doi_ok"), (r % 5 == 0).alias("boundary")))


@query("retest_agreement", f"WITH {fx.OUTCOMES}, a AS (SELECT paper, count(*) AS x FROM outcomes GROUP BY 1), b AS (SELECT paper, count(*) AS y FROM outcomes WHERE row % 10 <> 0 OR paper < 'src2' GROUP BY 1) SELECT (SELECT avg((x = coalesce(y, 0))::INT) FROM a LEFT JOIN b USING (paper)) AS same_count, (SELECT avg((gt = ext)::INT) FROM outcomes) AS agreement, (SELECT count(*) FROM outcomes) AS n_matched")
def retest_agreement(spark, d):
    o = fx.outcomes(spark, d)
    return review.retest(o.select(F.col("gt").alias("a"), F.col("ext").alias("b")), o, o.where("row % 10 <> 0 or paper < 'src2'"), "paper")


@query("match_audit", f"WITH {fx.OUTCOMES} SELECT lang AS confidence, avg((row % 3 <> 0)::INT) FILTER (gt = ext) AS precision, avg((row % 3 <> 0)::INT) FILTER (gt <> ext) AS correct_non_matches FROM outcomes GROUP BY 1")
def match_audit(spark, d):
    o = fx.outcomes(spark, d)
    return review.match_audit(o.select(F.col("lang").alias("confidence"), (F.col("gt") == F.col("ext")).alias("matched"), (F.col("row") % 3 != 0).alias("verdict")))


@query("changelog_parse", "SELECT r_name AS section, n_name AS file, substr(md5(n_name), 1, 12) AS sha FROM nation JOIN region ON n_regionkey = r_regionkey")
def changelog_parse(spark, d):
    r = table(spark, d, "region").select((F.col("r_regionkey") * 1000).alias("no"), F.concat(F.lit("## "), "r_name").alias("line"))
    n = table(spark, d, "nation").select((F.col("n_regionkey") * 1000 + 1 + F.col("n_nationkey")).alias("no"), F.concat(F.lit("| "), "n_name", F.lit(" | "), F.substring(F.md5("n_name"), 1, 12), F.lit(" |")).alias("line"))
    return review.changelog(r.union(n).union(spark.createDataFrame([(-1, "| file | sha |")], "no long, line string")))


@query("case_descriptions", "SELECT l_orderkey, first('d' || l_linenumber || '-' || l_partkey ORDER BY (l_returnflag <> 'R')::INT, l_linenumber, l_partkey, l_suppkey, l_extendedprice) FILTER (l_linenumber <> 2) AS description FROM lineitem GROUP BY 1")
def case_descriptions(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("seq"), F.when(F.col("l_linenumber") != 2, F.concat(F.lit("d"), F.col("l_linenumber").cast("string"), F.lit("-"), F.col("l_partkey").cast("string"))).otherwise(" ").alias("description"), F.col("l_returnflag").alias("result"), F.lit("R").alias("case_result"))
    return review.best_description(rows, "l_orderkey", "seq")


@query("batch_totals", "SELECT role AS kind, count(*) AS n, sum(length(text))::BIGINT AS tokens, sum(turn)::BIGINT AS cost FROM conversations GROUP BY 1")
def batch_totals(spark, d):
    return review.totals(table(spark, d, "conversations").select(F.col("role").alias("kind"), F.length("text").cast("long").alias("tokens"), F.col("turn").alias("cost")))


@query("pending_work", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_work(spark, d):
    return review.pending(docs(spark, d).select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("discipline_override", "SELECT doc_id, CASE WHEN quality = 0 THEN 'reviewed' ELSE lang END AS lang FROM documents LEFT JOIN labels USING (doc_id)")
def discipline_override(spark, d):
    o = table(spark, d, "labels").where("quality = 0").select("doc_id", F.lit("reviewed").alias("lang"))
    return review.overridden(docs(spark, d).select("doc_id", "lang"), o, "doc_id", "lang")
