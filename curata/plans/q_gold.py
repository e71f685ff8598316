"""Queries of the staged matcher, truth tables, recorded searches and small predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from curata.functions import text
from curata.functions.storage import new_folder
from curata.operators import catalog, extraction, gold, matching, resolve, review
from curata.plans.catalogue import query, table
from curata.sources import readers, sinks

docs = lambda spark, d: table(spark, d, "documents")


def _s(c):
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


# staged matcher: four labels and four entries a paper, one case each

_PAPER = "p AS (SELECT DISTINCT doc_id // 4 AS p FROM documents)"


def _papers(spark, d):
    return docs(spark, d).select(F.expr("doc_id div 4").alias("p")).distinct()


def _labels(spark, d):
    """n = 0: one DOI; 1: an alias of it; 2: only a verdict can tell; 3: authors and year, if at all."""
    rows = _papers(spark, d).withColumn("n", F.explode(F.array(*map(F.lit, range(4))))).withColumn("k", F.concat_ws(".", _s("p"), _s("n")))
    n, shared = F.col("n"), F.md5(F.col("k"))
    def side(p, key, doi, title, year):
        return rows.select(_s("p").alias("paper"), n.cast("long").alias(key), doi.alias(f"{p}_doi"), F.concat(F.lit("claim "), shared).alias(f"{p}_description"), title.alias(f"{p}_title"), F.concat(F.lit("Name"), _s("n")).alias(f"{p}_authors"), year.alias(f"{p}_year"))

    at = lambda kind: F.concat(F.lit(f"10.1000/{kind}"), F.col("k"))
    year = (1900 + n).cast("string")
    gt = side("g", "gt", F.when(n < 2, at("x")).otherwise(""), F.concat(F.lit("g"), shared), year)
    ext = side("e", "ext", F.when(n == 0, at("x")).when(n == 1, at("pre")).otherwise(""), F.concat(F.lit("-"), F.md5(shared)), F.when((n == 2) | ((n == 3) & (F.col("p") % 2 == 1)), "1800").otherwise(year))
    aliases = rows.where("n = 1").select(F.col("p").alias("seq"), at("pre").alias("alias"), at("x").alias("canonical"), F.lit("preprint").alias("kind"))
    c = F.col("p") % 3
    verdicts = rows.where("n >= 2").select(_s("p").alias("paper"), n.cast("long").alias("gt"), F.when(n == 2, F.lit(2)).cast("long").alias("ext"), F.when(n == 3, "none").when(c == 0, "same_effect").when(c == 1, "same_original_other_effect").otherwise("different_original").alias("relation"), F.when(c == 0, "medium").otherwise("high").alias("confidence"), F.lit("read").alias("reason"), (n == 3).alias("failed"))
    return gt, ext, aliases, verdicts


@query("staged_match", f"""WITH {_PAPER}, x AS (
 SELECT p, 'match' AS outcome, 0 AS gt, 0 AS ext, 'doi' AS method, 'high' AS confidence, 0.0 AS cost, 'original DOI equal' AS reason FROM p
 UNION ALL SELECT p, 'match', 1, 1, 'doi', 'high', 0.0, 'same work under two DOIs (preprint): 10.1000/x' || p || '.1 = 10.1000/pre' || p || '.1' FROM p
 UNION ALL SELECT p, 'match', 2, 2, 'llm', 'medium', 0.4, 'read' FROM p WHERE p % 3 = 0
 UNION ALL SELECT p, CASE p % 3 WHEN 1 THEN 'granularity_miss' ELSE 'wrong_original' END, 2, 2, NULL, 'high', NULL, 'read' FROM p WHERE p % 3 > 0
 UNION ALL SELECT p, 'match', 3, 3, 'fuzzy', 'low', 0.6, 'fuzzy 2/3 (title/authors/year)' FROM p WHERE p % 2 = 0
 UNION ALL SELECT p, unnest(['gt_unmatched', 'ext_unmatched']), unnest([2, NULL]), unnest([NULL, 2]), NULL, NULL, NULL, NULL FROM p WHERE p % 3 > 0
 UNION ALL SELECT p, unnest(['gt_unmatched', 'ext_unmatched']), unnest([3, NULL]), unnest([NULL, 3]), NULL, NULL, NULL, NULL FROM p WHERE p % 2 = 1)
 SELECT p::VARCHAR AS paper, outcome, gt::BIGINT AS gt, ext::BIGINT AS ext, method, confidence, cost::DOUBLE AS cost, reason FROM x""")
def staged_match(spark, d):
    """DOIs, aliases, recorded verdicts, then authors and year, for all documents as labels of papers of four."""
    return matching.staged(*_labels(spark, d)).drop("relation")


@query("alias_kinds", f"WITH {_PAPER} SELECT p::VARCHAR AS paper, n::BIGINT AS gt, CASE n WHEN 1 THEN 'preprint' ELSE 'alias' END AS kind FROM p, (SELECT unnest([0, 1, 2, 3]) AS n)")
def alias_kinds(spark, d):
    gt, ext, aliases, _ = _labels(spark, d)
    pairs = gt.select("paper", "gt", "g_doi").join(ext.select("paper", F.col("ext").alias("gt"), "e_doi"), ["paper", "gt"])
    return matching.alias_kind(pairs, "g_doi", "e_doi", aliases).select("paper", "gt", "kind")


def _coded(spark, d):
    """Three entries a paper of each coder; the third is described quite otherwise by the second."""
    rows = docs(spark, d).select(F.expr("doc_id div 3").cast("string").alias("paper"), (F.col("doc_id") % 3).alias("n"), F.md5(_s("doc_id")).alias("x"))
    a = rows.select("paper", F.concat_ws("#", "paper", _s("n"), F.lit("a")).alias("a"), F.concat(F.lit("The authors claimed that "), "x").alias("description"))
    b = rows.select("paper", F.concat_ws("#", "paper", _s("n"), F.lit("b")).alias("b"), F.when(F.col("n") == 2, F.md5("x")).otherwise(F.col("x")).alias("description"))
    return a, b


@query("described_alike", "SELECT (doc_id // 3)::VARCHAR AS paper, doc_id // 3 || '#' || doc_id % 3 || '#a' AS a, doc_id // 3 || '#' || doc_id % 3 || '#b' AS b, 1.0::DOUBLE AS score FROM documents WHERE doc_id % 3 < 2")
def described_alike(spark, d):
    """Mutual best pairs of two coders' entries by the description's words and difflib's ratio; digests are equal or far apart."""
    return matching.described_alike(*_coded(spark, d))


@query("one_sided_entries", "SELECT doc_id // 3 || '#2#' || c AS key, 'row_exists' AS field, 'unmatched coder ' || c || ' entry; identity unresolved' AS reason, CASE c WHEN 'a' THEN 'present' ELSE '' END AS a_value, CASE c WHEN 'b' THEN 'present' ELSE '' END AS b_value FROM documents, (SELECT unnest(['a', 'b']) AS c) WHERE doc_id % 3 = 2")
def one_sided_entries(spark, d):
    a, b = _coded(spark, d)
    return matching.one_sided(a, b, matching.described_alike(a, b))


@query("negative_disagreements", "SELECT doc_id || '#neg' AS key, 'is_replication_paper' AS field, 'disagreement' AS reason, CASE WHEN quality = 1 THEN ' No' ELSE 'yes' END AS a_value, CASE WHEN toxic = 1 THEN 'yes' ELSE 'no' END AS b_value FROM labels WHERE doc_id % 2 = 0 AND (quality = 1) = (toxic = 1)")
def negative_disagreements(spark, d):
    rows = table(spark, d, "labels").withColumn("key", F.concat(_s("doc_id"), F.when(F.col("doc_id") % 2 == 0, "#neg").otherwise("")))
    a = rows.select("key", F.when(F.col("quality") == 1, " No").otherwise("yes").alias("value"))
    return matching.negative_disagreements(a, rows.select("key", F.when(F.col("toxic") == 1, "yes").otherwise("no").alias("value")))


@query("aligned_sheet", """WITH x AS (SELECT conv_id AS p, turn AS n, count(*) OVER (PARTITION BY conv_id) AS k, min(turn) OVER (PARTITION BY conv_id) AS first FROM conversations)
 SELECT p AS paper, n AS gt, n AS ext, 1.0::DOUBLE AS score, '' AS note FROM x WHERE k > 1 AND n % 2 = 0
 UNION ALL SELECT p, n, n, NULL, '' FROM x WHERE k = 1
 UNION ALL SELECT p, n, NULL, NULL, 'no entry matched this anchor' FROM x WHERE k > 1 AND n % 2 = 1
 UNION ALL SELECT p, NULL, n, NULL, 'extra entry, not in the external record' FROM x WHERE k > 1 AND n % 2 = 1""")
def aligned_sheet(spark, d):
    """Turns as sheet rows and as entries: even ones have one title, odd ones none in common, unless the only one of its paper."""
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("paper"), "turn", F.md5(F.concat_ws(".", _s("conv_id"), _s("turn"))).alias("x"))
    alone = c.groupBy("paper").agg((F.count("*") == 1).alias("alone"))
    c = c.join(alone, "paper")
    far = F.col("alone") | (F.col("turn") % 2 == 1)
    return matching.aligned(c.select("paper", F.col("turn").alias("gt"), F.col("x").alias("hint")), c.select("paper", F.col("turn").alias("ext"), F.when(far, F.concat(F.lit("--"), F.substring(F.md5("x"), 1, 9))).otherwise(F.col("x")).alias("title"))).withColumn("paper", F.col("paper").cast("long"))


# truth tables

_SHEET = """sheet AS (SELECT doc_id, CASE WHEN doc_id % 10 = 9 THEN doc_id || '#neg' ELSE doc_id || '#1' END AS row_id, 'f' || doc_id % 50 AS folder, '10.1000/p' || doc_id % 50 AS doi, CASE WHEN doc_id % 7 = 0 THEN '' WHEN quality = 1 THEN 'success' ELSE 'failure' END AS result, CASE WHEN toxic = 1 THEN 'yes' ELSE 'no' END AS is_rep FROM labels),
 split AS (SELECT *, CASE WHEN ('0x' || substr(sha256('salt:' || doi), 1, 8))::BIGINT / 4294967296.0 < 0.6 THEN 'test' ELSE 'dev' END AS split FROM sheet WHERE doc_id % 11 <> 0)"""


def _gold(spark, d):
    rows = table(spark, d, "labels")
    i = F.col("doc_id")
    row_id = F.concat(_s("doc_id"), F.when(i % 10 == 9, "#neg").otherwise("#1"))
    sheet = rows.select(row_id.alias("row_id"), F.concat(F.lit("f"), _s(i % 50)).alias("paper_folder"), F.when(i % 2 == 0, F.concat(F.lit("10.1000/p"), _s(i % 50))).otherwise("").alias("replication_doi"), F.when(F.col("toxic") == 1, "yes").otherwise("no").alias("is_replication_paper"), F.lit("why").alias("why_negative"), F.when(i % 4 == 0, "ambiguous").otherwise("").alias("gt_ambiguity"), F.when(i % 7 == 0, "").when(F.col("quality") == 1, "success").otherwise("failure").alias("result"))
    frame = spark.range(50).select(F.concat(F.lit("f"), _s("id")).alias("paper_folder"), F.concat(F.lit("10.1000/p"), _s("id")).alias("replication_doi"), F.lit("frame").alias("source"))
    ask = lambda cond, seq, reason, field, value, by, note, ambiguity: rows.where(cond).select(F.lit(seq).alias("seq"), row_id.alias("row_id"), F.lit(field).alias("field"), F.lit(reason).alias("reason"), F.lit(value).alias("adjudicated_value"), F.lit(by).alias("adjudicator_id"), F.lit(note).alias("adjudication_note"), F.lit(ambiguity).alias("gt_ambiguity"))
    queue = ask("doc_id % 3 = 0", 1, "disagreement", "result", "reversal", "ann", "first", "clear").unionByName(ask("doc_id % 3 = 0 and doc_id % 2 = 0", 2, "audit_sample", "replication_type", "", "bo", "second", "ambiguous")).unionByName(ask("doc_id % 11 = 0", 3, "disagreement", "result", "", "", "", "")).unionByName(ask("doc_id % 10 = 9 and doc_id % 3 = 1", 4, "disagreement", "is_replication_paper", "N", "cy", "", "clear"))
    return gold.build(sheet, frame, queue, ["result"], "coder1", "salt", allow_unadjudicated=True)


@query("gold_rows", f"WITH {_SHEET} SELECT row_id, doi AS replication_doi, folder AS paper_folder, 'frame' AS source, CASE WHEN doc_id % 3 = 0 THEN 'human:adjudicated' ELSE 'single_coder:coder1' END AS provenance, split, CASE WHEN doc_id % 3 = 0 THEN 'reversal' ELSE result END AS result, CASE WHEN doc_id % 4 = 0 OR doc_id % 6 = 0 THEN 'ambiguous' ELSE 'clear' END AS gt_ambiguity, CASE WHEN doc_id % 6 = 0 THEN 'ann;bo' WHEN doc_id % 3 = 0 THEN 'ann' ELSE '' END AS adjudicator_id, CASE WHEN doc_id % 6 = 0 THEN 'first | second' WHEN doc_id % 3 = 0 THEN 'first' ELSE '' END AS adjudication_note FROM split WHERE doc_id % 10 <> 9 AND result <> ''")
def gold_rows(spark, d):
    return _gold(spark, d)[0]


@query("gold_negatives", f"WITH {_SHEET} SELECT doi AS replication_doi, folder AS paper_folder, 'frame' AS source, CASE WHEN doc_id % 3 = 1 OR is_rep = 'no' THEN 'negative' ELSE 'positive_reclassified' END AS label, 'why' AS why_negative, split, CASE WHEN doc_id % 3 IN (0, 1) THEN 'human:adjudicated' ELSE 'single_coder:coder1' END AS provenance FROM split WHERE doc_id % 10 = 9")
def gold_negatives(spark, d):
    return _gold(spark, d)[1]


def _decisions(spark, d):
    i = F.col("doc_id")
    effect = lambda n, url, ref: F.struct(F.lit(n).alias("effect_id"), url.alias("original_url"), ref.alias("original_reference"), F.lit("success").alias("result"))
    effects = F.array(effect("e1", F.lit("10.1/a"), F.lit("x")), effect("e2", F.lit(""), F.when(i % 2 == 0, "10.1/b").otherwise("a b/c")))
    return docs(spark, d).select(F.concat(F.lit("f"), _s(i)).alias("folder"), F.concat(F.lit("10.1000/"), _s(i)).alias("replication_doi"), (i % 10 == 0).alias("untouched"), F.when(i % 10 == 1, "ai").otherwise("human").alias("reviewer_kind"), (i % 10 != 2).alias("valid"), F.when(i % 10 == 3, "negative").when(i % 10 == 4, "unclear").otherwise("positive").alias("eligibility"), F.lit("no study").alias("reason"), F.lit(" Ann Lee ").alias("reviewer"), F.lit("m1").alias("model"), effects.alias("effects"))


@query("export_rows", "SELECT 'f' || doc_id || '#' || e AS row_id, 'f' || doc_id AS folder, '10.1000/' || doc_id AS replication_doi, 'human:ann_lee' AS provenance, CASE WHEN e = 'e1' THEN '10.1/a' WHEN doc_id % 2 = 0 THEN '10.1/b' ELSE '' END AS original_url, 'success' AS result FROM documents, (SELECT unnest(['e1', 'e2']) AS e) WHERE doc_id % 10 > 4")
def export_rows(spark, d):
    return gold.export(_decisions(spark, d), "human")[0]


@query("export_negatives", "SELECT 'f' || doc_id AS folder, '10.1000/' || doc_id AS replication_doi, 'human:ann_lee' AS provenance, CASE doc_id % 10 WHEN 3 THEN 'negative' ELSE 'excluded' END AS label, 'no study' AS why_negative FROM documents WHERE doc_id % 10 IN (3, 4)")
def export_negatives(spark, d):
    return gold.export(_decisions(spark, d), "human")[1]


@query("export_skipped", "SELECT CASE doc_id % 10 WHEN 0 THEN 'unreviewed' WHEN 1 THEN 'other_kind' ELSE 'invalid' END AS reason, count(*) AS n FROM documents WHERE doc_id % 10 < 3 GROUP BY 1")
def export_skipped(spark, d):
    return gold.export(_decisions(spark, d), "human")[2]


@query("truth_rows", "SELECT 'r' || doc_id AS row_id, '10.1000/p' || doc_id AS replication_doi, '10.1000--p' || doc_id AS paper_folder, 'external:mine' AS source, 'human:a' AS provenance, CASE doc_id % 3 WHEN 0 THEN 'dev' ELSE 'all' END AS split, 'success' AS result, (SELECT count(*) FROM labels WHERE quality = 0) AS n_negatives FROM labels WHERE doc_id % 3 < 2")
def truth_rows(spark, d):
    """A set of labels written as CSV with a manifest, loaded through its guards for one split."""
    folder, rows, i = new_folder(spark, "truth"), table(spark, d, "labels"), F.col("doc_id")
    sinks.write_csv(rows.select(F.concat(F.lit("r"), _s(i)).alias("row_id"), F.concat(F.lit("https://doi.org/10.1000/P"), _s(i)).alias("replication_url"), F.lit("human:a").alias("provenance"), F.when(i % 3 == 0, "dev").when(i % 3 == 1, "").otherwise("test").alias("split"), F.lit(" Success").alias("result")), f"{folder}/rows", ["row_id", "replication_url", "provenance", "split", "result"])
    sinks.write_csv(rows.select(_s(i).alias("replication_doi"), F.when(F.col("quality") == 0, "Negative").otherwise("positive").alias("label")), f"{folder}/negatives", ["replication_doi", "label"])
    spec = gold.Spec(f"{folder}/rows", f"{folder}/negatives", "external:mine", manifest={p: gold.contents(spark, p) for p in (f"{folder}/rows", f"{folder}/negatives")})
    found, negatives, _ = gold.truth(spark, spec, split="dev")
    n = negatives.agg(F.count("*").alias("n_negatives"))  # one row
    return found.select("row_id", "replication_doi", "paper_folder", "source", "provenance", "split", "result").join(F.broadcast(n))


@query("reversal_collapse", "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'success' WHEN doc_id % 2 = 0 THEN 'reversal' ELSE 'failure' END AS result FROM documents")
def reversal_collapse(spark, d):
    i = F.col("doc_id")
    return docs(spark, d).select("doc_id", text.collapsed_result(F.when(i % 4 == 0, "Success ").otherwise(" Reversal"), i % 2 == 0).alias("result"))


_OLD = """x AS (SELECT doc_id, doc_id // 2 AS pair, doc_id % 13 = 12 AS self, CASE doc_id % 3 WHEN 0 THEN 'external:service' WHEN 1 THEN 'human:one' ELSE 'unknown' END AS provenance, doc_id // 2 % 5 AS k, doc_id % 2 AS h FROM documents),
 y AS (SELECT *, count(*) OVER (PARTITION BY pair, self, CASE WHEN self THEN doc_id END) AS n, row_number() OVER (PARTITION BY pair, self, CASE WHEN k = 0 THEN 0 ELSE h END ORDER BY doc_id) AS r FROM x)"""


@query("legacy_split", f"""WITH {_OLD} SELECT doc_id AS seq, provenance, CASE WHEN self THEN 'self_replication' WHEN r > 1 THEN 'duplicate' WHEN provenance = 'external:service' THEN 'external' ELSE 'human' END AS part,
 CASE WHEN NOT self AND NOT r > 1 AND n > 1 THEN 'several effects of one pair' ELSE '' END AS fix_note, CASE WHEN NOT self AND n = 1 THEN CASE WHEN doc_id % 7 = 0 THEN 'failure' ELSE 'success' END ELSE '' END AS result_before, CASE WHEN NOT self AND n = 1 AND doc_id % 7 = 0 THEN 'yes' ELSE '' END AS needs_adjudication FROM y""")
def legacy_split(spark, d):
    """Pairs of documents as rows of one pair of studies, some of them exact repeats, some of a study with itself."""
    i, pair = F.col("doc_id"), F.expr("doc_id div 2")
    self_ = i % 13 == 12
    doi = lambda kind: F.concat(F.lit(f"10.1000/{kind}"), _s(pair))
    own = F.concat(F.lit("10.1000/s"), _s(i))
    person = F.element_at(F.array(*map(F.lit, ["service", "person one", "someone"])), (i % 3 + 1).cast("int"))
    rows = docs(spark, d).select(i.alias("seq"), F.when(self_, own).otherwise(doi("o")).alias("original_url"), F.when(self_, F.concat(F.lit("https://doi.org/"), own)).otherwise(doi("r")).alias("replication_url"), F.when(pair % 5 == 0, " Same").otherwise(F.concat(F.lit("d"), _s(i % 2))).alias("description"), F.lit("Success").alias("result"), person.alias("validated_person"))
    earlier = rows.select("original_url", "replication_url", F.when(F.col("seq") % 7 == 0, "failure").otherwise(" success").alias("result"))
    people = rows.select(F.col("validated_person").alias("person")).distinct().withColumn("provenance", F.when(F.col("person") == "service", "external:service").when(F.col("person") == "person one", "human:one")).where("provenance is not null")
    return gold.legacy_split(rows, earlier, people)


@query("best_candidates", "WITH x AS (SELECT conv_id AS p, turn AS n, count(*) OVER (PARTITION BY conv_id) AS k FROM conversations) SELECT p AS paper, n AS ext, k AS n_candidates, n AS gt, 3 AS score, 1.0::DOUBLE AS title, 1.0::DOUBLE AS authors, TRUE AS same_year, 'same research group; same year; weak topical overlap: ' || md5(p || '.' || n) AS note FROM x")
def best_candidates(spark, d):
    """Each turn among the turns of its conversation: its own has title, author and year in common."""
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("paper"), "turn", F.md5(F.concat_ws(".", _s("conv_id"), _s("turn"))).alias("title"), F.concat(F.lit("A Name"), _s("turn")).alias("authors"), F.concat(_s(1900 + F.col("turn")), F.lit(".0")).alias("year"))
    best = gold.best_candidates(c.withColumnRenamed("turn", "ext"), c.withColumnRenamed("turn", "gt"))
    own = c.select("paper", F.col("turn").alias("ext"), F.col("title").alias("own"))
    return best.join(own, ["paper", "ext"]).withColumn("note", gold.diagnosis(F.col("own"), F.col("own"), F.col("authors"), F.col("same_year"))).drop("own")


_POOL = "pool AS (SELECT d.doc_id AS row_id, 'o' || CASE WHEN doc_id % 5 < 2 THEN doc_id // 5 * 5 ELSE doc_id END AS original, source AS bucket, doc_id % 9 <> 0 AS ok, doc_id % 5 < 2 AND count(*) OVER (PARTITION BY CASE WHEN doc_id % 5 < 2 THEN doc_id // 5 * 5 ELSE -1 - doc_id END) > 1 AS multi FROM documents d)"
_PICK = "(SELECT row_id, multi, ok FROM (SELECT p.*, row_number() OVER (PARTITION BY bucket ORDER BY sha256('pilot:' || row_id), row_id) > greatest(1, round_even({n} * count(*) OVER (PARTITION BY bucket)::DOUBLE / count(*) OVER (), 0)) AS late FROM pool p WHERE multi = {m}) ORDER BY late, sha256('pilot:' || row_id), row_id LIMIT {n})"


@query("pilot_sample", f"WITH {_POOL}, picked AS (FROM {_PICK.format(n=40, m='TRUE')} UNION ALL FROM {_PICK.format(n=20, m='FALSE')}), spare AS (SELECT row_id, multi, row_number() OVER (ORDER BY sha256('pilot:' || row_id), row_id) AS r FROM pool WHERE ok AND row_id NOT IN (SELECT row_id FROM picked)) SELECT row_id, multi FROM picked WHERE ok UNION ALL SELECT row_id, multi FROM spare WHERE r <= 60 - (SELECT count(*) FROM picked WHERE ok) AND (SELECT count(*) FROM picked WHERE NOT ok) > 0")
def pilot_sample(spark, d):
    i = F.col("doc_id")
    rows = docs(spark, d).select(i.alias("row_id"), F.concat(F.lit("o"), _s(F.when(i % 5 < 2, F.expr("doc_id div 5") * 5).otherwise(i))).alias("original"), _s(i).alias("folder"), F.col("source").alias("bucket"))
    return gold.pilot(rows, rows.where("row_id % 9 <> 0").select("folder"), 40, 20, "pilot")


# recorded searches


def _pages(spark, d, item, *path):
    """All documents as items in pages of some 100."""
    body = F.collect_list(item)
    for name in reversed(path):
        body = F.struct(body.alias(name))
    return docs(spark, d).groupBy(F.expr("doc_id div 100"), F.col("lang").alias("query")).agg(F.to_json(body).alias("body"))


def _sql(api, pmid="''", doi="'10.1/X' || doc_id", title="text", abstract="''", authors="'A' || doc_id || '; B'", journal="'J'", year="'2001'"):
    return f"SELECT {pmid} AS pmid, {doi} AS doi, {title} AS title, {abstract} AS abstract, {authors} AS authors, {journal} AS journal, {year} AS year, '{api}' AS source_api, lang AS source_query FROM documents"



_DOI = lambda: F.concat(F.lit("10.1/X"), _s("doc_id"))
_A = lambda: F.concat(F.lit("A"), _s("doc_id"))


@query("search_pubmed", _sql("pubmed", pmid="doc_id::VARCHAR", abstract="'abs'"))
def search_pubmed(spark, d):
    item = F.struct(_s("doc_id").alias("PMID"), F.array(F.lit("S1 [pii]"), F.concat(_DOI(), F.lit(" [doi]"))).alias("AID"), F.col("text").alias("TI"), F.lit("abs").alias("AB"), F.array(_A(), F.lit("B")).alias("AU"), F.lit("J").alias("TA"), F.lit("2001 May").alias("DP"))
    return readers.recorded(_pages(spark, d, item, "records"), "pubmed")


@query("search_openalex", _sql("openalex", abstract="'one two one'"))
def search_openalex(spark, d):
    author = lambda x: F.struct(F.struct(x.alias("display_name")).alias("author"))
    index = F.create_map(F.lit("one"), F.array(F.lit(0), F.lit(2)), F.lit("two"), F.array(F.lit(1)))
    item = F.struct(F.concat(F.lit("https://doi.org/"), _DOI()).alias("doi"), F.col("text").alias("title"), index.alias("abstract_inverted_index"), F.array(author(_A()), author(F.lit("B"))).alias("authorships"), F.struct(F.struct(F.lit("J").alias("display_name")).alias("source")).alias("primary_location"), F.lit(2001).alias("publication_year"))
    return readers.recorded(_pages(spark, d, item, "results"), "openalex")


@query("search_openalex_broad", _sql("openalex_broad", title="CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END", authors="''", journal="''", year="CASE WHEN doc_id % 2 = 0 THEN '' ELSE '1999' END"))
def search_openalex_broad(spark, d):
    """Works of a broad search: fields that are absent, or of null objects, are empty."""
    none = F.lit(None).cast("struct<source: struct<display_name: string>>")
    item = F.struct(_DOI().alias("doi"), F.when(F.col("doc_id") % 3 > 0, F.col("text")).alias("title"), none.alias("primary_location"), F.when(F.col("doc_id") % 2 == 1, 1999).alias("publication_year"))
    return readers.recorded(_pages(spark, d, item, "results"), "openalex_broad")


@query("search_europepmc", _sql("europepmc", pmid="CASE WHEN doc_id % 2 = 0 THEN doc_id::VARCHAR ELSE '' END"))
def search_europepmc(spark, d):
    item = F.struct(F.when(F.col("doc_id") % 2 == 0, _s("doc_id")).alias("pmid"), _DOI().alias("doi"), F.col("text").alias("title"), F.concat(_A(), F.lit("; B")).alias("authorString"), F.lit("J").alias("journalTitle"), F.lit(2001).alias("pubYear"))
    return readers.recorded(_pages(spark, d, item, "resultList", "result"), "europepmc")


@query("search_crossref", _sql("crossref", doi="'10.1/x' || doc_id", abstract="'abs tract'", authors="'A' || doc_id || ' Z; B'"))
def search_crossref(spark, d):
    person = lambda given, family: F.struct(given.alias("given"), family.alias("family"))
    item = F.struct(_DOI().alias("DOI"), F.array("text", F.lit("subtitle")).alias("title"), F.lit(" <p>abs <i>tract</i></p>").alias("abstract"), F.array(person(_A(), F.lit("Z")), person(F.lit(None).cast("string"), F.lit("B"))).alias("author"), F.array(F.lit("J"), F.lit("K")).alias("container-title"), F.struct(F.array(F.array(F.lit(2001), F.lit(5))).alias("date-parts")).alias("issued"))
    return readers.recorded(_pages(spark, d, item, "message", "items"), "crossref")


@query("search_osf", _sql("osf", doi="'10.1/x' || doc_id", abstract="'abs'", authors="''", journal="CASE WHEN doc_id % 2 = 0 THEN 'psyarxiv' ELSE 'osf' END"))
def search_osf(spark, d):
    """Every preprint is found by two filters, and counts once."""
    item = F.struct(_s("doc_id").alias("id"), F.struct(_DOI().alias("doi"), F.col("text").alias("title"), F.lit("abs").alias("description"), F.lit("2001-05-01T00:00").alias("date_published")).alias("attributes"), F.struct(F.struct(F.struct(F.when(F.col("doc_id") % 2 == 0, "psyarxiv").alias("id")).alias("data")).alias("provider")).alias("relationships"))
    pages = _pages(spark, d, item, "data")
    return readers.recorded(pages.unionByName(pages), "osf")


@query("search_semantic_scholar", _sql("semantic_scholar", pmid="doc_id::VARCHAR", doi="'10.1/x' || doc_id", abstract="'abs'"))
def search_semantic_scholar(spark, d):
    name = lambda x: F.struct(x.alias("name"))
    item = F.struct(F.col("text").alias("title"), F.lit("abs").alias("abstract"), F.array(name(_A()), name(F.lit("B"))).alias("authors"), F.lit(2001).alias("year"), F.lit("J").alias("venue"), F.struct(F.col("doc_id").alias("PubMed"), _DOI().alias("DOI")).alias("externalIds"))
    return readers.recorded(_pages(spark, d, item, "data"), "semantic_scholar")


# small predicates and lists


@query("latest_version", "SELECT 'v' || max(doc_id) || '.csv' AS version FROM documents WHERE doc_id % 3 = 1")
def latest_version(spark, d):
    i = F.col("doc_id")
    line = F.when(i % 3 == 0, "# a comment").when(i % 3 == 1, F.concat(F.lit(" v"), _s(i), F.lit(".csv  # what changed"))).otherwise("  ")
    return catalog.latest_version(docs(spark, d).select(i.alias("line_no"), line.alias("line")))


@query("last_event_line", "SELECT max_by(event_type, event_id) AS line FROM events")
def last_event_line(spark, d):
    return readers.last_line(table(spark, d, "events").select("event_id", F.col("event_type").alias("line")), "event_id", "line")


@query("include_list", "SELECT 'p' || o_orderkey AS folder FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 <> 0 AND o_orderkey % 4 <> 0")
def include_list(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    rows = o.select(_s(k).alias("doi"), F.concat(F.lit("/data/papers/p"), _s(k)).alias("folder"), F.col("o_orderstatus").alias("status"), F.when(k % 3 == 0, False).when(k % 3 == 1, True).alias("contains"), F.when(k % 4 == 0, F.array(F.lit("base"))).otherwise(F.array(F.lit("base_2"))).alias("tags"))
    return catalog.include_list(rows, exclude_without=True, status="F", without_tag="base")


@query("best_rungs", "SELECT l_orderkey AS folder, min_by(l_linenumber || '/' || l_partkey, (l_suppkey % 5, l_linenumber || '/' || l_partkey)) AS best, min(l_suppkey % 5) AS rank FROM lineitem WHERE l_suppkey % 5 < 4 GROUP BY 1")
def best_rungs(spark, d):
    files = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("folder"), F.concat_ws("/", _s("l_linenumber"), _s("l_partkey")).alias("path"), (F.col("l_suppkey") % 5).alias("r"))
    return catalog.best_rung(files, "folder", F.when(F.col("r") < 4, F.col("r")), "path")


@query("usage_limits", "SELECT doc_id, doc_id % 5 IN (0, 1, 2) AS limited FROM documents")
def usage_limits(spark, d):
    messages = ["Error: HTTP 429", "exit 1:\n  ", "You hit the Usage Limit", "timeout", "bad JSON:\nfoo:\n"]
    return docs(spark, d).select("doc_id", text.usage_limited(F.element_at(F.array(*map(F.lit, messages)), (F.col("doc_id") % 5 + 1).cast("int"))).alias("limited"))


@query("unwrapped_articles", "SELECT page_id, md5(CASE WHEN page_id % 2 = 0 THEN '<?xml version=\"1.0\"?><article>' || html || '</article><article>2</article>' ELSE html END) AS digest FROM pages")
def unwrapped_articles(spark, d):
    raw = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<pmc-articleset><article>"), "html", F.lit("</article><article>2</article></pmc-articleset>"))).otherwise(F.col("html"))
    return table(spark, d, "pages").select("page_id", F.md5(text.unwrapped_article(raw)).alias("digest"))


@query("core_fields", "SELECT page_id, '' AS result, page_id::VARCHAR AS original_url FROM pages")
def core_fields(spark, d):
    entry = F.struct(F.lit(None).cast("string").alias("result"), F.col("page_id").alias("original_url"), F.lit("x").alias("model"))
    return table(spark, d, "pages").select("page_id", extraction.with_core_fields(entry, ["result", "original_url"]).alias("e")).select("page_id", "e.*")


@query("title_prefixes", "SELECT p_partkey, p_partkey % 2 = 0 AS same FROM part")
def title_prefixes(spark, d):
    longer = F.concat(F.upper("p_name"), F.lit(": a subtitle"))
    return table(spark, d, "part").select("p_partkey", text.title_prefix(F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise("other"), longer).alias("same"))


@query("resumed_work", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resumed_work(spark, d):
    work = docs(spark, d).select("doc_id")
    return review.resumed(work, table(spark, d, "labels"), "doc_id", work.count())


@query("stale_caches", "SELECT 's' || s_suppkey AS name, s_suppkey % 3 <> 0 AS stale FROM supplier")
def stale_caches(spark, d):
    s = table(spark, d, "supplier").select(F.concat(F.lit("s"), _s("s_suppkey")).alias("name"), (F.col("s_suppkey") % 3).alias("k"), F.col("s_nationkey").alias("n"))
    inputs = lambda n: F.struct(n.alias("length"), F.lit(5).cast("long").alias("modified"))
    return review.stale_caches(s.where("k < 2").select("name", inputs(F.col("n") + F.col("k")).alias("inputs")), s.select("name", inputs(F.col("n")).alias("inputs")))


@query("ledger_uses", "SELECT 'v' || n_regionkey AS prompt_version, count(*) + 1 AS n FROM nation WHERE n_regionkey < 3 GROUP BY 1")
def ledger_uses(spark, d):
    n = table(spark, d, "nation").select(F.concat(F.lit("v"), _s("n_regionkey")).alias("prompt_version"), F.col("n_name").alias("tags"))
    new = table(spark, d, "region").where("r_regionkey < 3").select(F.concat(F.lit("v"), _s("r_regionkey")).alias("prompt_version"), F.lit("new").alias("tags"))
    return review.ledger_uses(n, new)


_XML = '<?xml version="1.0"?>'


@query("workbook_cells", "SELECT page_id AS book, r AS row, c AS pos, CASE WHEN r = 0 THEN (['Title', 'DOI', 'n'])[c + 1] ELSE (['A & B ' || page_id, '10.1000/x' || r, (page_id + r)::VARCHAR])[c + 1] END AS cell FROM pages, (SELECT unnest([0, 1, 3]) AS r), (SELECT unnest([0, 1, 2]) AS c)")
def workbook_cells(spark, d):
    return readers.workbook_cells(_workbooks(spark, d)).select(F.col("path").cast("long").alias("book"), "row", "pos", "cell")


def _workbooks(spark, d):
    """A workbook a page: shared, inline and plain cells, a row left out, and a second sheet that isn't read."""
    import io
    import zipfile

    import pandas as pd

    def book(n):
        cell = lambda ref, kind, value: f'<c r="{ref}" t="{kind}">' + (f"<is><t>{value}</t></is>" if kind == "inlineStr" else f"<v>{value}</v>") + "</c>"
        strings = ["Title", "DOI", f"A &amp; B {n}"]
        shared = "".join(f"<si><r><t>{x[:2]}</t></r><r><t>{x[2:]}</t></r></si>" if not x.startswith("A &") else f"<si><t>{x}</t></si>" for x in strings)
        rows = f'<row r="1">{cell("A1", "s", 0)}{cell("B1", "s", 1)}{cell("C1", "inlineStr", "n")}</row>'
        rows += "".join(f'<row r="{r + 1}">{cell(f"A{r + 1}", "s", 2)}{cell(f"B{r + 1}", "inlineStr", f"10.1000/x{r}")}{cell(f"C{r + 1}", "n", n + r)}<c r="D{r + 1}"/></row>' for r in (1, 3))
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("xl/sharedStrings.xml", f'{_XML}<sst xmlns="x">{shared}</sst>')
            z.writestr("xl/worksheets/sheet2.xml", f'{_XML}<worksheet xmlns="x"/>')
            z.writestr("xl/worksheets/sheet1.xml", f'{_XML}<worksheet xmlns="x"><sheetData>{rows}</sheetData></worksheet>')
        return out.getvalue()

    made = F.pandas_udf(lambda s: pd.Series([book(n) for n in s]), "binary")
    files = table(spark, d, "pages").select(_s("page_id").alias("path"), made("page_id").alias("content"))
    return files


@query("filled_templates", "SELECT page_id, '{page} ' || page_id || ' at ' || md5(url) || '.' AS text FROM pages")
def filled_templates(spark, d):
    return table(spark, d, "pages").select("page_id", text.filled_template("{{page}} {id} at {where}{none}.", {"id": F.col("page_id"), "where": F.md5("url"), "none": F.lit(None)}).alias("text"))


@query("group_order", "SELECT source AS root, row_number() OVER (ORDER BY min(doc_id)) - 1 AS position FROM documents GROUP BY 1")
def group_order(spark, d):
    return resolve.in_order(docs(spark, d).select(F.col("doc_id").alias("seq"), F.col("source").alias("root")))


_ROWS = "SELECT page_id AS book, r AS row, map(['Title', 'DOI', 'n'], ['A & B ' || page_id, '10.1000/x' || r, (page_id + r)::VARCHAR]) AS m FROM pages, (SELECT unnest([1, 3]) AS r)"


@query("workbook_rows", f"SELECT book, row, m['Title'] AS title, m['DOI'] AS doi, m['n'] AS n FROM ({_ROWS})")
def workbook_rows(spark, d):
    """The same workbooks as tables: cells by the names in their first row."""
    rows = readers.workbook_rows(_workbooks(spark, d))
    return rows.select(F.col("path").cast("long").alias("book"), "row", F.col("cells")["Title"].alias("title"), F.col("cells")["DOI"].alias("doi"), F.col("cells")["n"].alias("n"))
