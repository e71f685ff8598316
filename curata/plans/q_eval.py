"""Queries of matching, metrics, sampling, streams and sources."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from curata.functions import text
from curata.functions.ids import unit_hash
from curata.functions.storage import new_folder, written
from curata.operators import matching, metrics, sampling
from curata.plans import fixtures as fx
from curata.plans.catalogue import query, table
from curata.sources import readers, sinks
from curata.streaming import events as ev

CLASSES = ["success", "failure", "inconclusive"]
docs = lambda spark, d: table(spark, d, "documents")

_PER = "per AS (SELECT c AS class, count_if(gt = c) AS support, count_if(ext = c) AS predicted, count_if(gt = c AND ext = c) AS tp FROM outcomes, (SELECT unnest(['success', 'failure', 'inconclusive', 'reversal']) AS c) GROUP BY 1), m AS (SELECT *, tp::DOUBLE / nullif(predicted, 0) AS precision, tp::DOUBLE / nullif(support, 0) AS recall FROM per), f AS (SELECT *, CASE WHEN precision > 0 AND recall > 0 THEN 2 * precision * recall / (precision + recall) WHEN support > 0 OR predicted > 0 THEN 0 END AS f1 FROM m)"


@query("class_metrics", f"WITH {fx.OUTCOMES}, {_PER} SELECT * FROM f")
def class_metrics(spark, d):
    return metrics.class_metrics(fx.outcomes(spark, d), [*CLASSES, "reversal"])


@query("overall_accuracy", f"WITH {fx.OUTCOMES}, {_PER} SELECT (SELECT count(*) FROM outcomes) AS n, (SELECT avg((gt = ext)::INT) FROM outcomes) AS accuracy, (SELECT avg(coalesce(f1, 0)) FROM f WHERE support > 0) AS macro_f1")
def overall_accuracy(spark, d):
    return metrics.overall(fx.outcomes(spark, d), [*CLASSES, "reversal"])


@query("confusion", f"WITH {fx.OUTCOMES} SELECT gt, ext, count(*) AS n FROM outcomes GROUP BY ALL")
def confusion(spark, d):
    return metrics.confusion(fx.outcomes(spark, d))


_KAPPA = "t AS (SELECT lang, count(*) AS n, avg((a = b)::INT) AS po FROM rated GROUP BY 1), pe AS (SELECT lang, sum(x.n * y.n)::DOUBLE AS s FROM (SELECT lang, a AS c, count(*) AS n FROM rated GROUP BY ALL) x JOIN (SELECT lang, b AS c, count(*) AS n FROM rated GROUP BY ALL) y USING (lang, c) GROUP BY 1)"


@query("kappa", f"WITH {fx.RATED}, {_KAPPA} SELECT lang, n, po AS agreement, round(CASE WHEN s / (n * n) < 1 THEN (po - s / (n * n)) / (1 - s / (n * n)) ELSE 1 END, 9) AS kappa FROM t JOIN pe USING (lang)")
def kappa(spark, d):
    return metrics.kappa(fx.rated(spark, d), "lang").withColumn("kappa", F.round("kappa", 9))


@query("agreement_decision", f"WITH {fx.RATED}, {_KAPPA} SELECT lang, CASE WHEN k >= 0.7 THEN 'proceed' WHEN k >= 0.5 THEN 'refine' ELSE 'stop' END AS decision FROM (SELECT lang, (po - s / (n * n)) / (1 - s / (n * n)) AS k FROM t JOIN pe USING (lang))")
def agreement_decision(spark, d):
    return metrics.kappa(fx.rated(spark, d), "lang").select("lang", metrics.decision(F.col("kappa")).alias("decision"))


@query("two_passes", "SELECT doc_id, quality AS label_a, CASE WHEN doc_id % 3 = 0 THEN toxic END AS label_b, (CASE WHEN doc_id % 3 = 0 THEN coalesce(quality = toxic, FALSE) ELSE FALSE END)::INT AS agree FROM labels")
def two_passes(spark, d):
    a = table(spark, d, "labels").select("doc_id", F.col("quality").alias("label_a"))
    b = table(spark, d, "labels").where("doc_id % 3 = 0").select("doc_id", F.col("toxic").alias("label_b"))
    return a.join(b, "doc_id", "full").withColumn("agree", F.coalesce(F.col("label_a") == F.col("label_b"), F.lit(False)).cast("int"))


@query("paper_aggregate", f"WITH {fx.OUTCOMES}, g AS (SELECT row // 4 AS paper4, list(ext) AS l FROM outcomes GROUP BY 1) SELECT paper4, CASE WHEN len(list_distinct(l)) = 1 THEN l[1] WHEN list_contains(l, 'success') AND list_contains(l, 'failure') THEN 'inconclusive' WHEN len(list_filter(l, lambda x: x <> 'inconclusive')) >= len(list_filter(l, lambda x: x = 'inconclusive')) THEN list_filter(l, lambda x: x <> 'inconclusive')[1] ELSE 'inconclusive' END AS verdict FROM g")
def paper_aggregate(spark, d):
    return metrics.paper_verdict(fx.outcomes(spark, d).withColumn("paper4", F.floor(F.col("row") / 4).cast("long")), "paper4", "ext")


@query("breakdown_sets", f"WITH {fx.OUTCOMES} SELECT 'lang' AS dim, lang AS value, count(*) AS n, count(DISTINCT paper) AS n_papers, avg((gt = ext)::INT) AS accuracy FROM outcomes GROUP BY lang UNION ALL SELECT 'gt', gt, count(*), count(DISTINCT paper), avg((gt = ext)::INT) FROM outcomes GROUP BY gt")
def breakdown_sets(spark, d):
    return metrics.breakdown(fx.outcomes(spark, d).withColumn("ok", F.col("gt") == F.col("ext")), ["lang", "gt"], "ok", "paper")


@query("entry_prf", "WITH x AS (SELECT d.source, count_if(quality = 1 AND toxic = 0) AS tp, count_if(quality = 0) AS fp, count_if(quality = 1 AND toxic = 1) AS fn FROM labels JOIN documents d USING (doc_id) GROUP BY 1) SELECT source, tp::DOUBLE / nullif(tp + fp, 0) AS precision, tp::DOUBLE / nullif(tp + fn, 0) AS recall, 2.0 * (tp::DOUBLE / nullif(tp + fp, 0)) * (tp::DOUBLE / nullif(tp + fn, 0)) / nullif((tp::DOUBLE / nullif(tp + fp, 0)) + (tp::DOUBLE / nullif(tp + fn, 0)), 0) AS f1 FROM x")
def entry_prf(spark, d):
    j = table(spark, d, "labels").join(docs(spark, d).select("doc_id", "source"), "doc_id").groupBy("source")
    c = j.agg(F.count_if((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("tp"), F.count_if(F.col("quality") == 0).alias("fp"), F.count_if((F.col("quality") == 1) & (F.col("toxic") == 1)).alias("fn"))
    return c.select("source", metrics.prf(F.col("tp"), F.col("fp"), F.col("fn")).alias("m")).select("source", "m.*")


@query("stat_tiers", "WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity::DOUBLE AS g, l_quantity + l_linenumber - 3 AS e, l_discount AS p, l_tax AS q FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, abs(g - e) < 0.5 AS n1, abs(g - e) <= 0.05 * abs(g) AS n2, abs(g - e) <= 0.2 * abs(g) AS n3, abs(p - q) <= 1e-4 AS p2, (p < 0.05) = (q < 0.05) AS p3, CASE WHEN l_linenumber % 2 = 0 THEN abs(p - q) <= 0.01 END AS es1 FROM x")
def stat_tiers(spark, d):
    s = lambda c: c.cast("string")
    q, no = F.col("l_quantity"), F.col("l_linenumber")
    n = metrics.stat_tiers("n", s(q), s(q + no - 3))
    p = metrics.stat_tiers("p", s(F.col("l_discount")), s(F.col("l_tax")))
    es = metrics.stat_tiers("es", s(F.col("l_discount")), s(F.col("l_tax")), F.lit("d"), F.when(no % 2 == 0, "D").otherwise("r"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", n["tier1"].alias("n1"), n["tier2"].alias("n2"), n["tier3"].alias("n3"), p["tier2"].alias("p2"), p["tier3"].alias("p3"), es["tier1"].alias("es1"))


@query("type_adjacent", "WITH x AS (SELECT doc_id, doc_id % 5 AS g, doc_id % 4 AS e FROM documents) SELECT doc_id, CASE WHEN g < 4 THEN g = e ELSE e < 3 END AS ok, CASE WHEN g < 4 THEN abs(g - e) <= 1 END AS adjacent_ok, g = 4 AS two_class FROM x")
def type_adjacent(spark, d):
    kinds = [*metrics.TYPES, "direct_or_close"]
    pick = lambda n: F.element_at(F.array(*map(F.lit, kinds)), (F.col("doc_id") % n + 1).cast("int"))
    return docs(spark, d).select("doc_id", metrics.type_score(pick(5), pick(4)).alias("t")).select("doc_id", "t.*")


_SETS = "g AS (SELECT l_orderkey AS paper, list(DISTINCT l_suppkey % 7) AS g FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1), e AS (SELECT l_orderkey AS paper, list(DISTINCT l_suppkey % 7) AS e FROM lineitem WHERE l_linenumber >= 2 GROUP BY 1), s AS (SELECT paper, len(g) AS n_gt, len(coalesce(e, [])) AS n_ext, len(list_intersect(g, coalesce(e, []))) AS tp, list_sort(g) = list_sort(coalesce(e, [])) AS exact FROM g LEFT JOIN e USING (paper))"


def _sets(spark, d):
    r = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("paper"), (F.col("l_suppkey") % 7).cast("string").alias("item"), "l_linenumber")
    return metrics.set_scores(r.where("l_linenumber <= 3"), r.where("l_linenumber >= 2"), "paper", "item")


@query("set_scores", f"WITH {_SETS} SELECT paper, n_gt, n_ext, tp, tp::DOUBLE / n_gt AS recall, tp::DOUBLE / nullif(n_ext, 0) AS precision_lb, tp > 0 AS hit, exact FROM s")
def set_scores(spark, d):
    return _sets(spark, d)


@query("set_summary", f"WITH {_SETS} SELECT count(*) AS n_papers, sum(tp)::DOUBLE / sum(n_gt) AS micro_recall, sum(tp)::DOUBLE / sum(n_ext) AS micro_precision_lb, round(avg(tp::DOUBLE / n_gt), 9) AS macro_recall, avg((tp > 0)::INT) AS hit_rate, avg(exact::INT) AS exact_rate FROM s")
def set_summary(spark, d):
    return metrics.set_summary(_sets(spark, d)).withColumn("macro_recall", F.round("macro_recall", 9))


@query("bootstrap_ci")
def bootstrap_ci(spark, d):
    """Interval of the second rater's accuracy, resampling sources; a hash bootstrap has no SQL here."""
    return metrics.bootstrap(fx.outcomes(spark, d).withColumn("ok", (F.col("gt") == F.col("ext")).cast("int")), "paper", "ok")


def _entries(spark, d):
    """Reference and predicted entries of an order: parts, with DOIs, titles, authors and years."""
    r = table(spark, d, "lineitem").withColumn("paper", F.col("l_orderkey").cast("string"))
    n = F.row_number().over(Window.partitionBy("paper").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    r = r.withColumn("n", n.cast("long"))
    part = lambda c: F.concat(F.lit("part "), c.cast("string"))
    fields = lambda p, doi, shift: r.select("paper", F.col("n").alias("gt" if p == "g" else "ext"), doi.alias(f"{p}_doi"), F.concat(F.lit("effect of "), part(F.col("l_partkey"))).alias(f"{p}_description"), F.concat(F.lit("A long title about "), part(F.col("l_partkey") + shift)).alias(f"{p}_title"), F.concat(F.lit("A Name"), (F.col("l_suppkey") % 5).cast("string")).alias(f"{p}_authors"), (1990 + F.col("n")).cast("string").alias(f"{p}_year"))
    return fields("g", part(F.col("l_partkey") % 3), 0), fields("e", F.when(F.col("n") % 2 == 0, part(F.col("l_partkey") % 3)), 1)


@query("fuzzy_assign")
def fuzzy_assign(spark, d):
    """Costs by DOI and by title, authors and year (difflib), then a least-cost assignment of each paper."""
    return matching.assign_entries(*_entries(spark, d))


@query("hungarian")
def hungarian(spark, d):
    """Least-cost one-to-one assignment of an order's lines by price; brute force checks it in the tests."""
    r = table(spark, d, "lineitem")
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")).cast("long")
    a = r.select(F.col("l_orderkey").cast("string").alias("paper"), n.alias("gt"), F.col("l_quantity").alias("x"))
    b = r.select(F.col("l_orderkey").cast("string").alias("paper"), n.alias("ext"), (F.col("l_discount") * 500).alias("y"))
    return matching.assign(a.join(b, "paper").withColumn("cost", F.abs(F.col("x") - F.col("y"))))


@query("greedy_align")
def greedy_align(spark, d):
    return matching.greedy_entries(*_entries(spark, d), 0.5)


_SCORES = "sc AS (SELECT a.l_orderkey AS paper, a.n AS a, b.n AS b, round(1 - abs(a.q - b.q) / 50.0, 6) AS score FROM r a JOIN r b ON a.l_orderkey = b.l_orderkey AND a.h = 0 AND b.h = 1)"
_HALVES = "r AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n, l_linenumber % 2 AS h, l_quantity::DOUBLE AS q FROM lineitem)"


def _scores(spark, d):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    r = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("paper"), F.row_number().over(w).cast("long").alias("n"), (F.col("l_linenumber") % 2).alias("h"), F.col("l_quantity").cast("double").alias("q"))
    a, b = (r.where(F.col("h") == h).select("paper", F.col("n").alias(s), F.col("q").alias(f"q{s}")) for h, s in ((0, "a"), (1, "b")))
    return a.join(b, "paper").select("paper", "a", "b", F.round(1 - F.abs(F.col("qa") - F.col("qb")) / 50.0, 6).alias("score"))


@query("mutual_best", f"WITH {_HALVES}, {_SCORES}, k AS (SELECT *, row_number() OVER x AS ra, lead(score) OVER x AS na, row_number() OVER y AS rb, lead(score) OVER y AS nb FROM sc WINDOW x AS (PARTITION BY paper, a ORDER BY score DESC, b DESC), y AS (PARTITION BY paper, b ORDER BY score DESC, a DESC)) SELECT paper, a, b, score FROM k WHERE ra = 1 AND rb = 1 AND score >= 0.65 AND (na IS NULL OR score - na >= 0.08) AND (nb IS NULL OR score - nb >= 0.08)")
def mutual_best(spark, d):
    return matching.mutual_best(_scores(spark, d))


@query("threshold_sensitivity", f"WITH {_HALVES}, {_SCORES} SELECT t AS threshold, count_if(score >= t) AS n FROM sc, (SELECT unnest([0.55, 0.65, 0.75]::DOUBLE[]) AS t) GROUP BY 1")
def threshold_sensitivity(spark, d):
    return matching.sensitivity(_scores(spark, d), [0.55, 0.65, 0.75])


@query("recorded_verdicts", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'same_effect' END AS relation, CASE WHEN doc_id % 2 = 0 THEN 'high' END AS confidence FROM documents")
def recorded_verdicts(spark, d):
    key = F.sha2(F.concat_ws("\x1f", "source", "text", F.col("doc_id").cast("string")), 256)
    rows = docs(spark, d)
    verdicts = rows.where("doc_id % 2 = 0").select(key.alias("key"), F.lit("same_effect").alias("relation"), F.lit("high").alias("confidence"))
    return matching.judged(rows, verdicts, key).select("doc_id", "relation", "confidence")


@query("adjudication_queue", f"WITH {fx.OUTCOMES} SELECT row, CASE WHEN gt <> ext THEN 'result' ELSE 'result' END AS field, CASE WHEN gt <> ext THEN 'disagreement' ELSE 'audit_sample' END AS reason, gt AS a_value, ext AS b_value FROM outcomes WHERE gt <> ext OR ('0x' || substr(sha256('audit:' || row), 1, 8))::BIGINT / 4294967296.0 < 0.2")
def adjudication_queue(spark, d):
    rows = fx.outcomes(spark, d).select("row", F.col("gt").alias("a_result"), F.col("ext").alias("b_result"))
    return matching.adjudication(rows, ["result"], "row")


@query("stratified_sample", "WITH q AS (SELECT source, greatest(1, round_even(100 * count(*)::DOUBLE / (SELECT count(*) FROM documents), 0)) AS quota FROM documents GROUP BY 1), r AS (SELECT d.doc_id, d.source, sha256('s:' || doc_id) AS h, row_number() OVER (PARTITION BY d.source ORDER BY sha256('s:' || doc_id), doc_id) > quota AS late FROM documents d JOIN q USING (source)) SELECT doc_id, source FROM r ORDER BY late, h, doc_id LIMIT 100")
def stratified_sample(spark, d):
    return sampling.stratified(docs(spark, d).select("doc_id", "source"), "source", "doc_id", 100, "s")


@query("top_of_each_stratum", "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY sha256('t:' || doc_id), doc_id) <= 3")
def top_of_each_stratum(spark, d):
    return sampling.top_of_each(docs(spark, d).select("doc_id", "source"), "source", "doc_id", 3, "t")


@query("bernoulli_audit", "SELECT doc_id FROM documents WHERE lang = 'es' OR ('0x' || substr(sha256('b:' || doc_id), 1, 8))::BIGINT / 4294967296.0 < 0.25")
def bernoulli_audit(spark, d):
    return sampling.bernoulli(docs(spark, d), "doc_id", 0.25, "b", F.col("lang") == "es").select("doc_id")


@query("band_sample", "WITH p AS (SELECT l_orderkey AS paper, count(*) AS n FROM lineitem GROUP BY 1), b AS (SELECT *, CASE WHEN n BETWEEN 1 AND 2 THEN '1-2' WHEN n BETWEEN 3 AND 5 THEN '3-5' WHEN n BETWEEN 6 AND 99 THEN '6-99' END AS band FROM p) SELECT paper, n, band FROM b QUALIFY row_number() OVER (PARTITION BY band ORDER BY sha256('n:' || paper), paper) <= 5")
def band_sample(spark, d):
    p = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("paper")).agg(F.count("*").alias("n"))
    return sampling.in_bands(p, "n", "paper", [(1, 2), (3, 5), (6, 99)], 5, "n")


@query("row_cap")
def row_cap(spark, d):
    """Orders by rising number of lines while they fit below the cap; a walk in order checks it in the tests."""
    p = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("paper")).agg(F.count("*").alias("n"))
    return sampling.under_cap(p, "n", "paper", 40)


@query("sequential_frame", "WITH a AS (SELECT doc_id FROM documents WHERE lang = 'de' ORDER BY sha256('f:' || doc_id), doc_id LIMIT 10), b AS (SELECT doc_id FROM documents WHERE n_chars > 1000 AND doc_id NOT IN (SELECT doc_id FROM a) ORDER BY sha256('f:' || doc_id), doc_id LIMIT 15) SELECT doc_id, 'german' AS stratum FROM a UNION ALL SELECT doc_id, 'long' FROM b")
def sequential_frame(spark, d):
    return sampling.frame(docs(spark, d), [("german", F.col("lang") == "de", 10), ("long", F.col("n_chars") > 1000, 15)], "doc_id", "f")


@query("adversarial_negatives", "SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE quality = 0 AND regexp_matches(text, '[Ll]icen[sc]e|!!')")
def adversarial_negatives(spark, d):
    return docs(spark, d).where(F.col("text").rlike("[Ll]icen[sc]e|!!")).join(table(spark, d, "labels").where("quality = 0").select("doc_id"), "doc_id", "left_semi").select("doc_id")


@query("anchor_membership", "WITH s AS (SELECT n_regionkey AS anchor, string_agg(n_nationkey::VARCHAR, ';' ORDER BY n_nationkey) AS ids FROM nation GROUP BY 1) SELECT anchor, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN s ON s.anchor = n_regionkey")
def anchor_membership(spark, d):
    s = table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("anchor")).agg(F.array_join(F.collect_list(F.col("n_nationkey").cast("string")), ";").alias("ids"))
    one = s.select("anchor", F.explode(F.split("ids", ";")).alias("id"))
    return table(spark, d, "customer").join(one, F.col("c_nationkey").cast("string") == F.col("id")).select("anchor", "c_custkey")


@query("title_fuzzy_rows", "WITH x AS (SELECT conv_id AS paper, turn AS gt, 'q' || md5(conv_id || ':' || turn) AS g, CASE WHEN turn % 2 = 0 THEN 'Q' || md5(conv_id || ':' || turn) || ' ' ELSE '-' END AS e FROM conversations) SELECT x.paper, x.gt FROM x WHERE NOT EXISTS (FROM x y WHERE y.paper = x.paper AND lower(trim(y.e)) = x.g)")
def title_fuzzy_rows(spark, d):
    """Labels whose title is like no found title of their paper at 0.8 (difflib); digests are either equal or far from like."""
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("paper"), "turn")
    digest = F.md5(F.concat_ws(":", F.col("paper").cast("string"), F.col("turn").cast("string")))
    g = c.select("paper", F.col("turn").alias("gt"), F.concat(F.lit("q"), digest).alias("g_title"))
    e = c.select("paper", F.when(F.col("turn") % 2 == 0, F.concat(F.lit("Q"), digest, F.lit(" "))).otherwise("-").alias("e_title"))
    hit = g.join(e, (g["paper"] == e["paper"]) & text.could_reach("g_title", "e_title", 0.8)).drop(e["paper"])
    hit = hit.where(text.string_ratio("g_title", "e_title") >= 0.8).select("paper", "gt").distinct()
    return g.select("paper", "gt").join(hit, ["paper", "gt"], "left_anti")


# streams

_EV = "e AS (SELECT *, ts::TIMESTAMP AS t FROM events)"


@query("stream_tumbling", f"WITH {_EV} SELECT time_bucket(INTERVAL '1 hour', t) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM e GROUP BY ALL")
def stream_tumbling(spark, d):
    return ev.run_complete(ev.tumbling(ev.source(spark, f"{d}/events.parquet")), "tumbling").withColumn("total", F.round("total", 6))


@query("stream_sliding", f"WITH {_EV}, w AS (SELECT unnest([time_bucket(INTERVAL '1 hour', t), time_bucket(INTERVAL '1 hour', t) - INTERVAL '1 hour']) AS start FROM e) SELECT start, count(*) AS n FROM w GROUP BY 1")
def stream_sliding(spark, d):
    return ev.run_complete(ev.sliding(ev.source(spark, f"{d}/events.parquet")), "sliding")


@query("stream_session", f"WITH {_EV}, g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS new FROM e), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY t, event_id) AS k FROM g) SELECT user_id, min(t) AS start, max(t) + INTERVAL '30 minutes' AS \"end\", count(*) AS n FROM s GROUP BY user_id, k")
def stream_session(spark, d):
    e = ev.source(spark, f"{d}/events.parquet")
    return ev.run_complete(ev.sessions(e, late="400 days"), "session")


@query("stream_dedup", "SELECT count(*) AS n, count(DISTINCT event_id) AS k FROM events")
def stream_dedup(spark, d):
    out = ev.run_to_table(ev.distinct_events(ev.source(spark, f"{d}/events.parquet"), late="400 days"), "dedup")
    return out.agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("k"))


@query("stream_append_dedup", "SELECT DISTINCT user_id % 50 AS who FROM events")
def stream_append_dedup(spark, d):
    e = ev.source(spark, f"{d}/events.parquet").select(F.col("event_id").alias("seq"), (F.col("user_id") % 50).alias("who"))
    return ev.append_unseen(e, ["who"], "append").select("who")


# sources and sinks: written to the shared folder first, then read


@query("csv_scan", "SELECT doc_id::VARCHAR AS doc_id, md5(text) AS digest, nullif(CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END, '') AS lang FROM documents")
def csv_scan(spark, d):
    folder = new_folder(spark, "csv")
    sinks.write_csv(docs(spark, d).select("doc_id", "text", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("lang")), folder, ["doc_id", "text", "lang", "none"])
    return readers.csv(spark, folder).select("doc_id", F.md5("text").alias("digest"), F.nullif("lang", F.lit("")).alias("lang"))


@query("json_lines_scan", "SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events WHERE event_id % 10 <> 0")
def json_lines_scan(spark, d):
    folder = new_folder(spark, "lines")
    line = F.when(F.col("event_id") % 10 == 0, "{broken").otherwise(F.to_json(F.struct("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))))
    table(spark, d, "events").select(line.alias("value")).write.text(folder)
    return readers.json_lines(spark, folder, "event_id long, k long").where("_corrupt is null").select("event_id", "k")


@query("paper_json_scan", "SELECT CASE WHEN conv_id % 7 = 0 THEN 'bad_json' ELSE 'ok' END AS state, count(*) AS n FROM (SELECT DISTINCT conv_id FROM conversations) GROUP BY 1")
def paper_json_scan(spark, d):
    """Whole-file JSON of all conversations: a file a paper, without a folder each."""
    folder = new_folder(spark, "papers")
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list("text").alias("entries"))
    body = F.when(F.col("conv_id") % 7 == 0, "{not json").otherwise(F.to_json(F.struct("conv_id", "entries")))
    c.select(body.alias("value")).write.option("maxRecordsPerFile", 1).text(folder)
    return readers.papers_json(spark, folder, "entries array<string>").groupBy("state").agg(F.count("*").alias("n"))


@query("page_artifacts", "SELECT CASE WHEN page_id % 2 = 0 THEN 'xml' ELSE 'pdf' END AS kind, count(*) AS n FROM pages GROUP BY 1")
def page_artifacts(spark, d):
    """Lists a tree of files, one a page in a folder a kind; their contents aren't read."""
    folder = new_folder(spark, "tree")
    p = table(spark, d, "pages").select(F.col("page_id").cast("string").alias("value"), F.when(F.col("page_id") % 2 == 0, "xml").otherwise("pdf").alias("kind"))
    p.write.option("maxRecordsPerFile", 1).partitionBy("kind").text(folder)
    files = readers.artifacts(spark, folder).where(F.col("name").startswith("part-") & (F.col("length") > 0))
    return files.select(F.regexp_extract("path", "/kind=([a-z]+)/", 1).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@query("doi_column_detect", f"WITH {fx.CANDIDATES}, {fx.NORMED} SELECT nd AS doi, min(seq) + 1 AS row FROM normed WHERE nd IS NOT NULL GROUP BY 1")
def doi_column_detect(spark, d):
    return readers.doi_list(_cells(spark, d))


def _cells(spark, d):
    c = fx.candidates(spark, d)
    rows = c.select((F.col("seq") + 1).alias("row"), F.posexplode(F.array("title", "doi", "year")).alias("pos", "cell"))
    head = spark.createDataFrame([(0, 0, "Title"), (0, 1, "DOI "), (0, 2, "Year")], "row long, pos int, cell string")
    return head.unionByName(rows)


@query("doi_column_counts", f"WITH {fx.CANDIDATES}, {fx.NORMED} SELECT count(*) AS n_rows, count_if(trim(doi) <> '' AND nd IS NULL) AS n_invalid FROM normed")
def doi_column_counts(spark, d):
    return readers.doi_counts(_cells(spark, d))


@query("run_creation", f"WITH {fx.CANDIDATES}, {fx.NORMED} SELECT run, count(*) AS n_rows, count_if(trim(doi) <> '' AND nd IS NULL) AS n_invalid, count(DISTINCT nd) AS n_dois, count(DISTINCT nd) AS n_folders FROM normed, (SELECT unnest(['first', 'second-run']) AS run) GROUP BY 1")
def run_creation(spark, d):
    """The same pasted table as two runs, written and read again by run."""
    folder, cells = new_folder(spark, "runs"), written(_cells(spark, d), "cells")
    for slug in ("first", "second-run"):
        sinks.write_run(cells, slug, folder)
    folders = spark.read.parquet(f"{folder}/dois").groupBy("run").agg(F.count_distinct("folder").alias("n_folders"))
    return spark.read.parquet(f"{folder}/counts").join(folders, "run").select("run", "n_rows", "n_invalid", "n_dois", "n_folders")


@query("keyword_overlay", "SELECT r_name AS key, CASE WHEN r_regionkey = 1 THEN 'mine' ELSE (SELECT string_agg(n_name, ',' ORDER BY n_name) FROM nation WHERE n_regionkey = r_regionkey) END AS items FROM region")
def keyword_overlay(spark, d):
    lists = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("r_name").alias("key")).agg(F.array_sort(F.collect_list("n_name")).alias("items"))
    overlay = table(spark, d, "region").where("r_regionkey = 1").select(F.col("r_name").alias("key"), F.array(F.lit("mine")).alias("items"))
    return readers.overlaid(lists, overlay).select("key", F.array_join("items", ",").alias("items"))


@query("keyword_fanout", "SELECT 'api' || r_regionkey AS api, n_name AS query FROM region JOIN nation ON n_regionkey = r_regionkey OR n_regionkey = 0")
def keyword_fanout(spark, d):
    r = table(spark, d, "region")
    lists = table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("key")).agg(F.collect_list("n_name").alias("items"))
    apis = r.select(F.concat(F.lit("api"), F.col("r_regionkey").cast("string")).alias("api"), F.array_distinct(F.array("r_regionkey", F.lit(0).cast("long"))).alias("keys"))
    return readers.fanned_out(lists, apis)


@query("published_dois", f"WITH {fx.CANDIDATES}, {fx.NORMED} SELECT DISTINCT {fx.sql_normalize_doi(chr(40) + 'nullif(regexp_extract(doi, ' + chr(39) + '10' + chr(92) + '.' + chr(92) + 'd{4,9}/' + chr(92) + 'S+' + chr(39) + '), ' + chr(39) + chr(39) + '))')} AS doi FROM normed WHERE regexp_matches(doi, '10\\.\\d{{4,9}}/\\S+')")
def published_dois(spark, d):
    return readers.published_dois(fx.candidates(spark, d), "doi")


@query("reference_ladder", "SELECT doc_id, CASE WHEN trim(coalesce(text, ''), ' ') = '' THEN 'none' WHEN doc_id % 3 = 0 THEN 'json' WHEN doc_id % 3 = 1 THEN 'md' ELSE 'none' END AS source, CASE WHEN trim(coalesce(text, ''), ' ') <> '' AND doc_id % 3 < 2 THEN least(length(text), 60000) ELSE 0 END AS n FROM documents")
def reference_ladder(spark, d):
    i = F.col("doc_id") % 3
    r = readers.reference_ladder(("json", F.when(i == 0, F.col("text"))), ("md", F.when(i == 1, F.col("text")).otherwise(" ")))
    return docs(spark, d).select("doc_id", r["source"].alias("source"), F.length(r["text"]).cast("long").alias("n"))


@query("paper_discovery", "SELECT doc_id AS folder FROM documents WHERE n_chars > 300 AND doc_id IN (SELECT doc_id FROM labels) ORDER BY 1 LIMIT 25")
def paper_discovery(spark, d):
    f = docs(spark, d).select(F.col("doc_id").alias("folder"), "n_chars")
    return readers.discovered(f.select("folder"), f.where("n_chars > 300"), table(spark, d, "labels").select(F.col("doc_id").alias("folder")), 25)


@query("fetch_filled", "SELECT doc_id, coalesce(quality::VARCHAR, '') AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def fetch_filled(spark, d):
    return readers.filled(docs(spark, d).select("doc_id"), table(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("quality")), "doc_id", "quality")


@query("snapshot_export", "SELECT count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders")
def snapshot_export(spark, d):
    folder = new_folder(spark, "snapshot")
    sinks.write_snapshot(table(spark, d, "orders"), folder, "o_orderkey")
    return spark.read.parquet(folder).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))


@query("unit_hashes", "SELECT doc_id, ('0x' || substr(sha256('u:' || doc_id), 1, 8))::BIGINT / 4294967296.0 AS u FROM documents")
def unit_hashes(spark, d):
    return docs(spark, d).select("doc_id", unit_hash(F.lit("u"), F.col("doc_id").cast("string")).alias("u"))


_STRATA = "(VALUES ('lang', 1, 'de', 6, NULL::INT, FALSE), ('lang', 1, 'en', 4, NULL, TRUE), ('lang', 1, 'fr', 5, NULL, FALSE), ('size', 2, '0', 3, 14, FALSE), ('size', 2, '1', 3, 14, FALSE), ('size', 2, '2', 3, 14, FALSE), ('labelled', 3, '0', NULL, NULL, FALSE)) q(stratum, seq, cell, n, total, instead)"


@query("quota_frame", f"""WITH q AS (SELECT * FROM {_STRATA}), m AS (SELECT doc_id, 'lang' AS stratum, lang AS cell, (n_chars % 2)::INT AS tier FROM documents UNION ALL SELECT doc_id, 'size', (length(text) // 700 % 3)::VARCHAR, 0 FROM documents UNION ALL SELECT doc_id, 'labelled', (quality + 2 * (doc_id % 3))::VARCHAR, 0 FROM labels),
o AS (SELECT m.*, seq, n, total, instead, sha256('quota:' || stratum || ':' || doc_id) AS h FROM m JOIN q USING (stratum, cell) WHERE doc_id % 10 <> 3),
r AS (SELECT *, row_number() OVER (PARTITION BY stratum, cell ORDER BY tier, h, doc_id) AS r, min(tier) OVER (PARTITION BY stratum, cell) AS low FROM o),
d AS (SELECT *, CASE WHEN (n IS NULL OR r <= n) AND (NOT instead OR tier = low) THEN 0 ELSE 1 END AS late FROM r), t AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY late, tier, h, doc_id) AS t FROM d),
p AS (SELECT * FROM t WHERE late = 0 OR t <= total) SELECT doc_id, arg_min(stratum, seq) AS stratum, arg_min(cell, seq) AS cell FROM p GROUP BY doc_id""")
def quota_frame(spark, d):
    """Cells by language with preferred rows, by length with a total, and all of one kind of labels; a tenth of the ids is excluded."""
    t = docs(spark, d)
    size, labels = F.expr("length(text) div 700") % 3, table(spark, d, "labels")
    members = t.select("doc_id", F.lit("lang").alias("stratum"), F.col("lang").alias("cell"), (F.col("n_chars") % 2).cast("int").alias("tier")).unionByName(t.select("doc_id", F.lit("size").alias("stratum"), size.cast("string").alias("cell"), F.lit(0).alias("tier")))
    members = members.unionByName(labels.select("doc_id", F.lit("labelled").alias("stratum"), (F.col("quality") + 2 * (F.col("doc_id") % 3)).cast("string").alias("cell"), F.lit(0).alias("tier")))
    quotas = spark.createDataFrame([("lang", 1, "de", 6, None, False), ("lang", 1, "en", 4, None, True), ("lang", 1, "fr", 5, None, False), *(("size", 2, str(k), 3, 14, False) for k in range(3)), ("labelled", 3, "0", None, None, False)], "stratum string, seq int, cell string, n int, total int, instead boolean")
    return sampling.quota_frame(members, quotas, "doc_id", "quota", t.where("doc_id % 10 = 3").select("doc_id"))
