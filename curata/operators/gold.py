"""Truth tables: loading them with their guards, building gold from coding sheets, exporting decisions, legacy sets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curata.functions.ids import doi_to_folder, normalize_doi, split_of
from curata.functions.storage import written
from curata.functions.text import last_names, norm, overlap, string_ratio, year_match
from curata.functions.validate import TYPE_COLLAPSE
from curata.operators.extraction import provenance_problems
from curata.operators.sampling import order_of, stratified
from curata.sources import readers

@dataclass
class Spec:
    """A set of labels: its CSV, its negatives' CSV, and what is true of all its rows."""

    path: str
    negatives: str | None = None
    source: str = ""
    granularity: str = "effect"
    has_reversal_class: bool = False
    effects_complete: bool = False
    manifest: dict[str, str] = field(default_factory=dict)  # path -> digest of its contents


def contents(spark: SparkSession, path: str) -> str:
    """One digest of a file, or of all files of a table's folder: SHA-256 over the sorted digests of their contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.sha2("content", 256).alias("h"), "length").where("length > 0")
    return files.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ","), 256).alias("d")).first()["d"]  # one short line a file


def truth_rows(raw: DataFrame, spec: Spec) -> DataFrame:
    """row_id, replication_doi, paper_folder, source, provenance, split, granularity, has_reversal_class, effects_complete, original_doi, result, replication_type."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")) if c in raw.columns else F.lit("")
    first = lambda *c: F.coalesce(*[F.nullif(text(x), F.lit("")) for x in c], F.lit(""))
    doi = F.coalesce(normalize_doi(first("replication_doi_norm", "replication_doi", "replication_url")), F.lit(""))
    collapse = F.create_map(*[F.lit(x) for kv in TYPE_COLLAPSE.items() for x in kv])
    kind = norm(text("replication_type"))
    own = F.substring(F.sha1(F.concat_ws("\x1f", text("original_url"), text("replication_url"), text("description"))), 1, 10)
    filled = lambda c, default: F.coalesce(F.nullif(text(c), F.lit("")), default)
    return raw.select(
        filled("row_id", own).alias("row_id"), doi.alias("replication_doi"), filled("paper_folder", F.when(doi != "", doi_to_folder(doi)).otherwise("")).alias("paper_folder"),
        filled("source_bucket", F.lit(spec.source)).alias("source"), text("provenance").alias("provenance"), filled("split", F.lit("all")).alias("split"),
        filled("granularity", F.lit(spec.granularity)).alias("granularity"), F.lit(spec.has_reversal_class).alias("has_reversal_class"), F.lit(spec.effects_complete).alias("effects_complete"),
        F.coalesce(normalize_doi(first("original_doi_norm", "original_doi", "original_url")), F.lit("")).alias("original_doi"), norm(text("result")).alias("result"), F.coalesce(F.element_at(collapse, kind), kind).alias("replication_type"),
    )


def truth(spark: SparkSession, spec: Spec, split: str = "all", allow_dirty: bool = False, allow_paper_level: bool = False) -> tuple[DataFrame, DataFrame, dict]:
    """(rows, negatives, info) of a set of labels. Refuses - with ValueError - files that don't match their manifest,
    rows without provenance, rows that the system under test wrote, rows of one label a paper, and empty sets."""
    info: dict = {"files": {}}
    for path, digest in spec.manifest.items():
        info["files"][path] = found = contents(spark, path)
        if found != digest:
            if not allow_dirty:
                raise ValueError(f"{path} doesn't match its manifest")
            info["dirty"] = True
    rows = truth_rows(readers.csv(spark, spec.path), spec)
    negatives = rows.select("replication_doi", "split").where("false").withColumn("label", F.lit(""))
    if spec.negatives:
        raw = readers.csv(spark, spec.negatives)
        negatives = raw.where(norm(F.col("label")).isin("negative", "no"))
    problems = {r["reason"]: r["n"] for r in provenance_problems(rows, allow_dirty, allow_paper_level).collect()}  # one row a reason
    if problems:
        raise ValueError(f"labels may not be used: {problems}")
    info["n_pipeline"] = rows.where(F.col("provenance").startswith("pipeline:")).count() if allow_dirty else 0
    if rows.isEmpty() and negatives.isEmpty():
        raise ValueError("no labels")
    if split != "all":
        rows = rows.where(F.col("split").isin(split, "all"))
        if "split" in negatives.columns:
            negatives = negatives.where(F.coalesce(F.nullif("split", F.lit("")), F.lit("all")).isin(split, "all"))
    return rows, negatives, info


def _rulings(queue: DataFrame, fields: list[str]) -> DataFrame:
    """row_id, ruled, a value for each field, ambiguity, adjudicator_id, adjudication_note of queue(seq, row_id, field,
    adjudicated_value, adjudicator_id, adjudication_note, gt_ambiguity)."""
    some = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    noted = some("gt_ambiguity")
    values = [F.max_by(F.when((F.col("field") == f) & some("adjudicated_value"), F.col("adjudicated_value")), F.when((F.col("field") == f) & some("adjudicated_value"), F.col("seq"))).alias(f"_{f}") for f in fields]
    notes = F.transform(F.array_sort(F.collect_list(F.when(noted & some("adjudication_note"), F.struct("seq", "adjudication_note")))), lambda x: x["adjudication_note"])
    return queue.groupBy("row_id").agg(
        F.bool_or(some("adjudicated_value") & some("adjudicator_id")).alias("_ruled"), *values, F.bool_or(F.col("gt_ambiguity") == "ambiguous").alias("_ambiguous"),
        F.array_join(F.array_sort(F.collect_set(F.when(noted & some("adjudicator_id"), F.col("adjudicator_id")))), ";").alias("_by"), F.array_join(notes, " | ").alias("_note"),
    )


def build(sheet: DataFrame, frame: DataFrame, queue: DataFrame, fields: list[str], coder: str, salt: str, second_coder: str | None = None, allow_unadjudicated: bool = False) -> tuple[DataFrame, DataFrame]:
    """(gold rows, negatives) of one coder's sheet after adjudication.

    sheet: row_id, paper_folder, replication_doi, is_replication_paper, why_negative, gt_ambiguity and fields; frame:
    paper_folder, replication_doi, source. Rows whose disagreements are open are left out, if that is allowed at all.
    Sheets of two coders are refused: their rows have no identity in common until somebody reconciles them.
    """
    if second_coder is not None:
        raise ValueError("gold of two coders needs reconciled entries")
    open_ = queue.where((F.col("reason") == "disagreement") & (F.coalesce("adjudicated_value", F.lit("")) == "")).select("row_id").distinct()
    if not allow_unadjudicated and not open_.isEmpty():
        raise ValueError("disagreements are not adjudicated")
    known = frame.select("paper_folder", F.col("replication_doi").alias("_doi"), F.col("source").alias("_source")).dropDuplicates(["paper_folder"])
    wanted = [*fields, "is_replication_paper"]
    rows = sheet.join(open_, "row_id", "left_anti").join(_rulings(queue, wanted), "row_id", "left").join(known, "paper_folder", "left")
    doi = F.coalesce(F.nullif("replication_doi", F.lit("")), "_doi", F.lit(""))
    value = lambda f: F.coalesce(F.col(f"_{f}"), F.col(f), F.lit(""))
    provenance = F.when(F.coalesce("_ruled", F.lit(False)), "human:adjudicated").otherwise(f"single_coder:{coder}")
    common = [doi.alias("replication_doi"), "paper_folder"]
    negative = F.col("row_id").endswith("#neg")
    negatives = rows.where(negative).select(*common, F.coalesce("_source", F.lit("")).alias("source"), F.when(norm(value("is_replication_paper")).isin("no", "negative", "n"), "negative").otherwise("positive_reclassified").alias("label"), "why_negative", split_of(doi, salt).alias("split"), provenance.alias("provenance"))
    gold = rows.where(~negative & (norm(F.col("result")) != ""))
    ambiguity = F.when(F.coalesce("_ambiguous", F.lit(False)), "ambiguous").otherwise(F.coalesce(F.nullif("gt_ambiguity", F.lit("")), F.lit("clear")))
    gold = gold.select("row_id", *common, F.coalesce("_source", F.lit("gold")).alias("source"), provenance.alias("provenance"), split_of(doi, salt).alias("split"), *[value(f).alias(f) for f in fields], ambiguity.alias("gt_ambiguity"), F.coalesce("_by", F.lit("")).alias("adjudicator_id"), F.coalesce("_note", F.lit("")).alias("adjudication_note"))
    return gold, negatives


def reviewed_by(kind: Column, reviewer: Column, model: Column) -> Column:
    """The provenance of a decision."""
    return F.when(kind == "human", F.concat(F.lit("human:"), F.replace(F.lower(F.trim(reviewer)), F.lit(" "), F.lit("_")))).otherwise(F.concat(F.lit("ai_adjudicated:"), model))


def export(decisions: DataFrame, kind: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, negatives, skipped) of the complete, valid decisions of one kind of reviewer; kinds are never mixed.

    decisions: folder, replication_doi, untouched, reviewer_kind, valid, eligibility, reason, reviewer, model, effects
    array<struct<effect_id, original_url, original_reference, result>>.
    """
    why = F.when(F.col("untouched"), "unreviewed").when(~F.col("reviewer_kind").eqNullSafe(F.lit(kind)), "other_kind").when(~F.col("valid"), "invalid")
    marked = decisions.withColumn("_why", why)
    skipped = marked.where("_why is not null").groupBy(F.col("_why").alias("reason")).agg(F.count("*").alias("n"))
    good = marked.where("_why is null").withColumn("provenance", reviewed_by(F.col("reviewer_kind"), F.col("reviewer"), F.col("model")))
    negatives = good.where("eligibility <> 'positive'").select("folder", "replication_doi", "provenance", F.when(F.col("eligibility") == "negative", "negative").otherwise("excluded").alias("label"), F.col("reason").alias("why_negative"))
    e = good.where("eligibility = 'positive'").select("folder", "replication_doi", "provenance", F.explode("effects").alias("e"))
    reference = F.coalesce("e.original_reference", F.lit(""))
    url = F.coalesce("e.original_url", F.lit(""))
    url = F.when((url == "") & reference.contains("/") & ~reference.contains(" "), reference).otherwise(url)
    return e.select(F.concat("folder", F.lit("#"), "e.effect_id").alias("row_id"), "folder", "replication_doi", "provenance", url.alias("original_url"), F.coalesce("e.result", F.lit("")).alias("result")), negatives, skipped


def _same(c: str) -> Column:
    return F.coalesce(normalize_doi(F.col(c)), F.lower(F.coalesce(c, F.lit(""))))


def legacy_split(rows: DataFrame, earlier: DataFrame, people: DataFrame, external: str = "external") -> DataFrame:
    """seq, provenance, part, fix_note, result_before, needs_adjudication of each of rows(seq, original_url, replication_url,
    description, result, validated_person), by an earlier version of the table.

    people(person, provenance) says where a person's labels come from, unknown of all others. part is self_replication or
    duplicate (which go), external - provenances that begin so - or human. A label is a flip if it isn't that of the only
    earlier row of the pair, which must be the only one of the pair now, too.
    """
    own = rows.withColumns({"_o": _same("original_url"), "_p": _same("replication_url"), "_d": F.lower(F.trim(F.coalesce("description", F.lit(""))))})
    counts = own.groupBy("_o", "_p").agg(F.count("*").alias("_n"))
    first = own.where((F.col("_o") == "") | (F.col("_o") != F.col("_p"))).groupBy("_o", "_p", "_d").agg(F.min("seq").alias("_first"))
    before = earlier.select(_same("original_url").alias("_o"), _same("replication_url").alias("_p"), F.lower(F.trim(F.coalesce("result", F.lit("")))).alias("_r")).groupBy("_o", "_p").agg(F.count("*").alias("_m"), F.min("_r").alias("_r"))
    known = people.groupBy(F.col("person").alias("validated_person")).agg(F.min("provenance").alias("_provenance"))
    own = own.withColumn("validated_person", F.coalesce("validated_person", F.lit(""))).join(known, "validated_person", "left")
    j = own.join(counts, ["_o", "_p"]).join(first, ["_o", "_p", "_d"], "left").join(before, ["_o", "_p"], "left")
    self_ = (F.col("_o") != "") & (F.col("_o") == F.col("_p"))
    provenance = F.coalesce("_provenance", F.lit("unknown"))
    part = F.when(self_, "self_replication").when(F.col("seq") > F.col("_first"), "duplicate").when(provenance.startswith(external), "external").otherwise("human")
    single = ~part.isin("self_replication", "duplicate") & F.coalesce((F.col("_m") == 1) & (F.col("_n") == 1), F.lit(False))
    now = F.lower(F.trim(F.coalesce("result", F.lit(""))))
    flip = single & (F.col("_r") != "") & (now != "") & (F.col("_r") != now)
    note = F.when(~part.isin("self_replication", "duplicate") & (F.col("_n") > 1), "several effects of one pair").otherwise("")
    return j.select("seq", provenance.alias("provenance"), part.alias("part"), note.alias("fix_note"), F.when(single, F.col("_r")).otherwise("").alias("result_before"), F.when(flip, "yes").otherwise("").alias("needs_adjudication"))


def best_candidates(found: DataFrame, truth_: DataFrame) -> DataFrame:
    """ext, n_candidates, gt, score, title, authors, same_year: for each found entry the label of its paper that agrees best.

    found and truth_: paper, ext or gt, and title, authors, year; score counts title at 0.75, authors at 0.7 and the
    year; of equals the one with the nearer title, then the first.
    """
    a = found.select("paper", "ext", *[F.col(c).alias(f"e_{c}") for c in ("title", "authors", "year")])
    b = truth_.select("paper", "gt", *[F.col(c).alias(f"g_{c}") for c in ("title", "authors", "year")])
    pairs = a.join(b, "paper").withColumns({"_t": string_ratio("e_title", "g_title"), "_a": overlap(last_names(F.col("e_authors")), last_names(F.col("g_authors"))), "_y": year_match(F.col("e_year"), F.col("g_year"))})
    score = (F.col("_t") >= 0.75).cast("int") + (F.col("_a") >= 0.7).cast("int") + F.col("_y").cast("int")
    order = F.struct(score.alias("s"), F.col("_t").alias("t"), (-F.col("gt")).alias("g"))
    best = pairs.groupBy("paper", "ext").agg(F.count("*").alias("n_candidates"), F.max_by(F.struct("gt", score.alias("score"), F.col("_t").alias("title"), F.col("_a").alias("authors"), F.col("_y").alias("same_year")), order).alias("x"))
    return best.select("paper", "ext", "n_candidates", "x.*")


# Words that say nothing about a topic.
TOPIC_STOP_WORDS = ["the", "a", "an", "of", "in", "and", "on", "for", "to", "is", "by", "with", "from", "are", "at", "or"]


def diagnosis(found_title: Column, true_title: Column, authors: Column, same_year: Column) -> Column:
    """What may have led to another study: authors, year and topic in common, or nothing."""
    words = lambda c: F.array_except(F.filter(F.split(norm(c), r"\s+"), lambda w: w != ""), F.array(*map(F.lit, TOPIC_STOP_WORDS)))
    shared = F.array_sort(F.array_intersect(words(found_title), words(true_title)))
    n = F.size(shared)
    who = F.when(authors >= 0.5, "same research group").when(authors > 0, "some authors in common")
    when = F.when(same_year, "same year")
    topic = F.when(n >= 3, F.concat(F.lit("related topic: "), F.array_join(F.slice(shared, 1, 5), ", "))).when(n >= 1, F.concat(F.lit("weak topical overlap: "), F.array_join(F.slice(shared, 1, 3), ", ")))
    out = F.concat_ws("; ", who, when, topic)
    return F.when(out == "", "completely different study").otherwise(out)


def pilot(rows: DataFrame, usable: DataFrame, n_multi: int, n_single: int, seed: str) -> DataFrame:
    """row_id, multi of a sample of eligible rows(row_id, original, folder, bucket): so many of originals with several rows and
    of others, in proportion to buckets; rows whose folder isn't usable(folder) are replaced by others in hash order."""
    counts = rows.groupBy("original").agg((F.count("*") > 1).alias("multi"))
    pool = rows.join(counts, "original")
    picked = stratified(pool.where("multi"), "bucket", "row_id", n_multi, seed).unionByName(stratified(pool.where("not multi"), "bucket", "row_id", n_single, seed))
    kept = picked.join(usable.select("folder").distinct(), "folder", "left_semi").select("row_id", "multi")
    lost = picked.agg(F.count("*").alias("_p")).join(F.broadcast(kept.agg(F.count("*").alias("_k"))))  # two tables of one row
    spare = pool.join(picked.select("row_id"), "row_id", "left_anti").join(usable.select("folder").distinct(), "folder", "left_semi")
    spare = spare.orderBy(order_of(seed, F.col("row_id")), "row_id").limit(n_multi + n_single).select("row_id", "multi", order_of(seed, F.col("row_id")).alias("_h"))
    ranked = spare.withColumn("_r", F.row_number().over(Window.orderBy("_h", "row_id")))  # n_multi + n_single rows at most
    more = ranked.join(F.broadcast(lost), (F.col("_r") <= n_multi + n_single - F.col("_k")) & (F.col("_p") > F.col("_k"))).select("row_id", "multi")
    return kept.unionByName(more)


def enhanced(labels: DataFrame, found: DataFrame, fields: list[str]) -> DataFrame:
    """paper, gt, ext, change, n_filled and fields of every label, and of what a finder adds to it.

    labels: paper, gt, g_doi, g_title, g_authors, g_year and (g_) fields; found: paper, ext, and the same as e_. A label takes
    the first found entry of its paper, by ext, that agrees in two of title (ratio 0.75), authors and year; several may
    take one. Its blank fields are filled from that. Entries whose title is like no label's of the paper (0.8) are
    added, once for each label of the paper that took another entry. change is kept (the paper has no entries, or
    nothing was blank), filled, added or review (entries, but none agrees).
    """
    from curata.functions.text import authors_match, letters, letters_could_reach
    from curata.operators.matching import pairs_in_block

    like = pairs_in_block(labels, found, "paper")
    near = letters_could_reach(F.col("g_letters"), F.col("e_letters"), 0.75)
    score = (string_ratio(*(F.when(near, F.col(c)).otherwise("") for c in ("g_title", "e_title"))) >= 0.75).cast("int") + authors_match(F.col("g_authors"), F.col("e_authors")).cast("int") + year_match(F.col("g_year"), F.col("e_year")).cast("int")
    took = like.where(score >= 2).groupBy("paper", "gt").agg(F.min("ext").alias("ext"))
    took = written(took, "taken")
    titles = labels.select("paper", "g_title", letters("g_title").alias("_g")).join(found.select("paper", "ext", "e_title", letters("e_title").alias("_e")), "paper").where(letters_could_reach(F.col("_g"), F.col("_e"), 0.8))
    known = titles.where(string_ratio("g_title", "e_title") >= 0.8).select("paper", "ext").distinct()
    new = found.join(known, ["paper", "ext"], "left_anti")
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    own = labels.join(took, ["paper", "gt"], "left").join(found.select("paper", "ext", *(f"e_{f}" for f in fields)), ["paper", "ext"], "left")
    fill = {f: blank(f"g_{f}") & ~blank(f"e_{f}") for f in fields}
    n = sum((F.coalesce(x, F.lit(False)).cast("int") for x in fill.values()), F.lit(0))
    there = found.select("paper").distinct().withColumn("_there", F.lit(True))
    change = F.when(F.col("ext").isNull() & F.col("_there"), "review").when(n > 0, "filled").otherwise("kept")
    rows = own.join(there, "paper", "left").select("paper", "gt", "ext", change.alias("change"), n.alias("n_filled"), *(F.when(fill[f], F.col(f"e_{f}")).otherwise(F.col(f"g_{f}")).alias(f) for f in fields))
    added = took.select("paper", "gt", F.col("ext").alias("_own")).join(new, "paper").where(F.col("ext") != F.col("_own"))
    return rows.unionByName(added.select("paper", "gt", "ext", F.lit("added").alias("change"), F.lit(0).alias("n_filled"), *(F.col(f"e_{f}").alias(f) for f in fields)))
