"""The scored record of every matched pair, and all headline blocks from one pass over the records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.storage import written
from curata.functions.text import authors_match, citation_mentions, norm, string_ratio, year_match
from curata.functions.validate import RESULTS, TYPE_COLLAPSE, TYPES
from curata.operators import matching, metrics

# The numbers of a record that are compared, with the kind of their tolerance.
STATISTICS = {"original_n": "n", "original_es": "es", "original_p_value": "p", "replication_n": "n", "replication_es": "es", "replication_p_value": "p"}
THREE = ["success", "failure", "inconclusive"]
LABEL_FIELDS = ["row_id", "source", "split", "discipline_group", "year_bucket", "granularity", "gt_ambiguity", "effects_complete", "has_reversal_class", "provenance"]


def _statistic(name: str, kind: str) -> Column:
    """struct(gt_has, ext_has, both, type_mismatch, tier1, tier2, tier3); tiers are null where they aren't scored."""
    gt_type, ext_type = (F.col(f"{p}_{name}_type") if kind != "n" else F.lit("") for p in "ge")
    t = metrics.stat_tiers(kind, F.col(f"g_{name}"), F.col(f"e_{name}"), gt_type, ext_type)
    both = t["gt_has"] & t["ext_has"]
    mismatch = both & (norm(gt_type) != "") & (norm(ext_type) != "") & (norm(gt_type) != norm(ext_type)) if kind == "es" else F.lit(False)
    return F.struct(t["gt_has"].alias("gt_has"), t["ext_has"].alias("ext_has"), both.alias("both"), mismatch.alias("type_mismatch"), *(t[f"tier{i}"].alias(f"tier{i}") for i in (1, 2, 3)))


def _cut(name: str, n: int) -> Column:
    """What a record keeps of a text, cut before it is joined."""
    return F.left(F.coalesce(name, F.lit("")), F.lit(n))


def scored(matches: DataFrame, gt: DataFrame, ext: DataFrame, aliases: DataFrame, papers: DataFrame) -> DataFrame:
    """One record a match: labels of both sides, what agrees, and the statistics nested.

    matches: paper, gt, ext, method, relation, confidence, cost (of ``matching.staged``). gt: paper, gt, LABEL_FIELDS; ext:
    paper, ext, e_explanation; both (g_, e_): result, type, doi, title, authors, year, journal, description, citation, each
    of STATISTICS and, but for numbers of cases, its _type. papers: paper, tier, model. Missing texts count as empty.

    The paper's verdict on an original (ext_result_paper) is that of all its rows with the same original, where it is the
    only label for that original and not all effects are coded; for labels of whole papers that of all its rows, if none
    names the original.
    """
    gt, ext = matching.canonical(gt, "g_doi", aliases, "g_canon"), matching.canonical(ext, "e_doi", aliases, "e_canon")
    fold = F.create_map(*[F.lit(x) for kv in TYPE_COLLAPSE.items() for x in kv])
    gt = gt.withColumns({"g_result": norm(F.col("g_result")), "g_type": F.coalesce(F.element_at(fold, norm(F.col("g_type"))), norm(F.col("g_type"))), "g_doi": F.coalesce("g_doi", F.lit("")), "g_canon": F.coalesce("g_canon", F.lit("")), "g_description": _cut("g_description", 200)})
    ext = ext.withColumns({"e_result": norm(F.col("e_result")), "e_type": norm(F.col("e_type")), "e_doi": F.coalesce("e_doi", F.lit("")), "e_canon": F.coalesce("e_canon", F.lit("")), "e_description": _cut("e_description", 200), "e_explanation": _cut("e_explanation", 400)})
    named = ext.where("e_canon <> ''")
    count = lambda rows, *keys, name: rows.groupBy(*keys).agg(F.count("*").alias(name))
    same = metrics.paper_verdict(named, ["paper", "e_canon"], "e_result").join(count(named, "paper", "e_canon", name="_same_n"), ["paper", "e_canon"]).select("paper", F.col("e_canon").alias("g_canon"), F.col("verdict").alias("_same"), "_same_n")
    whole = metrics.paper_verdict(ext, "paper", "e_result").join(count(ext, "paper", name="_whole_n"), "paper").withColumnRenamed("verdict", "_whole")
    sole = count(gt.where("g_canon <> ''"), "paper", "g_canon", name="_labels")
    rows = matches.select("paper", "gt", "ext", F.col("method").alias("match_method"), F.col("relation").alias("match_relation"), F.col("confidence").alias("match_confidence"), F.col("cost").alias("match_cost"))
    rows = rows.join(gt, ["paper", "gt"]).join(ext, ["paper", "ext"]).join(same, ["paper", "g_canon"], "left").join(sole, ["paper", "g_canon"], "left").join(whole, "paper", "left").join(papers.select("paper", "tier", "model"), "paper", "left")

    c, flag = F.col, lambda x: F.coalesce(F.col(x), F.lit(False))
    ext_type = F.coalesce(F.element_at(fold, c("e_type")), c("e_type"))
    applied = ~flag("has_reversal_class") & (c("e_result") == "reversal")
    whole_paper = F.coalesce(c("granularity"), F.lit("")) == "paper"
    by_same = c("_same_n").isNotNull() & (whole_paper | ((c("_labels") == 1) & ~flag("effects_complete")))
    pooled = F.when(by_same, c("_same")).when(whole_paper, c("_whole"))
    pooled_n = F.when(by_same, c("_same_n")).when(whole_paper, c("_whole_n"))
    like = lambda a, b, least: string_ratio(c(a), c(b)) >= least
    sentence, mention = F.coalesce("e_citation", F.lit("")), citation_mentions(F.coalesce("e_citation", F.lit("")), c("g_authors"), c("g_year"))
    cited = F.trim(sentence) != ""
    said = F.coalesce("g_citation", F.lit("")) != ""
    kind = metrics.type_score(c("g_type"), c("e_type"))
    typed = c("g_type") != ""
    record = {
        "gt_result": c("g_result"), "ext_result_raw": c("e_result"), "collapse_applied": applied, "ext_result": F.when(applied, "failure").otherwise(c("e_result")),
        "gt_type": c("g_type"), "ext_type": ext_type, "doi_gt": c("g_doi"), "doi_ext": c("e_doi"),
        "gt_description": c("g_description"), "ext_description": c("e_description"), "ext_explanation": c("e_explanation"),
        "doi_scored": c("g_doi") != "", "doi_ok": (c("g_doi") != "") & (c("g_canon") == c("e_canon")), "doi_missing_ext": (c("g_doi") != "") & (c("e_doi") == ""),
        "bib_scored": F.coalesce("g_title", F.lit("")) != "", "title_ok": like("e_title", "g_title", 0.75), "journal_ok": like("e_journal", "g_journal", 0.75),
        "authors_ok": F.coalesce(authors_match(c("e_authors"), c("g_authors")), F.lit(False)), "year_ok": year_match(c("e_year"), c("g_year")),
        "type_scored": typed, "type_two_class": F.when(typed, kind["two_class"]), "type_ok": kind["ok"], "type_adjacent_ok": kind["adjacent_ok"],
        "type_two_ok": F.when(typed & ~kind["two_class"], (c("g_type") == "conceptual") == (ext_type == "conceptual")),
        "cit_present": cited, "cit_author_year_ok": F.when(cited, F.coalesce(mention["author_found"], F.lit(False)) & mention["year_found"]), "cit_overlap_ok": F.when(cited & said, like("e_citation", "g_citation", 0.6)),
        "ext_result_paper": pooled, "n_rows_aggregated": pooled_n, "stats": F.struct(*(_statistic(n, k).alias(n) for n, k in STATISTICS.items())),
    }
    out = rows.withColumns({"tier": F.coalesce("tier", F.lit("unknown")), "model": F.coalesce("model", F.lit(""))})
    ids = ["paper", "gt", "ext", *LABEL_FIELDS, "tier", "model", "match_method", "match_relation", "match_confidence", "match_cost"]
    out = out.select(*ids, *(x.alias(n) for n, x in record.items()))
    result_ok = lambda x: (F.col("gt_result") != "") & F.coalesce(F.col("gt_result") == F.col(x), F.lit(False))
    return out.withColumns({"result_ok": result_ok("ext_result"), "result_paper_ok": F.when(F.col("ext_result_paper").isNotNull(), result_ok("ext_result_paper")), "doi_alias_used": F.col("doi_ok") & (F.col("doi_gt") != F.col("doi_ext"))})


class Confusion:
    """Counts of pairs of labels, as aggregates over records, and what follows from their sums.

    Labels outside ``labels`` are counted together: they agree where they are equal, and for chance agreement they are one label.
    """

    def __init__(self, name: str, where: str, truth: str, found: str, labels: list[str]):
        self.name, self.where, self.truth, self.found, self.labels = name, where, truth, found, labels

    def _is(self, side: str, k: int) -> Column:
        return F.col(side) == self.labels[k] if k < len(self.labels) else ~F.coalesce(F.col(side).isin(self.labels), F.lit(False))

    def counts(self) -> dict[str, Column]:
        every = range(len(self.labels) + 1)
        cells = {self._key(i, j): F.count_if(F.expr(self.where) & self._is(self.truth, i) & self._is(self.found, j)) for i in every for j in every}
        return cells | {f"{self.name}_equal": F.count_if(F.expr(self.where) & (F.col(self.truth) == F.col(self.found)))}

    def _key(self, i: int, j: int) -> str:
        return f"{self.name}_{i}_{j}"

    def margins(self) -> dict[str, Column]:
        """Columns that the metrics need beside ``counts``: made of the summed counts, once."""
        every = range(len(self.labels) + 1)
        total = lambda pairs: sum((F.col(self._key(i, j)) for i, j in pairs), F.lit(0))
        rows = {f"{self.name}_support_{k}": total((k, j) for j in every) for k in every}
        columns = {f"{self.name}_predicted_{k}": total((i, k) for i in every) for k in every}
        return rows | columns | {f"{self.name}_n": total((i, j) for i in every for j in every)}

    def n(self) -> Column:
        return F.col(f"{self.name}_n")

    def accuracy(self) -> Column:
        return _rate(F.col(f"{self.name}_equal"), self.n())

    def kappa(self) -> Column:
        """Null without pairs, 1 if chance agreement is complete."""
        n = self.n().cast("double")
        chance = sum((self.support(k) * self.predicted(k) for k in range(len(self.labels) + 1)), F.lit(0)) / F.nullif(n * n, F.lit(0.0))
        return F.when(n > 0, F.when(chance < 1, (self.accuracy() - chance) / F.nullif(1 - chance, F.lit(0.0))).otherwise(1.0))

    def support(self, k: int) -> Column:
        return F.col(f"{self.name}_support_{k}")

    def predicted(self, k: int) -> Column:
        return F.col(f"{self.name}_predicted_{k}")

    def recall(self, label: str) -> Column:
        k = self.labels.index(label)
        return _rate(F.col(self._key(k, k)), self.support(k))

    def precision(self, label: str) -> Column:
        k = self.labels.index(label)
        return _rate(F.col(self._key(k, k)), self.predicted(k))

    def f1(self, label: str) -> Column:
        p, r, k = self.precision(label), self.recall(label), self.labels.index(label)
        return F.when((p > 0) & (r > 0), 2 * p * r / F.nullif(p + r, F.lit(0.0))).when((self.support(k) > 0) | (self.predicted(k) > 0), 0.0)

    def macro_f1(self, classes: list[str]) -> Column:
        """The mean over the classes with support."""
        has = {c: self.support(self.labels.index(c)) > 0 for c in classes}
        return _rate(sum((F.when(has[c], F.coalesce(self.f1(c), F.lit(0.0))).otherwise(0.0) for c in classes), F.lit(0.0)), sum((has[c].cast("int") for c in classes), F.lit(0)))

    def block(self, classes: list[str]) -> Column:
        """struct(n, accuracy, cohen_kappa, macro_f1, per_class, confusion)."""
        at = self.labels.index
        per = [F.struct(F.lit(c).alias("class"), self.support(at(c)).cast("long").alias("support"), self.predicted(at(c)).cast("long").alias("predicted"), F.col(self._key(at(c), at(c))).cast("long").alias("tp"), self.precision(c).alias("precision"), self.recall(c).alias("recall"), self.f1(c).alias("f1")) for c in classes]
        cells = [F.struct(F.lit(a).alias("gt"), F.lit(b).alias("ext"), F.col(self._key(at(a), at(b))).cast("long").alias("n")) for a in classes for b in classes]
        return F.struct(self.n().cast("long").alias("n"), self.accuracy().alias("accuracy"), self.kappa().alias("cohen_kappa"), self.macro_f1(classes).alias("macro_f1"), F.array(*per).alias("per_class"), F.array(*cells).alias("confusion"))


def _rate(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


# Which records a block is over, as SQL conditions.
HAS = "coalesce(gt_result, '') <> ''"
CLEAR = f"{HAS} and coalesce(gt_ambiguity, '') <> 'boundary'"
FOUR = f"{HAS} and not collapse_applied and coalesce(source, '') <> '' and coalesce(granularity, '') <> 'paper' and coalesce(has_reversal_class, false)"
RESULT_BLOCKS = {
    "result_3class": (Confusion("r3", HAS, "gt_result", "ext_result", RESULTS), THREE),
    "result_3class_paper": (Confusion("rp", f"{HAS} and coalesce(ext_result_paper, '') <> ''", "gt_result", "ext_result_paper", RESULTS), THREE),
    "result_3class_clear": (Confusion("rc", CLEAR, "gt_result", "ext_result", RESULTS), THREE),
    "result_4class": (Confusion("r4", FOUR, "gt_result", "ext_result_raw", RESULTS), RESULTS),
    "result_all_rows_raw": (Confusion("ra", HAS, "gt_result", "ext_result_raw", RESULTS), RESULTS),
}
TYPED, TWO = "type_scored and not coalesce(type_two_class, false)", "type_scored and coalesce(type_two_class, false)"
TYPE_BLOCK = Confusion("t", TYPED, "gt_type", "ext_type", TYPES)
SHARES = {
    "type_ok": ("type_ok", TYPED), "type_adjacent": ("type_adjacent_ok", TYPED), "type_two": ("type_ok", TWO), "doi_ok": ("doi_ok", "doi_scored"), "doi_missing": ("doi_missing_ext", "doi_scored"),
    "title_ok": ("title_ok", "bib_scored"), "authors_ok": ("authors_ok", "bib_scored"), "year_ok": ("year_ok", "bib_scored"), "journal_ok": ("journal_ok", "bib_scored"), "cit_present": ("cit_present", "true"), "cit_ok": ("cit_author_year_ok", "cit_present"),
}


def _share(name: str, value: str, where: str) -> dict[str, Column]:
    """How often value is known, and true, among the records where."""
    return {f"{name}_n": F.count_if(F.expr(where) & F.col(value).isNotNull()), f"{name}_yes": F.count_if(F.expr(where) & F.coalesce(F.col(value), F.lit(False)))}


def counts() -> dict[str, Column]:
    """All that the blocks need, as aggregates that add up over any parts of the records."""
    out = {"n_records": F.count("*"), "n_scored": F.count_if(F.expr(HAS)), "n_clear": F.count_if(F.expr(CLEAR)), "n_collapsed": F.count_if(F.expr(f"{HAS} and collapse_applied"))}
    out |= {"n_partial": F.count_if((F.coalesce("granularity", F.lit("")) != "paper") & ~F.coalesce("effects_complete", F.lit(False))), "n_typed": F.count_if("type_scored"), "n_two": F.count_if(F.expr(TWO)), "n_doi": F.count_if("doi_scored"), "n_bib": F.count_if("bib_scored")}
    for confusion in (*(c for c, _ in RESULT_BLOCKS.values()), TYPE_BLOCK):
        out |= confusion.counts()
    for name, (value, where) in SHARES.items():
        out |= _share(name, value, where)
    for f in STATISTICS:
        s = lambda x, f=f: F.coalesce(F.col(f"stats.{f}.{x}"), F.lit(False))
        out |= {f"{f}_gt": F.count_if(s("gt_has")), f"{f}_ext": F.count_if(s("ext_has")), f"{f}_both": F.count_if(s("both")), f"{f}_mismatch": F.count_if(s("both") & s("type_mismatch"))}
        for i in (1, 2, 3):
            out |= _share(f"{f}_tier{i}", f"stats.{f}.tier{i}", f"stats.{f}.both and not stats.{f}.type_mismatch")
    return out


def _kept(records: DataFrame) -> DataFrame:
    """The records without their texts, written: hundreds of counts then read columns, not what the columns are made of."""
    return written(records.drop("gt_description", "ext_description", "ext_explanation"), "records")


def summary(records: DataFrame, entry: DataFrame | None = None) -> DataFrame:
    """One row of all blocks, each a struct with its own denominators, from one aggregation over the records.

    entry: one row of tp, fp, fn over all papers.
    """
    c, share = F.col, lambda n: _rate(F.col(f"{n}_yes"), F.col(f"{n}_n"))
    row = _kept(records).agg(*(x.alias(n) for n, x in counts().items()))
    row = row.withColumns({n: x for confusion in (*(b for b, _ in RESULT_BLOCKS.values()), TYPE_BLOCK) for n, x in confusion.margins().items()})
    blocks = {name: confusion.block(classes) for name, (confusion, classes) in RESULT_BLOCKS.items()}
    blocks["replication_type"] = F.struct(c("n_typed").alias("n"), share("type_ok").alias("accuracy_4class"), TYPE_BLOCK.n().cast("long").alias("n_4class"), share("type_adjacent").alias("adjacent_accuracy"), TYPE_BLOCK.kappa().alias("kappa_4class"), share("type_two").alias("accuracy_2class_direct_or_close"), c("n_two").alias("n_2class"))
    blocks["original_doi"] = F.struct(c("n_doi").alias("n"), share("doi_ok").alias("accuracy"), share("doi_missing").alias("ext_missing_rate"))
    blocks["bibliographic"] = F.struct(c("n_bib").alias("n"), *(share(k).alias(k) for k in ("title_ok", "authors_ok", "year_ok", "journal_ok")))
    blocks["citation_sentence"] = F.struct(c("n_records").alias("n"), share("cit_present").alias("present_rate"), share("cit_ok").alias("author_year_ok_rate"))
    blocks["statistics"] = F.array(*(F.struct(F.lit(f).alias("field"), c(f"{f}_gt").alias("gt_has"), c(f"{f}_ext").alias("ext_has"), c(f"{f}_both").alias("both_present"), (c(f"{f}_gt") - c(f"{f}_both")).alias("gt_has_ext_missing"), (c(f"{f}_ext") - c(f"{f}_both")).alias("ext_has_gt_missing"), c(f"{f}_mismatch").alias("type_mismatch_unscored"), *(share(f"{f}_tier{i}").alias(f"tier{i}") for i in (1, 2, 3))) for f in STATISTICS))
    out = row.select(c("n_records").alias("n_matched_rows"), (c("n_partial") > 0).alias("precision_is_lower_bound"), (c("n_scored") - c("n_clear")).alias("boundary_rows_excluded"), c("n_collapsed").alias("collapse_applied_n"), *(x.alias(n) for n, x in blocks.items()))
    if entry is None:
        return out
    return out.join(F.broadcast(entry.select(F.struct("tp", "fp", "fn", metrics.prf(c("tp"), c("fp"), c("fn")).alias("rates")).alias("entry"))), F.lit(True), "left")  # one row each


def entry_counts(outcomes: DataFrame, whole_papers: DataFrame | None = None) -> DataFrame:
    """One row of tp, fp, fn, granularity_misses, wrong_original from the outcomes of ``matching.staged``.

    whole_papers(paper): where labels are of whole papers, rows beyond them aren't held against the finder.
    """
    extra = F.col("outcome") == "ext_unmatched"
    rows = outcomes if whole_papers is None else outcomes.join(whole_papers.select("paper", F.lit(True).alias("_whole")), "paper", "left")
    free = F.coalesce("_whole", F.lit(False)) if whole_papers is not None else F.lit(False)
    is_ = lambda x: F.count_if(F.col("outcome") == x)
    return rows.agg(is_("match").alias("tp"), F.count_if(extra & ~free).alias("fp"), is_("gt_unmatched").alias("fn"), is_("granularity_miss").alias("granularity_misses"), is_("wrong_original").alias("wrong_original"), F.count_if(extra & free).alias("extra_rows_paper_level"))


def intervals(records: DataFrame, paper: str = "paper", replicates: int = 2000, seed: int = 0) -> DataFrame:
    """metric, lo, hi, n_boot of the eight headline metrics, resampling papers."""
    r3, r4 = RESULT_BLOCKS["result_3class"][0], RESULT_BLOCKS["result_4class"][0]
    every = counts()
    needed = [*r3.counts(), *r4.counts(), "type_ok_n", "type_ok_yes", "doi_ok_n", "doi_ok_yes"]
    share = lambda n: _rate(F.col(f"{n}_yes"), F.nullif(F.col(f"{n}_n"), F.lit(0.0)))
    eight = {
        "result_3class.accuracy": r3.accuracy(), "result_3class.cohen_kappa": r3.kappa(), "result_3class.macro_f1": r3.macro_f1(THREE), "result_3class.inconclusive_recall": r3.recall("inconclusive"),
        "result_4class.accuracy": r4.accuracy(), "result_4class.reversal_recall": r4.recall("reversal"), "replication_type.accuracy_4class": share("type_ok"), "original_doi.accuracy": share("doi_ok"),
    }
    return metrics.replicated(_kept(records), paper, {c: every[c] for c in needed}, eight, replicates, seed, derived=r3.margins() | r4.margins())


def reports(outcomes: DataFrame, records: DataFrame, gt: DataFrame, ext: DataFrame) -> dict[str, DataFrame]:
    """The tables of one scoring run, which add up to its counts: matched, disagreements, unmatched, extra, per_paper."""
    matched = records.drop("stats")
    missing = outcomes.where("outcome = 'gt_unmatched'").select("paper", "gt").join(gt, ["paper", "gt"])
    extra = outcomes.where("outcome = 'ext_unmatched'").select("paper", "ext").join(ext, ["paper", "ext"])
    n = lambda x: F.count_if(F.col("outcome") == x)
    per = outcomes.groupBy("paper").agg(n("match").alias("n_matched"), n("gt_unmatched").alias("n_unmatched"), n("ext_unmatched").alias("n_extra"), n("granularity_miss").alias("n_granularity_misses"), n("wrong_original").alias("n_wrong_original"))
    right = records.groupBy("paper").agg(F.count_if("result_ok").alias("n_result_ok"), F.count_if(F.expr(HAS)).alias("n_result_scored"))
    return {"matched": matched, "disagreements": matched.where(f"{HAS} and not result_ok"), "unmatched": missing, "extra": extra, "per_paper": per.join(right, "paper", "left").na.fill(0, ["n_result_ok", "n_result_scored"])}


def write_reports(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Writes each table below folder; how many rows each has, observed while it is written."""
    from pyspark.sql import Observation

    found = {}
    for name, table in tables.items():
        seen = Observation(name)
        table.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{folder}/{name}")
        found[name] = seen.get["n"]
    return found
