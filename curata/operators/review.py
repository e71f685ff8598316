"""Auditing, review packets and summaries around labelled entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicates(rows: DataFrame, key: str, same: list[str]) -> DataFrame:
    """key, first: rows equal in all of ``same`` to an earlier one, and that one."""
    w = Window.partitionBy("_h").orderBy(key)
    rows = rows.withColumn("_h", F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in same]), 256))
    return rows.withColumns({"_n": F.row_number().over(w), "first": F.first(key).over(w)}).where("_n > 1").select(key, "first")


def conflicts(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, field, n: fields with several distinct values within a key."""
    counts = rows.groupBy(key).agg(*[F.count_distinct(f).alias(f) for f in fields])
    pairs = counts.select(key, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("n")) for f in fields])).alias("x"))
    return pairs.select(key, "x.*").where("n > 1")


def enumeration(rows: DataFrame, paper: str, coder: str, coders: tuple[str, str]) -> DataFrame:
    """paper, n_a, n_b, equal: how many entries two coders list."""
    g = rows.groupBy(paper).agg(F.count_if(F.col(coder) == coders[0]).alias("n_a"), F.count_if(F.col(coder) == coders[1]).alias("n_b"))
    return g.withColumn("equal", F.col("n_a") == F.col("n_b"))


def finding(duplicate: Column, original: Column, known: Column, cited: Column, agrees: Column) -> Column:
    """The first thing wrong with a reference row, in this order, or ok. cited and agrees may be unknown (NULL)."""
    return F.when(duplicate, "duplicate_row").when(F.coalesce(original, F.lit("")) == "", "no_original").when(~known, "doi_unknown").when(~F.coalesce(agrees, F.lit(True)) & F.coalesce(cited, F.lit(False)), "mismatch_resolved").when(~F.coalesce(agrees, F.lit(True)), "mismatch").when(~F.coalesce(cited, F.lit(True)), "not_cited").otherwise("ok")


def cited(text: Column, doi: Column, names: Column, least: int = 20_000) -> Column:
    """Whether a text has the DOI or a (folded) name; NULL if the text is short or there are no names."""
    low = F.lower(text)
    return F.when((F.length(text) < least) | (F.size(names) == 0), None).otherwise(((F.coalesce(doi, F.lit("")) != "") & low.contains(doi)) | F.exists(names, lambda n: low.contains(n)))


def errors(*checks: tuple[str, Column]) -> Column:
    """Sorted distinct messages whose condition holds."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(c, m) for m, c in checks]))))


def imported(rows: DataFrame, doi: Column, same: list[str], order: str) -> DataFrame:
    """Adds reason: no DOI, a repeat of an earlier row, or NULL where the row is taken. order: one value a row.

    The first row of a key is found by an aggregate, so keys that many rows share, blank ones too, are combined before they travel.
    """
    keyed = rows.withColumn("_doi", doi)
    none, some = keyed.where("_doi is null"), keyed.where("_doi is not null")
    first = some.groupBy(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(same)]).agg(F.min(order).alias("_first"))
    on = None
    for i, c in enumerate(same):
        on = F.col(c).eqNullSafe(F.col(f"_s{i}")) if on is None else on & F.col(c).eqNullSafe(F.col(f"_s{i}"))
    taken = some.join(first, on).withColumn("reason", F.when(F.col(order) > F.col("_first"), "duplicate"))
    return taken.select(*rows.columns, "reason").unionByName(none.withColumn("reason", F.lit("not a DOI")).select(*rows.columns, "reason"))


def recovered(sheets: DataFrame, logs: DataFrame, key: str, pattern: str) -> DataFrame:
    """key, logged, counted, accepted: a run is accepted if as many rows are unmarked as its log says were coded."""
    said = logs.select(key, F.regexp_extract("line", pattern, 1).try_cast("long").alias("logged")).where("logged is not null").groupBy(key).agg(F.max("logged").alias("logged"))
    have = sheets.groupBy(key).agg(F.count_if(~F.col("marked")).alias("counted"))
    return said.join(have, key, "left").select(key, "logged", F.coalesce("counted", F.lit(0)).alias("counted"), (F.coalesce("counted", F.lit(0)) == F.col("logged")).alias("accepted"))


def packets(candidates: DataFrame, paper: str, order: str, fields: list[str]) -> DataFrame:
    """One nested packet a paper: its candidates in order, how many, and a content hash."""
    rows = candidates.groupBy(paper).agg(F.array_sort(F.collect_list(F.struct(order, *fields))).alias("candidates"))
    return rows.withColumns({"n": F.size("candidates"), "hash": F.sha2(F.to_json("candidates"), 256)})


def refreshed(old: DataFrame, new: DataFrame, key: str, untouched: Column) -> DataFrame:
    """Rebuilt decisions: a started one stays, an untouched template takes the new content. Columns: key, content."""
    o = old.select(key, F.col("content").alias("_old"), untouched.alias("_free"))
    return new.join(o, key, "full").select(key, F.when(F.col("_old").isNull() | (F.col("_free") & F.col("content").isNotNull()), F.col("content")).otherwise(F.col("_old")).alias("content"))


def sheet(rows: DataFrame, anchors: str, allowed: list[str]) -> DataFrame:
    """A blinded coding sheet: one row an anchor of the ;-list, allowed columns only."""
    out = rows.withColumn("anchor", F.explode(F.filter(F.transform(F.split(anchors, ";"), lambda a: F.trim(a)), lambda a: a != "")))
    return out.select(*[c for c in rows.columns if c in allowed], "anchor")


def complete(labels: DataFrame, wanted: DataFrame, unit: str, row: str, valid: list[str]) -> DataFrame:
    """unit, complete: the labels returned are for exactly the rows asked for, all valid. Rows are joined, so no set is gathered."""
    got = labels.groupBy(unit, row).agg(F.bool_and(F.coalesce(F.col("label").isin(valid), F.lit(False))).alias("_ok"))
    ask = wanted.select(unit, row).distinct().withColumn("_ask", F.lit(True))
    right = F.coalesce(F.col("_ask") & F.col("_ok"), F.lit(False))  # asked for, returned and valid
    both = ask.join(got, [unit, row], "full").groupBy(unit).agg(F.bool_and(right).alias("complete"), F.bool_or(F.coalesce("_ask", F.lit(False))).alias("_asked"))
    return both.where("_asked").select(unit, "complete")


def transcribed(c: Column) -> Column:
    """An author's wording of an outcome: failure if it says so, else verbatim."""
    return F.when(F.lower(c).contains("failure"), "failure").otherwise(F.lower(F.trim(c)))


def summary(rows: DataFrame) -> DataFrame:
    """One row of headline rates. rows: gt, ext, type_ok, doi_ok, boundary; NULL where a thing isn't scored."""
    ok = (F.col("gt") == F.col("ext")).cast("double")
    rate = lambda c: F.avg(c.cast("double"))
    return rows.agg(F.count("*").alias("n"), F.avg(ok).alias("accuracy"), F.avg(F.when(~F.col("boundary"), ok)).alias("accuracy_clear"), F.count_if("boundary").alias("n_boundary"), rate(F.col("type_ok")).alias("type_accuracy"), rate(F.col("doi_ok")).alias("doi_accuracy"))


def retest(pairs: DataFrame, a: DataFrame, b: DataFrame, paper: str) -> DataFrame:
    """One row: share of papers with as many entries in both runs, and share of matched entries that agree."""
    n = a.groupBy(paper).agg(F.count("*").alias("x")).join(b.groupBy(paper).agg(F.count("*").alias("y")), paper, "full").na.fill(0, ["x", "y"])
    same = n.agg(F.avg((F.col("x") == F.col("y")).cast("double")).alias("same_count"))
    return same.join(F.broadcast(pairs.agg(F.avg((F.col("a") == F.col("b")).cast("double")).alias("agreement"), F.count("*").alias("n_matched"))))  # one row each


def match_audit(rows: DataFrame) -> DataFrame:
    """confidence, precision of matches and correct rate of non-matches. rows: matched, verdict, confidence."""
    return rows.groupBy("confidence").agg(F.avg(F.when(F.col("matched"), F.col("verdict").cast("double"))).alias("precision"), F.avg(F.when(~F.col("matched"), F.col("verdict").cast("double"))).alias("correct_non_matches"))


def changelog(lines: DataFrame) -> DataFrame:
    """section, file, sha of the table rows below each heading. lines(no, line) of one file."""
    w = Window.orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.regexp_extract("line", r"^#+\s*(.*)$", 1)
    rows = lines.withColumn("section", F.last(F.when(heading != "", heading), ignorenulls=True).over(w))
    found = rows.select("section", F.regexp_extract("line", r"^\|\s*([^|]+?)\s*\|\s*([0-9a-f]{6,64})\s*\|", 1).alias("file"), F.regexp_extract("line", r"^\|\s*([^|]+?)\s*\|\s*([0-9a-f]{6,64})\s*\|", 2).alias("sha"))
    return found.where("file <> ''")


def best_description(rows: DataFrame, case: str, seq: str) -> DataFrame:
    """case, description: one whose result is the case's if there is one, else the first that isn't blank."""
    real = F.trim(F.coalesce(F.col("description"), F.lit(""))) != ""
    order = F.struct((F.col("result") != F.col("case_result")).alias("d"), F.col(seq).alias("s"))
    return rows.groupBy(case).agg(F.min_by(F.when(real, F.col("description")), F.when(real, order)).alias("description"))


def totals(logs: DataFrame) -> DataFrame:
    """kind, n, tokens, cost of batch logs(kind, tokens, cost)."""
    return logs.groupBy("kind").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"), F.sum("cost").alias("cost"))


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What has no output yet: a rerun does the rest only."""
    return work.join(done.select(key), key, "left_anti")


def overridden(rows: DataFrame, overrides: DataFrame, key: str, field: str) -> DataFrame:
    return rows.join(overrides.select(key, F.col(field).alias("_o")), key, "left").withColumn(field, F.coalesce("_o", field)).drop("_o")


def resumed(work: DataFrame, done: DataFrame, key: str, recorded_rows: int | None) -> DataFrame:
    """``pending``, unless the input isn't the one that the recorded work began with, by its number of rows."""
    if recorded_rows is not None and (n := work.count()) != recorded_rows:
        raise ValueError(f"the input has {n} rows, recorded work began with {recorded_rows}")
    return pending(work, done, key)


def stale_caches(cached: DataFrame, current: DataFrame) -> DataFrame:
    """name, stale: whether a cached result of cached(name, inputs) - struct(length, modified) by input - isn't of the current inputs."""
    both = cached.select("name", F.col("inputs").alias("_a")).join(current.select("name", F.col("inputs").alias("_b")), "name", "full")
    return both.select("name", (~F.col("_a").eqNullSafe(F.col("_b"))).alias("stale"))


def ledger_uses(ledger: DataFrame, new: DataFrame, version: str = "prompt_version") -> DataFrame:
    """version, n: how often the versions of new entries have been used, they included."""
    every = ledger.unionByName(new)
    return every.join(new.select(version).distinct(), version, "left_semi").groupBy(version).agg(F.count("*").alias("n"))
