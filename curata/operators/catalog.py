"""The corpus catalog: status, latest run, filters, plans for moves, ladders of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.functions.ids import doi_to_folder, folder_to_doi, normalize_doi
from curata.functions.storage import written

# States of a paper, highest first, and the ladder of full-text tiers.
STATUSES = ["ingested", "extracted", "screened", "converted", "downloaded", "empty"]
TIERS = ["xml", "html", "grobid", "pdf", "raw"]


def status(**flags: Column) -> Column:
    """The highest state whose flag is set, else empty."""
    case = None
    for name in STATUSES[:-1]:
        if name in flags:
            case = F.when(flags[name], name) if case is None else case.when(flags[name], name)
    return case.otherwise("empty")


def version_array(c: Column) -> Column:
    """All integers of a version; empty for none, which sorts lowest."""
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(\d+)")), lambda x: x.cast("int"))


def latest_run(runs: DataFrame, paper: str, version: Column, run_at: Column, n: Column, *tie: Column) -> DataFrame:
    """The run with the highest (version numbers, time, entries) of each paper; its verdict only if it has one."""
    order = F.struct(version.alias("v"), run_at.alias("t"), n.alias("n"), *[c.alias(f"t{i}") for i, c in enumerate(tie)])
    return runs.groupBy(paper).agg(F.max_by(F.struct(*[F.col(c) for c in runs.columns if c != paper]), order).alias("latest"), F.count("*").alias("n_runs")).select(paper, "latest.*", "n_runs")


def selected(catalog: DataFrame, status: str | None = None, contains: bool | None = None, batch: str | None = None, without_tag: str | None = None, limit: int | None = None) -> DataFrame:
    """Optional conditions, in order of doi. A tag must be equal to one of the tags, not be like it."""
    out = catalog
    if status is not None:
        out = out.where(F.col("status") == status)
    if contains is not None:
        out = out.where(F.col("contains") == contains)
    if batch is not None:
        out = out.where(F.col("source_batch") == batch)
    if without_tag is not None:
        out = out.where(~F.array_contains("tags", without_tag))
    out = out.orderBy("doi")
    return out.limit(limit) if limit is not None else out


def include_list(catalog: DataFrame, exclude_without: bool = False, **conditions) -> DataFrame:
    """The folder names (not their paths) of the papers that meet the conditions of ``selected``."""
    out = selected(catalog, **conditions)
    if exclude_without:
        out = out.where(F.coalesce("contains", F.lit(True)))
    return out.select(F.element_at(F.split("folder", "/"), -1).alias("folder"))


def statistics(catalog: DataFrame) -> DataFrame:
    """One row a status and one in all (status NULL): papers, with, without, unknown, entries."""
    c = F.col("contains")
    return catalog.groupingSets([["status"], []], "status").agg(F.count("*").alias("n"), F.count_if(c).alias("n_with"), F.count_if(~c).alias("n_without"), F.count_if(c.isNull()).alias("n_unknown"), F.sum("n_entries").alias("n_entries"))


def rebuilt(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key and what a full rebuild does with it: added, removed or kept."""
    o, n = old.select(key).distinct().withColumn("_o", F.lit(True)), new.select(key).distinct().withColumn("_n", F.lit(True))
    return o.join(n, key, "full").select(key, F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").otherwise("kept").alias("change"))


def marked(catalog: DataFrame, done: DataFrame, version: str) -> DataFrame:
    """Sets ingested on catalog rows whose doi is in done(doi), whatever its case."""
    d = done.select(F.lower("doi").alias("_k")).distinct()
    return catalog.join(d, F.lower("doi") == F.col("_k"), "left").withColumn("ingested", F.when(F.col("_k").isNotNull(), F.lit(version)).otherwise(F.col("ingested"))).drop("_k")


def merged_passport(old: DataFrame, new: DataFrame, key: str, default: list[str], overwrite: list[str]) -> DataFrame:
    """default fields keep the old value where there is one, overwrite fields take the new."""
    n = new.select(F.col(key), *[F.col(c).alias(f"_{c}") for c in [*default, *overwrite]])
    return old.join(n, key, "full").select(key, *[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) for c in default], *[F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) for c in overwrite])


def best_rung(files: DataFrame, folder: str, rank: Column, path: str) -> DataFrame:
    """The file with the least rank of each folder, the first by name of equals."""
    return files.withColumn("_r", rank).where("_r is not null").groupBy(folder).agg(F.min_by(path, F.struct(F.col("_r").alias("r"), F.col(path).alias("p"))).alias("best"), F.min("_r").alias("rank"))


def text_tier(files: DataFrame) -> DataFrame:
    """folder, tier: the best of files(folder, tier); raw markup only if there is nothing else."""
    rank = F.element_at(F.create_map(*[F.lit(x) for i, t in enumerate(TIERS) for x in (t, i)]), F.col("tier"))
    return files.withColumn("_r", rank).groupBy("folder").agg(F.min_by("tier", "_r").alias("tier"))


def husk(n_chars: Column, rendition: Column, pages: Column) -> Column:
    """Why a text is too little to read, or NULL."""
    return F.when(~rendition & (n_chars < 500), "under 500 characters").when(~rendition & (n_chars < 2000) & (pages == 1), "one page under 2000 characters")


def distinctive(c: Column) -> Column:
    """Distinct words of more than four letters or digits."""
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9]+)")), lambda w: F.length(w) > 4))


def wrong_document(expected_title: Column, text: Column) -> Column:
    """Whether a text shares fewer than two (or all) distinctive words of the title in its first 5000 characters."""
    want = distinctive(expected_title)
    return (F.size(want) > 0) & (F.size(F.array_intersect(want, distinctive(F.substring(text, 1, 5000)))) < F.least(F.lit(2), F.size(want)))


def without_kind(folders: DataFrame, files: DataFrame, suffixes: list[str]) -> DataFrame:
    """Folders none of whose files ends with one of the suffixes."""
    ends = F.greatest(*[F.col("name").endswith(s) for s in suffixes]) if len(suffixes) > 1 else F.col("name").endswith(suffixes[0])
    return folders.join(files.where(ends).select("folder").distinct(), "folder", "left_anti")


def adoption(records: DataFrame) -> DataFrame:
    """record, plan of files(record, kind, exists_in_corpus): what to do with a downloaded record."""
    g = records.groupBy("record").agg(F.bool_or(F.col("kind") == "pdf").alias("pdf"), F.bool_or(F.col("kind") == "text").alias("text"), F.bool_or("exists_in_corpus").alias("folder"))
    return g.select("record", F.when(F.col("pdf"), "awaiting_conversion").when(~F.col("folder") & ~F.col("text"), "no_paper_folder").otherwise("adopt").alias("plan"))


def inbox_plan(name: Column) -> Column:
    """The stem of an inbox name that survives decoding and encoding, else NULL."""
    return F.when(doi_to_folder(folder_to_doi(name)) == name, name)


def repair_plan(folders: DataFrame) -> DataFrame:
    """folder, target, plan of folders(folder, doi_file, doi_index): the ladder of DOI sources, then conflicts."""
    doi = F.coalesce(normalize_doi(F.col("doi_file")), normalize_doi(F.col("doi_index")), normalize_doi(folder_to_doi(F.regexp_replace("folder", r"\s*\(.*\)$", ""))))
    out = folders.withColumn("target", doi_to_folder(doi))
    none, out = out.where("target is null"), out.where("target is not null")
    taken = out.groupBy(F.col("target").alias("_target")).agg(F.count("*").alias("_k"))  # combined before it travels
    have = folders.select(F.col("folder").alias("_have")).distinct()
    out = out.join(taken, F.col("target") == F.col("_target")).join(have, F.col("target") == F.col("_have"), "left")
    plan = F.when(F.col("target") == F.col("folder"), "fine").when((F.col("_k") > 1) | F.col("_have").isNotNull(), "conflict").otherwise("rename")
    return out.select("folder", "target", plan.alias("plan")).unionByName(none.select("folder", "target", F.lit("unresolved").alias("plan")))


def known_dois(tables: list[DataFrame]) -> DataFrame:
    """key, doi: every DOI in a column named *doi*, *_url or url of the tables by its punctuation-blind key; keys of several go."""
    from curata.functions.ids import alnum_key, first_doi
    from curata.operators.resolve import unambiguous

    found = None
    for t in tables:
        columns = [c for c in t.columns if "doi" in c.lower() or c.lower().endswith("_url") or c.lower() == "url"]
        one = t.select(F.explode(F.array(*[first_doi(F.col(c)) for c in columns])).alias("doi")).where("doi is not null")
        found = one if found is None else found.union(one)
    return unambiguous(found.withColumn("key", alnum_key(F.col("doi"))), "key", "doi")


def prefix_probe(probes: DataFrame, keys: DataFrame, least: int = 12) -> DataFrame:
    """probe, key: the only key that a (truncated) probe of ``least`` characters at least is a prefix of.

    In order, keys with a prefix follow it directly, so a probe needs the next two keys above it only. Probes and keys are
    sorted together by range and each task reads its rows downwards, keeping the last two keys; those above a task's
    rows come from the tasks after it, one row each. So neither a common prefix nor a short probe makes pairs.
    """
    import pyarrow as pa
    from pyspark import TaskContext

    spark = probes.sparkSession
    rows = keys.where("key is not null").groupBy(F.col("key").alias("value")).agg(F.count("*").alias("n"))
    rows = rows.unionByName(probes.where(F.length("probe") >= least).select(F.col("probe").alias("value"), F.lit(0).cast("long").alias("n")).distinct())
    names = ["task", "probe", "first", "n", "second", "n_second"]
    types = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def scan(batches):
        task, above = TaskContext.get().partitionId(), [(None, None), (None, None)]
        rows = 0
        for batch in batches:
            out = []
            for value, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if n:
                    above = [(value, n), above[0]]
                else:
                    out.append((task, value, *above[0], *above[1]))
            rows += len(batch)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 6, types, strict=True)], names)
        if rows:  # the two least keys of the task
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((task, None, *above[0], *above[1]), types, strict=True)], names)

    # a probe comes after an equal key on the way down, which it is then a prefix of
    ordered = rows.repartitionByRange("value").sortWithinPartitions(F.desc("value"), F.desc("n"))
    found = written(ordered.select("value", "n").mapInArrow(scan, "task int, probe string, first string, n long, second string, n_second long"), "probes")
    carried, above = [], [(None, None), (None, None)]
    for r in found.where("probe is null").orderBy(F.desc("task")).collect():  # one row a task
        carried.append((r["task"], *above[0], above[1][0]))
        above = ([x for x in ((r["first"], r["n"]), (r["second"], r["n_second"])) if x[0] is not None] + above)[:2]
    after = spark.createDataFrame(carried, "task int, up string, n_up long, up2 string")
    all_ = found.where("probe is not null").join(F.broadcast(after), "task", "left")
    none = F.col("first").isNull()
    key, n = F.coalesce("first", "up"), F.when(none, F.col("n_up")).otherwise(F.col("n"))
    second = F.when(none, F.col("up2")).otherwise(F.coalesce("second", "up"))
    only = key.startswith(F.col("probe")) & (n == 1) & ~F.coalesce(second.startswith(F.col("probe")), F.lit(False))
    return all_.where(only).select("probe", key.alias("key"))


def fingerprint(files: DataFrame, digits: int = 4) -> DataFrame:
    """One row: 16 hex digits of SHA-256 over lines of files(path, hash), whatever their order.

    Lines path:hash are sorted and hashed by the first digits of the path's MD5, so no task holds them all; the fingerprint
    is that of the sorted lines digits:digest.
    """
    hashed = lambda lines: F.sha2(F.array_join(F.array_sort(F.collect_list(lines)), "\n"), 256)
    own = files.select(F.left(F.md5("path"), F.lit(digits)).alias("part"), F.concat_ws(":", "path", "hash").alias("line"))
    parts = own.groupBy("part").agg(hashed(F.col("line")).alias("digest"))
    return parts.agg(F.left(hashed(F.concat_ws(":", "part", "digest")), F.lit(16)).alias("fingerprint"))  # 16 ** digits short lines


def drifted(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """path of files(path, hash) whose hash isn't the recorded one, or that is new or gone."""
    return recorded.select("path", F.col("hash").alias("a")).join(current.select("path", F.col("hash").alias("b")), "path", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("path")


def latest_version(lines: DataFrame) -> DataFrame:
    """One row: the last line of lines(line_no, line) that isn't blank without its comment."""
    v = F.trim(F.regexp_replace("line", "#.*", ""))
    return lines.select("line_no", v.alias("v")).where("v <> ''").agg(F.max_by("v", "line_no").alias("version"))
