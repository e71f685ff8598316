"""Agreement and accuracy: confusion, precision, recall, F1, Cohen's kappa, set scores, bootstrap."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.text import to_float
from curata.functions.validate import TYPE_COLLAPSE, TYPES


def class_metrics(pairs: DataFrame, classes: list[str], truth: str = "gt", found: str = "ext") -> DataFrame:
    """class, support, predicted, tp, precision, recall, f1 (0 if the class is there but neither is; NULL if it isn't)."""
    aggs = []
    for i, c in enumerate(classes):
        a, b = F.col(truth) == c, F.col(found) == c
        aggs += [F.count_if(a).alias(f"s{i}"), F.count_if(b).alias(f"p{i}"), F.count_if(a & b).alias(f"t{i}")]
    wide = pairs.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("class"), F.col(f"s{i}").alias("support"), F.col(f"p{i}").alias("predicted"), F.col(f"t{i}").alias("tp")) for i, c in enumerate(classes)])
    out = wide.select(F.explode(rows).alias("r")).select("r.*")
    d = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    out = out.withColumns({"precision": d("tp", "predicted"), "recall": d("tp", "support")})
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", F.when((p > 0) & (r > 0), 2 * p * r / (p + r)).when((F.col("support") > 0) | (F.col("predicted") > 0), F.lit(0.0)))


def overall(pairs: DataFrame, classes: list[str], truth: str = "gt", found: str = "ext") -> DataFrame:
    """One row: n, accuracy, macro_f1 over the classes with support."""
    per = class_metrics(pairs, classes, truth, found).where("support > 0").agg(F.avg(F.coalesce("f1", F.lit(0.0))).alias("macro_f1"))
    base = pairs.agg(F.count("*").alias("n"), F.avg((F.col(truth) == F.col(found)).cast("double")).alias("accuracy"))
    return base.join(F.broadcast(per))  # two tables of one row


def confusion(pairs: DataFrame, truth: str = "gt", found: str = "ext") -> DataFrame:
    return pairs.groupBy(truth, found).agg(F.count("*").alias("n"))


def kappa(pairs: DataFrame, *by: str, a: str = "a", b: str = "b") -> DataFrame:
    """by, n, agreement, kappa: NaN without pairs, 1 if chance agreement is complete."""
    n = pairs.groupBy(*by).agg(F.count("*").alias("n"), F.sum((F.col(a) == F.col(b)).cast("long")).alias("same"))
    one = lambda c, name: pairs.groupBy(*by, F.col(c).alias("c")).agg(F.count("*").alias(name))
    both = one(a, "na").join(one(b, "nb"), [*by, "c"]).groupBy(*by).agg(F.sum(F.col("na") * F.col("nb")).alias("chance"))
    out = n.join(both, list(by), "left") if by else n.join(F.broadcast(both), F.lit(True), "left")
    po, pe = F.col("same") / F.col("n"), F.coalesce(F.col("chance"), F.lit(0)) / (F.col("n") * F.col("n"))
    return out.select(*by, "n", po.alias("agreement"), F.when(F.col("n") == 0, float("nan")).when(pe < 1, (po - pe) / (1 - pe)).otherwise(1.0).alias("kappa"))


def decision(k: Column) -> Column:
    return F.when(k >= 0.7, "proceed").when(k >= 0.5, "refine").otherwise("stop")


def paper_verdict(rows: DataFrame, paper: str | list[str], label: str) -> DataFrame:
    """One label a paper (or other key): the only one; inconclusive if both poles or a reversal are there, or it outnumbers the pole; '' for none."""
    keys = [paper] if isinstance(paper, str) else paper
    x = F.when(F.col(label) != "", F.col(label))
    g = rows.groupBy(*keys).agg(F.count(x).alias("n"), F.count_distinct(x).alias("k"), F.min(x).alias("least"), F.count_if(x == "success").alias("s"), F.count_if(x == "failure").alias("f"), F.count_if(x == "reversal").alias("r"), F.count_if(x == "inconclusive").alias("i"))
    polar = F.when(F.col("s") > 0, "success").otherwise("failure")
    v = F.when(F.col("n") == 0, "").when(F.col("k") == 1, F.col("least")).when(((F.col("s") > 0) & (F.col("f") > 0)) | (F.col("r") > 0), "inconclusive").when(F.col("n") - F.col("i") >= F.col("i"), polar).otherwise("inconclusive")
    return g.select(*keys, v.alias("verdict"))


def breakdown(rows: DataFrame, dims: list[str], ok: str, paper: str) -> DataFrame:
    """dim, value, n, n_papers, accuracy over grouping sets of one dimension each."""
    g = rows.groupingSets([[d] for d in dims], *dims).agg(F.count("*").alias("n"), F.count_distinct(paper).alias("n_papers"), F.avg(F.col(ok).cast("double")).alias("accuracy"), *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    name = F.coalesce(*[F.when(F.col(f"_g_{d}") == 0, d) for d in dims])
    value = F.coalesce(*[F.when(F.col(f"_g_{d}") == 0, F.col(d).cast("string")) for d in dims])
    return g.select(name.alias("dim"), value.alias("value"), "n", "n_papers", "accuracy")


def prf(tp: Column, fp: Column, fn: Column) -> Column:
    """struct(precision, recall, f1), NULL where a denominator is 0."""
    p, r = F.try_divide(tp.cast("double"), (tp + fp).cast("double")), F.try_divide(tp.cast("double"), (tp + fn).cast("double"))
    return F.struct(p.alias("precision"), r.alias("recall"), F.try_divide(2 * p * r, p + r).alias("f1"))


def stat_tiers(kind: str, gt: Column, ext: Column, gt_type: Column | None = None, ext_type: Column | None = None) -> Column:
    """struct(gt_has, ext_has, tier1, tier2, tier3): tolerance tiers where both are there; kind is es, n or p."""
    g, e = to_float(gt), to_float(ext)
    d, both = F.abs(g - e), g.isNotNull() & e.isNotNull()
    gt_type, ext_type = (F.lower(F.trim(F.coalesce(t, F.lit("")))) if t is not None else F.lit("") for t in (gt_type, ext_type))
    differ = (gt_type != "") & (ext_type != "") & (gt_type != ext_type)
    tiers = {"es": (d <= 0.01, d <= 0.05, d <= 0.10), "n": (d < 0.5, d <= 0.05 * F.abs(g), d <= 0.20 * F.abs(g)), "p": ((d <= 1e-4) & ~differ, d <= 1e-4, (g < 0.05) == (e < 0.05))}[kind]
    scored = both & ~differ if kind == "es" else both
    return F.struct(g.isNotNull().alias("gt_has"), e.isNotNull().alias("ext_has"), *[F.when(scored, t).alias(f"tier{i}") for i, t in enumerate(tiers, 1)])


def type_score(gt: Column, ext: Column) -> Column:
    """struct(ok, adjacent_ok, two_class): exact, one step away, and for collapsed labels by two classes."""
    collapse = F.create_map(*[F.lit(x) for kv in TYPE_COLLAPSE.items() for x in kv])
    e = F.coalesce(F.element_at(collapse, ext), ext)
    rank = F.create_map(*[F.lit(x) for i, t in enumerate(TYPES) for x in (t, i)])
    two = gt == "direct_or_close"
    ok = F.when(gt == "", None).when(two, e.isin(TYPES[:3])).otherwise(gt == e)
    near = F.when((gt == "") | two, None).otherwise((gt == e) | F.coalesce(F.abs(F.element_at(rank, gt) - F.element_at(rank, e)) == 1, F.lit(False)))
    return F.struct(ok.alias("ok"), near.alias("adjacent_ok"), two.alias("two_class"))


def set_scores(gt: DataFrame, ext: DataFrame, paper: str, item: str) -> DataFrame:
    """paper, n_gt, n_ext, tp, recall, precision_lb, hit, exact of each paper with truth. Items are joined, so no set is gathered."""
    g = gt.select(paper, item).distinct().withColumn("_g", F.lit(1))
    e = ext.select(paper, item).distinct().withColumn("_e", F.lit(1))
    n = lambda *c: F.count(c[0] if len(c) == 1 else F.when(F.col(c[0]).isNotNull(), F.col(c[1])))
    counts = g.join(e, [paper, item], "full").groupBy(paper).agg(n("_g").cast("int").alias("n_gt"), n("_e").cast("int").alias("n_ext"), n("_g", "_e").cast("int").alias("tp")).where("n_gt > 0")
    tp, n_gt, n_ext = F.col("tp"), F.col("n_gt"), F.col("n_ext")
    return counts.select(paper, n_gt, n_ext, tp, (tp / n_gt).alias("recall"), F.try_divide(tp.cast("double"), n_ext.cast("double")).alias("precision_lb"), (tp > 0).alias("hit"), ((tp == n_gt) & (tp == n_ext)).alias("exact"))


def lenient(gt: DataFrame, ext: DataFrame, paper: str, item: str) -> DataFrame:
    """paper, hit_lenient: papers with an identifier in common up to three characters cut off an end that leaves twelve.

    Each identifier stands under itself and its cuts, so near ones meet by equality, not as pairs.
    """
    def cut(side: DataFrame) -> DataFrame:
        n = F.length(item)
        cuts = F.filter(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.struct(k.alias("cut"), F.left(F.col(item), n - k).alias("key"), (n - k).alias("left"))), lambda x: (x["cut"] == 0) | (x["left"] >= 12))
        return side.select(paper, item).distinct().select(paper, F.explode(cuts).alias("x")).select(paper, "x.*")

    g, e = cut(gt), cut(ext).withColumnRenamed("cut", "cut_e").drop("left")
    return g.join(e, [paper, "key"]).where("cut = 0 or cut_e = 0").select(paper).distinct().withColumn("hit_lenient", F.lit(True))


def set_summary(scores: DataFrame) -> DataFrame:
    return scores.agg(F.count("*").alias("n_papers"), F.try_divide(F.sum("tp").cast("double"), F.sum("n_gt").cast("double")).alias("micro_recall"), F.try_divide(F.sum("tp").cast("double"), F.sum("n_ext").cast("double")).alias("micro_precision_lb"), F.avg("recall").alias("macro_recall"), F.avg(F.col("hit").cast("double")).alias("hit_rate"), F.avg(F.col("exact").cast("double")).alias("exact_rate"))


def bootstrap(rows: DataFrame, cluster: str, value: str, replicates: int = 2000, seed: int = 0, ends: tuple[str, str] = ("floor", "floor_less_one")) -> DataFrame:
    """One row: mean, lo, hi of a mean over rows, resampling clusters with replacement.

    Clusters enter as sums and counts; each replicate weighs a cluster by a Poisson(1) number from a hash of (seed,
    replicate, cluster), so no replicate rescans rows and any number of clusters is spread over tasks. ends: the index
    convention of the 2.5 and 97.5 per cent points, of n sorted values: 'floor' .025 n and .975 n - 1, or 'inner' over n - 1.
    """
    per = rows.groupBy(cluster).agg(F.sum(F.col(value).cast("double")).alias("s"), F.count(value).alias("n"))
    u = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("r").cast("string"), F.col(cluster).cast("string")), 256), 1, 12), 16, 10).cast("double") / float(1 << 48)
    steps, p, total = [], 2.718281828459045**-1, 0.0
    for k in range(1, 9):
        total += p
        steps.append(F.when(u >= total, 1).otherwise(0))
        p /= k
    weight = sum(steps[1:], steps[0])
    draws = per.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1)))).withColumn("w", weight).groupBy("r").agg((F.sum(F.col("w") * F.col("s"))).alias("s"), F.sum(F.col("w") * F.col("n")).alias("n")).where("n > 0")
    xs = draws.agg(F.sort_array(F.collect_list(F.col("s") / F.col("n"))).alias("x"))  # one number a replicate
    n = F.size("x")
    lo, hi = ((0.025 * n).cast("int"), (0.975 * n).cast("int") - 1) if ends[0] == "floor" else ((0.025 * (n - 1)).cast("int"), (0.975 * (n - 1)).cast("int"))
    mean = per.agg((F.sum("s") / F.sum("n")).alias("mean"))
    return mean.join(F.broadcast(xs.where(n >= 100).select(F.get("x", lo).alias("lo"), F.get("x", hi).alias("hi"), n.alias("n_boot"))), F.lit(True), "left")


def replicated(rows: DataFrame, cluster: str, counts: dict[str, Column], metrics: dict[str, Column], replicates: int = 2000, seed: int = 0, ends: str = "floor", derived: dict[str, Column] | None = None) -> DataFrame:
    """metric, lo, hi, n_boot: 95 per cent intervals of metrics that aren't means, resampling clusters with replacement.

    counts: aggregates of a cluster's rows, which add up over clusters; metrics: expressions of the summed counts (and of
    columns ``derived`` from them). So each
    cluster is one vector, a replicate weighs it by a Poisson(1) number from a hash of (seed, replicate, cluster), a task adds
    up weights times vectors by matrix products, and what leaves it is one vector a replicate. A metric that is null or NaN in
    a replicate isn't counted there; one with fewer than 100 replicates has no interval, nor has any with fewer than two clusters.
    ends: 'floor' takes the sorted values at .025 n and .975 n - 1, 'inner' those at .025 and .975 of n - 1.
    """
    names = list(counts)
    per = rows.groupBy(cluster).agg(*(F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in counts.items()))
    per = per.select(F.xxhash64(F.lit(seed), F.col(cluster).cast("string")).alias("h"), F.array(*names).alias("v"))

    def run(batches):
        total, n = np.zeros((replicates, len(names))), 0
        for batch in batches:
            h, v = batch.column(0).to_numpy().view(np.uint64), batch.column(1).flatten().to_numpy().reshape(len(batch), -1)
            for i in range(0, len(h), 512):
                total += poisson_weights(h[i : i + 512], replicates) @ v[i : i + 512]
            n += len(h)
        yield pa.RecordBatch.from_arrays([pa.array(range(replicates), pa.int32()), pa.array(list(total), pa.list_(pa.float64())), pa.array([n] * replicates, pa.int64())], ["r", "v", "n"])

    sums = per.mapInArrow(run, "r int, v array<double>, n long").groupBy("r").agg(F.sum("n").alias("_n"), *(F.sum(F.col("v")[i]).alias(c) for i, c in enumerate(names)))
    draws = sums.where("_n > 1").withColumns(derived or {}).select(*(F.when(~F.isnan(m.cast("double")), m.cast("double")).alias(f"m{i}") for i, m in enumerate(metrics.values())))
    sorted_ = draws.agg(*(F.sort_array(F.collect_list(c)).alias(c) for c in draws.columns))  # one number a replicate
    one = sorted_.select(F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(f"m{i}").alias("x")) for i, c in enumerate(metrics)))).alias("m")).select("m.*")
    n = F.size("x")
    lo, hi = ((0.025 * n).cast("int"), (0.975 * n).cast("int") - 1) if ends == "floor" else ((0.025 * (n - 1)).cast("int"), (0.975 * (n - 1)).cast("int"))
    return one.where(n >= 100).select("metric", F.get("x", lo).alias("lo"), F.get("x", hi).alias("hi"), n.alias("n_boot"))


def poisson_weights(hashes: np.ndarray, replicates: int) -> np.ndarray:
    """[replicates, clusters] numbers of a Poisson distribution of mean 1, each from a mixed hash of replicate and cluster."""
    x = hashes[None, :] ^ (np.arange(1, replicates + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    u = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)
    bounds, p, total = [], math.exp(-1), 0.0
    for k in range(1, 12):
        total += p
        bounds.append(total)
        p /= k
    return np.searchsorted(bounds, u, side="right").astype(np.float64)


def set_intervals(scores: DataFrame, paper: str, replicates: int = 2000, seed: int = 0) -> DataFrame:
    """metric, lo, hi, n_boot of the five rates of ``set_summary``, by the inner index convention."""
    total = {c: F.sum(F.col(c).cast("double")) for c in ("tp", "n_gt", "n_ext", "recall", "hit", "exact")} | {"papers": F.count("*")}
    rate = lambda a, b: F.try_divide(F.col(a), F.nullif(F.col(b), F.lit(0.0)))
    rates = {"micro_recall": rate("tp", "n_gt"), "micro_precision_lb": rate("tp", "n_ext"), "macro_recall": rate("recall", "papers"), "hit_rate": rate("hit", "papers"), "exact_rate": rate("exact", "papers")}
    return replicated(scores, paper, total, rates, replicates, seed, "inner")


def set_extras(scores: DataFrame, near: DataFrame, paper: str, without_doi: DataFrame | None = None) -> DataFrame:
    """One row: hit_rate_lenient, hit_rate_when_extracted, extracted_none, ext_rows_without_doi. near: of ``lenient``; without_doi: paper, n."""
    rows = scores.join(near, paper, "left")
    rows = rows.join(without_doi.select(paper, F.col("n").alias("_n")), paper, "left") if without_doi is not None else rows.withColumn("_n", F.lit(0))
    hit = F.col("hit").cast("double")
    return rows.agg(
        F.avg((F.col("hit") | F.coalesce("hit_lenient", F.lit(False))).cast("double")).alias("hit_rate_lenient"), F.avg(F.when(F.col("n_ext") > 0, hit)).alias("hit_rate_when_extracted"),
        F.count_if(F.col("n_ext") == 0).alias("extracted_none"), F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("ext_rows_without_doi"),
    )
