"""Aligning predicted entries to reference labels within a paper."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.functions.storage import written
from curata.functions.text import authors_match, could_be_alike, could_reach, effect_similarity, last_names, letters, letters_could_reach, overlap, ratio_length, string_ratio, string_ratios, year_match
from curata.operators.components import components

INF = 9.0


def hungarian(cost: np.ndarray) -> list[tuple[int, int]]:
    """Row and column of each pair of a least-cost one-to-one assignment, by shortest augmenting paths in O(n^3)."""
    cost = np.asarray(cost, float)
    if not cost.size:
        return []
    turned = cost.shape[0] > cost.shape[1]
    c = cost.T if turned else cost
    n, m = c.shape
    u, v, owner = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        owner[0], j = i, 0
        least, came, used = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while True:
            used[j] = True
            row = owner[j]
            slack = c[row - 1] - u[row] - v[1:]
            better = ~used[1:] & (slack < least[1:])
            least[1:][better], came[1:][better] = slack[better], j
            k = int(np.where(used[1:], np.inf, least[1:]).argmin()) + 1
            delta = least[k]
            u[owner[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j = k
            if not owner[j]:
                break
        while j:
            owner[j], j = owner[came[j]], came[j]
    pairs = [(owner[k] - 1, k - 1) for k in range(1, m + 1) if owner[k]]
    return sorted((b, a) if turned else (a, b) for a, b in pairs)


def sparse_assignment(rows: np.ndarray, columns: np.ndarray, costs: np.ndarray, alone: float = INF) -> list[int]:
    """Which of the pairs (row, column, cost) make a least-cost one-to-one assignment, where a row without a pair costs ``alone``.

    Shortest augmenting paths over compressed adjacency lists with dual prices: memory grows with the pairs, not with
    rows times columns, and a search touches only what its row is connected to. Of several least assignments one is
    chosen by the order of rows and columns alone.
    """
    _, rows = np.unique(rows, return_inverse=True)
    _, columns = np.unique(columns, return_inverse=True)
    order = np.lexsort((costs, columns, rows))
    first = np.ones(len(order), bool)  # of repeated pairs the cheapest
    first[1:] = (rows[order[1:]] != rows[order[:-1]]) | (columns[order[1:]] != columns[order[:-1]])
    order = order[first]
    n = int(rows.max(initial=-1)) + 1
    begin = np.searchsorted(rows[order], np.arange(n + 1)).tolist()
    to, price, place = columns[order].tolist(), costs[order].tolist(), order.tolist()
    row_price, column_price = [0.0] * n, [0.0] * (int(columns.max(initial=-1)) + 1)
    holder, held = [-1] * len(column_price), [-1] * n  # the row of each column; the pair of each row
    for start in range(n):
        near, came, closed, done, heap = {}, {}, set(), [], []  # distance of each column seen, and the row and pair it was reached by
        row, distance, best, end = start, 0.0, np.inf, None
        while True:
            stay = distance + alone - row_price[row]
            if stay < best:
                best, end = stay, row  # this row stays alone
            for k in range(begin[row], begin[row + 1]):
                column = to[k]
                reached = distance + price[k] - row_price[row] - column_price[column]
                if column not in closed and reached < near.get(column, np.inf):
                    near[column], came[column] = reached, (row, k)
                    heapq.heappush(heap, (reached, column))
            while heap and (heap[0][1] in closed or heap[0][0] > near[heap[0][1]]):
                heapq.heappop(heap)
            if not heap or heap[0][0] >= best:
                column = None
                break
            distance, column = heapq.heappop(heap)
            closed.add(column)
            if holder[column] < 0:
                best = distance
                break
            done.append((column, distance))
            row = holder[column]
        for c, d in done:
            column_price[c] += d - best
            row_price[holder[c]] += best - d
        row_price[start] += best
        if column is None:  # the last row of the path gives its column up and stays alone
            row = end
            if row == start:
                continue
            column, held[row] = to[held[row]], -1
        while True:
            row, pair = came[column]
            before, holder[column], held[row] = held[row], row, pair
            if row == start:
                break
            column = to[before]
    return [place[k] for k in held if k >= 0]


def pairs_in_block(gt: DataFrame, ext: DataFrame, block: str) -> DataFrame:
    """The pairs of a paper's entries that pair_costs may match: of one DOI, or of one year or with a last name in common.

    (A fuzzy match has two of title, authors and year, so authors or year at least.) Each is an equi-join of its own,
    of ids alone; texts follow, with the counts of their letters (g_letters, e_letters).
    """
    def keys(side: DataFrame, p: str) -> DataFrame:
        year = F.trim(F.replace(F.coalesce(F.col(f"{p}_year").cast("string"), F.lit("")), F.lit(".0"), F.lit("")))
        key = lambda kind, c: F.concat(F.lit(kind), c)
        every = F.concat(F.array(key("d", F.nullif(F.col(f"{p}_doi"), F.lit(""))), key("y", F.nullif(year, F.lit("")))), F.transform(last_names(F.col(f"{p}_authors")), lambda n: key("n", n)))
        return side.select("*", F.explode(F.array_compact(every)).alias("_key"))

    ids = keys(gt.select(block, "gt", "g_doi", "g_year", "g_authors"), "g").join(keys(ext.select(block, "ext", "e_doi", "e_year", "e_authors"), "e"), [block, "_key"]).select(block, "gt", "ext").distinct()
    own = lambda side, p, key: side.withColumn(f"{p}_letters", letters(f"{p}_title")).dropDuplicates([block, key])
    return ids.join(own(gt, "g", "gt"), [block, "gt"]).join(own(ext, "e", "ext"), [block, "ext"])


def _titles_could_reach(pairs: DataFrame, least: float) -> Column:
    bound = could_reach("g_title", "e_title", least)
    return bound & letters_could_reach(F.col("g_letters"), F.col("e_letters"), least) if {"g_letters", "e_letters"} <= {*pairs.columns} else bound


def _cost(same: Column, fuzzy: Column, ratio: Column, score: Column) -> Column:
    return F.when(same, 0.05 * (1 - ratio)).when(fuzzy, 0.5 + 0.1 * (3 - score)).otherwise(INF)


def pair_costs(pairs: DataFrame) -> DataFrame:
    """Adds cost and method. pairs: paper, gt, ext, and of both sides (g_ and e_) doi (canonical), description, title, authors, year.

    Equal DOIs cost 0.05 (1 - ratio of descriptions). A label whose DOI settles nothing may match by at least two of
    title ratio 0.75, authors 0.7 and year, at 0.5 and more. Only pairs that need a ratio reach the UDF.
    """
    same = (F.coalesce("g_doi", F.lit("")) != "") & (F.col("g_doi") == F.col("e_doi"))
    out = pairs.withColumn("_same", F.coalesce(same, F.lit(False)))
    out = out.withColumn("_hits", F.count_if("_same").over(Window.partitionBy("paper", "gt")))
    need = F.when(F.col("_same") | ((F.col("_hits") == 0) & _titles_could_reach(pairs, 0.75)), True).otherwise(False)
    a = F.when(F.col("_same"), F.col("g_description")).otherwise(F.col("g_title"))
    b = F.when(F.col("_same"), F.col("e_description")).otherwise(F.col("e_title"))
    out = out.withColumn("_ratio", string_ratio(F.when(need, a).otherwise(""), F.when(need, b).otherwise("")))
    score = (F.col("_ratio") >= 0.75).cast("int") + authors_match(F.col("g_authors"), F.col("e_authors")).cast("int") + year_match(F.col("g_year"), F.col("e_year")).cast("int")
    fuzzy = (F.col("_hits") == 0) & (score >= 2)
    return out.withColumn("cost", _cost(F.col("_same"), fuzzy, F.col("_ratio"), score)).withColumn("method", F.when(F.col("_same"), "doi").when(fuzzy, "fuzzy")).drop("_same", "_hits", "_ratio", "g_letters", "e_letters")


def _papers(batches):
    """(paper, rows) of a stream of batches sorted by paper and part; the part of a paper may span batches."""
    held: list = []

    def whole():
        rows = {c: np.concatenate([x[c] for x in held]) for c in held[0] if c != "key"}
        return held[0]["key"][0], rows

    for pdf in batches:
        if not len(pdf):
            continue
        columns = {c: pdf[c].to_numpy() for c in pdf.columns if c not in ("paper", "part")}
        key = np.fromiter(zip(pdf["paper"], pdf["part"], strict=True), object, len(pdf))
        starts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(pdf)]
        for i, j in zip(starts[:-1], starts[1:], strict=True):
            if held and held[0]["key"][0] != key[i]:
                yield whole()
                held = []
            held.append({c: v[i:j] for c, v in columns.items()} | {"key": key[i:j]})
    if held:
        yield whole()


LARGE = 200_000  # entries of a paper (or ten times as many pairs), beyond which it is taken apart


def _in_parts(rows: DataFrame, large: int) -> DataFrame:
    """Adds part: of a paper with more entries than ``large``, those that no chain of pairs connects get different parts.

    Neither a least-cost nor a greedy assignment of one part depends on another, so the parts are solved on their own.
    """
    entries = F.approx_count_distinct("gt") + F.approx_count_distinct("ext")
    many = rows.groupBy("paper").agg(F.greatest(entries, F.count("*") / 10).alias("_n")).where(F.col("_n") > large).select(F.col("paper").alias("_paper"))
    if many.isEmpty():
        return rows.withColumn("part", F.lit(""))
    own = rows.join(many, F.col("paper").eqNullSafe(F.col("_paper")), "left_semi")
    node = lambda kind, c: F.concat_ws("\x1f", F.lit(kind), F.col(c).cast("string"), "paper")
    parts = components(own.select(node("g", "gt").alias("a"), node("e", "ext").alias("b"))).select(F.col("id").alias("_id"), F.col("component").alias("part"))
    return rows.withColumn("_id", node("g", "gt")).join(parts, "_id", "left").withColumn("part", F.coalesce("part", F.lit(""))).drop("_id")


def _by_paper(rows: DataFrame, one, value: str, large: int) -> DataFrame:
    """one(rows of a paper or part) -> (gt, ext, value) lists: sorted partitions are streamed, so a task holds one
    part and one batch. A null paper is a paper like others."""
    rows = _in_parts(written(rows.select("paper", "gt", "ext", value), "pairs"), large)

    def run(batches):
        yield from _solved(((paper, columns) for (paper, _), columns in _papers(batches)), one, value)

    return rows.select(F.col("paper").cast("string").alias("paper"), "part", "gt", "ext", value).repartition("paper", "part").sortWithinPartitions("paper", "part").mapInPandas(run, f"paper string, gt long, ext long, {value} double")


def _solved(papers, one, value: str):
    """Frames of what one() makes of each (paper, rows)."""
    out: list[tuple] = []
    for paper, columns in papers:
        out += [(paper, int(g), int(e), float(v)) for g, e, v in one(columns)]
        if len(out) > 10_000:
            yield pd.DataFrame(out, columns=["paper", "gt", "ext", value])
            out = []
    yield pd.DataFrame(out, columns=["paper", "gt", "ext", value]) if out else pd.DataFrame({"paper": pd.Series(dtype=object), "gt": pd.Series(dtype="int64"), "ext": pd.Series(dtype="int64"), value: pd.Series(dtype="float64")})


def _assigned(rows: dict) -> list[tuple]:
    return [(rows["gt"][k], rows["ext"][k], round(float(rows["cost"][k]), 4)) for k in sparse_assignment(rows["gt"], rows["ext"], rows["cost"])]


def _greedily(rows: dict) -> list[tuple]:
    used_g, used_e, out = set(), set(), []
    for k in np.lexsort((rows["ext"], rows["gt"], -rows["score"])):
        g, e = rows["gt"][k], rows["ext"][k]
        if g not in used_g and e not in used_e:
            used_g.add(g)
            used_e.add(e)
            out.append((g, e, rows["score"][k]))
    return out


def assign(costs: DataFrame, large: int = LARGE) -> DataFrame:
    """paper, gt, ext, cost: the least-cost one-to-one assignment of each paper; pairs of cost INF and above don't match."""
    return _by_paper(costs.where(F.col("cost") < INF), _assigned, "cost", large)


def greedy(scores: DataFrame, least: float = 0.5, large: int = LARGE) -> DataFrame:
    """paper, gt, ext, score: pairs by falling score, each side once, at or above least."""
    return _by_paper(scores.where(F.col("score") >= least), _greedily, "score", large)


GATHERED = 8_000  # bytes of a side of a paper - its texts, and 100 an entry - up to which its entries make one row


def _gathered(side: DataFrame, p: str, key: str, most: int) -> DataFrame:
    """paper, its entries as an array p, and whether they fit: an array beyond ``most`` stays empty. One shuffle, by paper;
    none for entries that lie by paper already."""
    text = lambda c: F.coalesce(F.col(f"{p}_{c}").cast("string"), F.lit(""))
    size = 100 + sum(F.octet_length(text(c)).cast("long") for c in ("doi", "description", "title", "authors"))
    year = F.trim(F.replace(text("year"), F.lit(".0"), F.lit("")))
    entry = F.struct(F.col(key).cast("long").alias("id"), text("doi").alias("doi"), text("description").alias("description"), text("title").alias("title"), ratio_length(text("title")).alias("length"), last_names(F.col(f"{p}_authors")).alias("names"), year.alias("year"))
    rows = side.withColumn(f"{p}_fits", F.sum(size).over(Window.partitionBy("paper")) <= most)
    return rows.groupBy("paper").agg(F.collect_list(F.when(F.col(f"{p}_fits"), entry)).alias(p), F.bool_and(f"{p}_fits").alias(f"{p}_fits"))


def _pairs_of(g: Column) -> Column:
    """The pairs of a label of a gathered paper that may match, as ``pair_costs`` has them: its DOI's, or else those of its year
    or authors. votes: which of these agree, -1 for a DOI's; a and b: the texts whose ratio decides, if any does."""
    same = F.filter("e", lambda e: (g["doi"] != "") & (g["doi"] == e["doi"]))
    ids = lambda e: (g["id"].alias("gt"), e["id"].alias("ext"))

    def fuzzy(e):
        votes = (overlap(g["names"], e["names"]) >= 0.7).cast("int") + ((g["year"] != "") & (g["year"] == e["year"])).cast("int")
        near = 2 * F.least(g["length"], e["length"]) / F.greatest(g["length"] + e["length"], F.lit(1)) >= 0.75
        return F.struct(*ids(e), votes.alias("votes"), F.when(near, g["title"]).otherwise("").alias("a"), F.when(near, e["title"]).otherwise("").alias("b"))

    by_doi = F.transform(same, lambda e: F.struct(*ids(e), F.lit(-1).alias("votes"), g["description"].alias("a"), e["description"].alias("b")))
    return F.when(F.size(same) > 0, by_doi).otherwise(F.filter(F.transform("e", fuzzy), lambda x: (x["votes"] == 2) | ((x["votes"] == 1) & (x["a"] != ""))))


def _by_gathered_paper(gt: DataFrame, ext: DataFrame, one, value: str, of_cost, keep, rest, most: int) -> DataFrame:
    """one() of the costs of every paper's pairs, where the entries of a paper travel once and its pairs never: a paper is a
    row from its entries to its assignment. Papers that don't fit a row are listed by the same pass, and go by rest(gt, ext)."""
    papers = _gathered(gt, "g", "gt", most).join(_gathered(ext, "e", "ext", most), "paper")
    papers = papers.select(F.col("paper").cast("string").alias("paper"), (F.col("g_fits") & F.col("e_fits")).alias("fits"), F.flatten(F.transform("g", _pairs_of)).alias("pairs"))
    of_pairs = lambda c: F.transform("pairs", lambda x: x[c])
    papers = papers.withColumn("ratios", string_ratios(of_pairs("a"), of_pairs("b")))

    def priced(x, ratio):
        score = x["votes"] + (ratio >= 0.75).cast("int")
        return F.struct(x["gt"].alias("gt"), x["ext"].alias("ext"), of_cost(_cost(x["votes"] < 0, score >= 2, ratio, score)).alias(value))

    papers = papers.select("paper", "fits", F.filter(F.zip_with("pairs", "ratios", priced), lambda x: keep(x[value])).alias("pairs"))
    papers = papers.select("paper", "fits", *(of_pairs(c).alias(c) for c in ("gt", "ext", value)))

    def run(batches):
        for pdf in batches:
            large = pdf.loc[~pdf["fits"].astype(bool), "paper"].tolist()
            if large:
                yield pd.DataFrame({"paper": large, "gt": pd.array([None] * len(large), "Int64"), "ext": pd.array([None] * len(large), "Int64"), value: pd.array([None] * len(large), "Float64")})
            rows = zip(pdf["paper"], pdf["gt"], pdf["ext"], pdf[value], strict=True)
            yield from _solved(((paper, {"gt": g, "ext": e, value: v}) for paper, g, e, v in rows if len(g)), one, value)

    out = written(papers.mapInPandas(run, f"paper string, gt long, ext long, {value} double"), "assigned")
    found, large = out.where("gt is not null"), out.where("gt is null").select(F.col("paper").alias("_paper"))
    if large.isEmpty():
        return found
    own = lambda side: side.join(large, F.col("paper").cast("string") == F.col("_paper"), "left_semi")
    return found.unionByName(rest(own(gt), own(ext)))


def assign_entries(gt: DataFrame, ext: DataFrame, large: int = LARGE, most: int = GATHERED) -> DataFrame:
    """``assign`` of the ``pair_costs`` of entries: paper, gt, ext, cost."""
    whole = lambda g, e: assign(pair_costs(pairs_in_block(g, e, "paper")), large)
    return _by_gathered_paper(gt, ext, _assigned, "cost", lambda c: c, lambda c: c < INF, whole, most)


def greedy_entries(gt: DataFrame, ext: DataFrame, least: float = 0.5, large: int = LARGE, most: int = GATHERED) -> DataFrame:
    """``greedy`` over entries, by how far their ``pair_costs`` stay below INF: paper, gt, ext, score."""
    score = lambda c: 1 - c / INF
    whole = lambda g, e: greedy(pair_costs(pairs_in_block(g, e, "paper")).withColumn("score", score(F.col("cost"))), least, large)
    return _by_gathered_paper(gt, ext, _greedily, "score", score, lambda s: s >= least, whole, most)


def canonical(rows: DataFrame, doi: str, aliases: DataFrame, to: str) -> DataFrame:
    """Adds ``to``: the canonical DOI by aliases(seq, alias, canonical, kind), one hop at most."""
    hop = aliases.groupBy(F.col("alias").alias("_a")).agg(F.max_by("canonical", "seq").alias("_c"))
    return rows.join(hop, F.col(doi) == F.col("_a"), "left").withColumn(to, F.coalesce("_c", doi)).drop("_a", "_c")


def alias_kind(pairs: DataFrame, a: str, b: str, aliases: DataFrame) -> DataFrame:
    """Adds kind: that of the first alias which is a or b, else 'alias'."""
    own = aliases.groupBy(F.col("alias").alias("_a")).agg(F.min(F.struct("seq", "kind")).alias("_k"))
    out = pairs.join(own.withColumnRenamed("_k", "_k1"), F.col(a) == F.col("_a"), "left").drop("_a")
    out = out.join(own.withColumnRenamed("_k", "_k2"), F.col(b) == F.col("_a"), "left").drop("_a")
    first = F.least("_k1", "_k2")  # null only where both are
    return out.withColumn("kind", F.coalesce(F.nullif(first["kind"], F.lit("")), F.lit("alias"))).drop("_k1", "_k2")


# What a recorded verdict costs by its confidence, and relations that are a match.
VERDICT_COST = {"high": 0.10, "medium": 0.40, "low": 0.70}
SAME_RELATIONS = ["same_effect", "subanalysis_of_gt"]


def staged(gt: DataFrame, ext: DataFrame, aliases: DataFrame, verdicts: DataFrame | None = None, large: int = LARGE) -> DataFrame:
    """paper, outcome, gt, ext, method, relation, confidence, cost, reason: what becomes of every entry.

    gt and ext: paper, gt or ext, and (g_ or e_) doi, description, title, authors, year. verdicts: paper, gt, ext,
    relation, confidence, reason, failed - recorded replies of a judge on a label.

    1. Entries of one canonical DOI may match at 0.05 (1 - ratio of descriptions).
    2. A label without such an entry, or with several of them and labels that share its DOI, goes by its verdict: a
       match among the entries left costs 0 among those of its DOI, else by confidence; other relations are listed.
       Without a verdict, or where it failed, a label without an entry of its DOI may match by title, authors, year.
    3. The least-cost one-to-one assignment. outcome is match, gt_unmatched, ext_unmatched, granularity_miss or
       wrong_original.
    """
    gt, ext = canonical(gt, "g_doi", aliases, "g_canon"), canonical(ext, "e_doi", aliases, "e_canon")
    known = lambda c: F.col(c) != ""
    pairs = gt.where(known("g_canon")).join(ext.where(known("e_canon")), (gt["paper"] == ext["paper"]) & (F.col("g_canon") == F.col("e_canon"))).drop(ext["paper"])
    pairs = alias_kind(pairs, "g_doi", "e_doi", aliases)
    why = F.when(F.col("g_doi") == F.col("e_doi"), "original DOI equal").otherwise(F.concat(F.lit("same work under two DOIs ("), "kind", F.lit("): "), "g_doi", F.lit(" = "), "e_doi"))
    by_doi = pairs.select("paper", "gt", "ext", (0.05 * (1 - string_ratio("g_description", "e_description"))).alias("cost"), F.lit(1).alias("rank"), F.lit("doi").alias("method"), F.lit("same_effect").alias("relation"), F.lit("high").alias("confidence"), why.alias("reason"))
    by_doi = written(by_doi, "doi-pairs")
    hits = by_doi.groupBy("paper", "gt").agg(F.count("*").alias("hits"))
    sharing = gt.where(known("g_canon")).groupBy("paper", "g_canon").agg(F.count("*").alias("sharing"))
    labels = gt.select("paper", "gt", "g_canon").join(hits, ["paper", "gt"], "left").join(sharing, ["paper", "g_canon"], "left")
    several = (F.coalesce("hits", F.lit(0)) > 1) & F.coalesce(F.col("sharing") > 1, F.lit(False))
    labels = labels.select("paper", "gt", F.coalesce("hits", F.lit(0)).alias("hits"), several.alias("ambiguous"))
    found, listed = by_doi, None
    fuzzy = labels.where("hits = 0").select("paper", "gt")
    if verdicts is not None:
        asked = labels.where("hits = 0 or ambiguous").join(verdicts, ["paper", "gt"])
        there = asked.join(by_doi.select("paper", "gt", "ext", F.lit(True).alias("_doi")), ["paper", "gt", "ext"], "left")
        entry = ext.select("paper", "ext", F.lit(True).alias("_ext"))
        there = written(there.join(entry, ["paper", "ext"], "left").where("_ext and (not ambiguous or _doi)"), "verdicts")
        price = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in VERDICT_COST.items() for x in kv]), F.col("confidence")), F.lit(VERDICT_COST["low"]))
        accepted = there.where(F.col("relation").isin(SAME_RELATIONS))
        found = found.unionByName(accepted.select("paper", "gt", "ext", F.when(F.col("ambiguous"), 0.0).otherwise(price).alias("cost"), F.lit(0).alias("rank"), F.when(F.col("ambiguous"), "doi+judge").otherwise("llm").alias("method"), "relation", "confidence", F.coalesce("reason", F.lit("")).alias("reason")))
        kind = F.when(F.col("relation") == "same_original_other_effect", "granularity_miss").when(F.col("relation") == "different_original", "wrong_original")
        listed = there.withColumn("outcome", kind).where("outcome is not null").select("paper", "outcome", "gt", "ext", F.lit(None).cast("string").alias("method"), "relation", "confidence", F.lit(None).cast("double").alias("cost"), F.coalesce("reason", F.lit("")).alias("reason"))
        fuzzy = fuzzy.join(verdicts.where(~F.coalesce("failed", F.lit(False))).select("paper", "gt"), ["paper", "gt"], "left_anti")
    like = pairs_in_block(gt.join(fuzzy, ["paper", "gt"], "left_semi").drop("g_canon"), ext.drop("e_canon"), "paper")
    title = (F.when(_titles_could_reach(like, 0.75), F.col(c)).otherwise("") for c in ("g_title", "e_title"))
    score = (string_ratio(*title) >= 0.75).cast("int") + authors_match(F.col("g_authors"), F.col("e_authors")).cast("int") + year_match(F.col("g_year"), F.col("e_year")).cast("int")
    like = like.withColumn("score", score).where("score >= 2")
    like = like.select("paper", "gt", "ext", (0.5 + 0.1 * (3 - F.col("score"))).alias("cost"), F.lit(2).alias("rank"), F.lit("fuzzy").alias("method"), F.lit("same_effect").alias("relation"), F.when(F.col("score") == 3, "medium").otherwise("low").alias("confidence"), F.concat(F.lit("fuzzy "), F.col("score").cast("string"), F.lit("/3 (title/authors/year)")).alias("reason"))
    meta = ["method", "relation", "confidence", "reason"]
    best = found.unionByName(like).groupBy("paper", "gt", "ext").agg(F.min(F.struct("cost", "rank", *meta)).alias("x")).select("paper", "gt", "ext", "x.*")
    best = written(best.select("paper", "gt", "ext", "cost", *meta), "costs")
    matches = written(assign(best, large).select("paper", "gt", "ext"), "matches")
    out = best.join(matches, ["paper", "gt", "ext"]).select("paper", F.lit("match").alias("outcome"), "gt", "ext", "method", "relation", "confidence", F.round("cost", 4).alias("cost"), "reason")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("method", "string"), ("relation", "string"), ("confidence", "string"), ("cost", "double"), ("reason", "string"))]
    missing = lambda side, key, other: side.select("paper", key).join(matches, ["paper", key], "left_anti").select("paper", F.lit(f"{key}_unmatched").alias("outcome"), *(F.col(key) if c == key else F.lit(None).cast("long").alias(c) for c in ("gt", "ext")), *none)
    out = out.unionByName(missing(gt, "gt", "ext")).unionByName(missing(ext, "ext", "gt"))
    return out if listed is None else out.unionByName(listed)


def described_alike(a: DataFrame, b: DataFrame, threshold: float = 0.65, margin: float = 0.08) -> DataFrame:
    """paper, a, b, score: entries of two coders - (paper, a or b, description) - that are each other's best by description, by a margin.

    Pairs further below the threshold than the margin decide nothing, so only those that native bounds leave are compared.
    """
    least = threshold - margin
    x, y = a.select("paper", "a", F.col("description").alias("_x")), b.select("paper", "b", F.col("description").alias("_y"))
    pairs = x.join(y, (x["paper"] == y["paper"]) & could_be_alike(F.col("_x"), F.col("_y"), least)).select(x["paper"], "a", "b", effect_similarity(F.col("_x"), F.col("_y")).alias("score"))
    return mutual_best(pairs.where(F.coalesce("paper", F.lit("")).cast("string") != ""), threshold, margin)


def aligned(anchors: DataFrame, entries: DataFrame, least: float = 0.5, large: int = LARGE) -> DataFrame:
    """paper, gt, ext, score, note: sheet rows (paper, gt, hint) and coded entries (paper, ext, title) by falling ratio, each once.

    The only entry of a paper goes to its first row if nothing was near enough; rows and entries left over are listed
    with a note, an entry as a row to be added.
    """
    hint = anchors.where(F.trim(F.coalesce("hint", F.lit(""))) != "")
    pairs = hint.join(entries, (hint["paper"] == entries["paper"]) & could_reach("hint", "title", least)).select(hint["paper"], "gt", "ext", string_ratio("hint", "title").alias("score"))
    taken = written(greedy(pairs, least, large), "aligned")
    only = entries.groupBy("paper").agg(F.count("*").alias("_n"), F.min("ext").alias("ext")).where("_n = 1").join(taken.select("paper"), "paper", "left_anti")
    first = anchors.groupBy("paper").agg(F.min("gt").alias("gt"))
    alone = only.join(first, "paper").select("paper", "gt", "ext", F.lit(None).cast("double").alias("score"))
    pairs = written(taken.select("paper", "gt", "ext", "score").unionByName(alone), "aligned")
    blank = lambda c, t: F.lit(None).cast(t).alias(c)
    rows = anchors.select("paper", "gt").join(pairs, ["paper", "gt"], "left_anti").select("paper", "gt", blank("ext", "long"), blank("score", "double"), F.lit("no entry matched this anchor").alias("note"))
    extra = entries.select("paper", "ext").join(pairs, ["paper", "ext"], "left_anti").select("paper", blank("gt", "long"), "ext", blank("score", "double"), F.lit("extra entry, not in the external record").alias("note"))
    return pairs.withColumn("note", F.lit("")).unionByName(rows).unionByName(extra)


def mutual_best(scores: DataFrame, threshold: float = 0.65, margin: float = 0.08) -> DataFrame:
    """paper, a, b, score: pairs that are each other's best, by a margin over the runner-up on both sides."""
    def ranked(side, other):
        w = Window.partitionBy("paper", side).orderBy(F.desc("score"), F.desc(other))
        return F.row_number().over(w), F.lead("score").over(w)

    (ra, na), (rb, nb) = ranked("a", "b"), ranked("b", "a")
    rows = scores.withColumns({"ra": ra, "na": na, "rb": rb, "nb": nb})
    clear = lambda nxt: F.col(nxt).isNull() | (F.col("score") - F.col(nxt) >= margin)
    return rows.where((F.col("ra") == 1) & (F.col("rb") == 1) & (F.col("score") >= threshold) & clear("na") & clear("nb")).select("paper", "a", "b", "score")


def sensitivity(scores: DataFrame, thresholds: list[float]) -> DataFrame:
    """threshold, n: pairs at or above each threshold."""
    wide = scores.agg(*[F.count_if(F.col("score") >= t).alias(f"n{i}") for i, t in enumerate(thresholds)])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"n{i}").alias("n")) for i, t in enumerate(thresholds)])).alias("x")).select("x.*")


def judged(pairs: DataFrame, verdicts: DataFrame, key: Column) -> DataFrame:
    """Recorded verdicts(key, relation, confidence) by content hash; what isn't recorded stays NULL."""
    return pairs.withColumn("_k", key).join(verdicts.select(F.col("key").alias("_k"), "relation", "confidence"), "_k", "left").drop("_k")


def adjudication(pairs: DataFrame, fields: list[str], key: str, audit_share: float = 0.2, seed: str = "audit") -> DataFrame:
    """key, field, reason, a_value, b_value: every field two coders differ in, and a seeded share of agreements. pairs: a_* and b_* columns."""
    from curata.functions.ids import unit_hash

    low = lambda c: F.lower(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))))
    differ = F.array_compact(F.array(*[F.when(low(f"a_{f}") != low(f"b_{f}"), F.lit(f)) for f in fields]))
    rows = pairs.withColumn("_d", differ)
    audit = unit_hash(F.lit(seed), F.col(key).cast("string")) < audit_share
    rows = rows.withColumn("reason", F.when(F.size("_d") > 0, "disagreement").when(audit, "audit_sample")).where("reason is not null")
    rows = rows.withColumn("field", F.explode(F.when(F.size("_d") > 0, F.col("_d")).otherwise(F.array(F.lit(fields[0])))))
    pick = lambda side: F.coalesce(*[F.when(F.col("field") == f, F.col(f"{side}_{f}").cast("string")) for f in fields])
    return rows.select(key, "field", "reason", pick("a").alias("a_value"), pick("b").alias("b_value"))


def one_sided(a: DataFrame, b: DataFrame, pairs: DataFrame) -> DataFrame:
    """key, field, reason, a_value, b_value: entries of either coder - (a or b) - that no pair(a, b) has."""
    def left(side: DataFrame, key: str) -> DataFrame:
        values = [F.lit("present" if key == c else "").alias(f"{c}_value") for c in ("a", "b")]
        return side.select(key).join(pairs.select(key), key, "left_anti").select(F.col(key).alias("key"), F.lit("row_exists").alias("field"), F.lit(f"unmatched coder {key} entry; identity unresolved").alias("reason"), *values)

    return left(a, "a").unionByName(left(b, "b"))


def negative_disagreements(a: DataFrame, b: DataFrame) -> DataFrame:
    """key, field, reason, a_value, b_value: negative papers (keys ending in #neg; value) on which two coders differ, where both said something."""
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    both = a.select("key", F.col("value").alias("a_value")).join(b.select("key", F.col("value").alias("b_value")), "key").where(F.col("key").endswith("#neg"))
    both = both.where((low(F.col("a_value")) != "") & (low(F.col("b_value")) != "") & (low(F.col("a_value")) != low(F.col("b_value"))))
    return both.select("key", F.lit("is_replication_paper").alias("field"), F.lit("disagreement").alias("reason"), "a_value", "b_value")
