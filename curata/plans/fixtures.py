"""Relations derived from the driver's tables, in Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.plans.catalogue import table


def doi_key(i):
    k = F.floor(i / 3).cast("long")
    return F.when(i % 4 == 1, "").otherwise(F.concat(F.lit("10."), (1000 + k % 97).cast("string"), F.lit("/D"), k.cast("string")))


def dirty(i, d):
    """The same DOI as people write it; kind 5 has a space inside and is none."""
    return F.when(d == "", "").when(i % 6 == 0, d).when(i % 6 == 1, F.concat(F.lit("https://doi.org/"), d)).when(i % 6 == 2, F.concat(F.lit("http://dx.doi.org/"), d)).when(i % 6 == 3, F.concat(d, F.lit("."))).when(i % 6 == 4, F.concat(d, F.lit(")"))).otherwise(F.concat(d, F.lit(" x")))


def candidates(spark, sf_dir) -> DataFrame:
    """seq, pmid, doi, title, abstract, authors, journal, year, source_api, source_query."""
    i = F.col("doc_id")
    six = F.floor(i / 6).cast("long")
    pmid = F.when((i % 6).isin(2, 3) & (six % 2 == 0), six.cast("string")).otherwise("")
    return table(spark, sf_dir, "documents").select(
        i.alias("seq"), pmid.alias("pmid"), dirty(i, doi_key(i)).alias("doi"), F.substring("text", 1, 80).alias("title"), F.col("text").alias("abstract"),
        F.when(i % 7 == 0, "").otherwise(F.concat(F.lit("Author "), (i % 11).cast("string"))).alias("authors"), F.when(i % 5 == 0, "").otherwise(F.concat(F.lit("J"), (i % 13).cast("string"))).alias("journal"),
        (2010 + i % 16).cast("string").alias("year"), F.col("source").alias("source_api"), F.col("lang").alias("source_query"),
    )


DOI_SQL = "CASE WHEN doc_id % 4 = 1 THEN '' ELSE '10.' || (1000 + (doc_id // 3) % 97) || '/D' || (doc_id // 3) END"
DIRTY_SQL = "CASE WHEN d = '' THEN '' WHEN doc_id % 6 = 0 THEN d WHEN doc_id % 6 = 1 THEN 'https://doi.org/' || d WHEN doc_id % 6 = 2 THEN 'http://dx.doi.org/' || d WHEN doc_id % 6 = 3 THEN d || '.' WHEN doc_id % 6 = 4 THEN d || ')' ELSE d || ' x' END"
CANDIDATES = f"""cand AS (SELECT doc_id AS seq, CASE WHEN doc_id % 6 IN (2, 3) AND (doc_id // 6) % 2 = 0 THEN (doc_id // 6)::VARCHAR ELSE '' END AS pmid, {DIRTY_SQL} AS doi,
 substr(text, 1, 80) AS title, text AS abstract, CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'Author ' || (doc_id % 11) END AS authors, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'J' || (doc_id % 13) END AS journal,
 (2010 + doc_id % 16)::VARCHAR AS year, source AS source_api, lang AS source_query FROM (SELECT *, {DOI_SQL} AS d FROM documents))"""


def sql_normalize_doi(x: str) -> str:
    v = f"regexp_replace(lower(trim({x})), '^https?://(dx\\.)?doi\\.org/', '')"
    last = "a[-1:]"
    more = lambda c, o: f"({last} = '{c}' AND length(a) - length(replace(a, '{c}', '')) > length(a) - length(replace(a, '{o}', '')))"
    drop = f"({last} IN ('.', ',', ';', '>', '\"', '''', '/') OR {more(')', '(')} OR {more(']', '[')} OR {more('}', '{')})"
    cut = f"list_reduce(list_concat([{v}], list_transform(range(12), lambda i: '')), lambda a, b: CASE WHEN {drop} THEN a[:-2] ELSE a END)"
    return f"(CASE WHEN regexp_full_match({v}, '10\\.\\d{{4,9}}/\\S+') AND regexp_full_match({cut}, '10\\.\\d{{4,9}}/\\S+') THEN {cut} END)"


NORMED = f"normed AS (SELECT *, {sql_normalize_doi('doi')} AS nd FROM cand)"
TITLE_SQL = r"trim(regexp_replace(regexp_replace(lower(title), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def rated(spark, sf_dir) -> DataFrame:
    """doc_id, source, a and b: labels of two raters, b flipping some of a by a hash."""
    from curata.functions.ids import unit_hash

    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), "doc_id")
    flip = unit_hash(F.lit("rater"), F.col("doc_id").cast("string")) < 0.2
    return rows.select("doc_id", "source", "lang", F.col("quality").alias("a"), F.when(flip, 1 - F.col("quality")).otherwise(F.col("quality")).alias("b"), "toxic")


RATED = "rated AS (SELECT doc_id, source, lang, quality AS a, CASE WHEN ('0x' || substr(sha256('rater:' || doc_id), 1, 8))::BIGINT / 4294967296.0 < 0.2 THEN 1 - quality ELSE quality END AS b, toxic FROM labels JOIN documents USING (doc_id))"


def outcomes(spark, sf_dir) -> DataFrame:
    """row, paper, gt, ext: three-class labels by (quality, toxic), and the second rater's."""
    r = rated(spark, sf_dir)
    name = lambda q, t: F.when(t == 1, "inconclusive").when(q == 1, "success").otherwise("failure")
    return r.select(F.col("doc_id").alias("row"), F.col("source").alias("paper"), "lang", name(F.col("a"), F.col("toxic")).alias("gt"), name(F.col("b"), F.when(F.col("doc_id") % 9 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))).alias("ext"))


OUTCOMES = RATED + ", outcomes AS (SELECT doc_id AS row, source AS paper, lang, CASE WHEN toxic = 1 THEN 'inconclusive' WHEN a = 1 THEN 'success' ELSE 'failure' END AS gt, CASE WHEN (CASE WHEN doc_id % 9 = 0 THEN 1 - toxic ELSE toxic END) = 1 THEN 'inconclusive' WHEN b = 1 THEN 'success' ELSE 'failure' END AS ext FROM rated)"
