"""Queries of scalar functions: identifiers, text, rules, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from curata.functions import ids, text, validate
from curata.operators import catalog, rules
from curata.plans import fixtures as fx
from curata.plans.catalogue import query, table

docs = lambda spark, d: table(spark, d, "documents")


@query("doi_normalize", f"WITH {fx.CANDIDATES}, {fx.NORMED} SELECT seq, doi AS raw, nd AS doi FROM normed")
def doi_normalize(spark, d):
    return fx.candidates(spark, d).select("seq", F.col("doi").alias("raw"), ids.normalize_doi(F.col("doi")).alias("doi"))


_FOLDERS = "SELECT seq, raw, replace(replace(replace(replace(replace(replace(replace(replace(replace(list_aggregate(list_transform(range(1, length(raw) + 1), lambda i: CASE WHEN raw[i] = '-' AND ((i > 1 AND raw[i-1] IN ('-', '/')) OR raw[i+1] IN ('-', '/')) THEN '~2d~' ELSE raw[i] END), 'string_agg', ''), '/', '--'), '<', '~3c~'), '>', '~3e~'), '\"', '~22~'), '\\', '~5c~'), '|', '~7c~'), '?', '~3f~'), '*', '~2a~'), ':', '~') AS folder FROM x"
_RAW = "x AS (SELECT doc_id AS seq, '10.' || (1000 + doc_id % 97) || '/' || CASE doc_id % 5 WHEN 0 THEN 'a--b:' WHEN 1 THEN '-x<' WHEN 2 THEN 'q-/z?' WHEN 3 THEN 'm-n|*' ELSE '' END || doc_id || '/tail' AS raw FROM documents)"


def _raw_dois(spark, d):
    i = F.col("doc_id")
    mid = F.element_at(F.array(*map(F.lit, ["a--b:", "-x<", "q-/z?", "m-n|*", ""])), (i % 5 + 1).cast("int"))
    return docs(spark, d).select(i.alias("seq"), F.concat(F.lit("10."), (1000 + i % 97).cast("string"), F.lit("/"), mid, i.cast("string"), F.lit("/tail")).alias("raw"))


@query("doi_folder_codec", f"WITH {_RAW} {_FOLDERS}")
def doi_folder_codec(spark, d):
    return _raw_dois(spark, d).select("seq", "raw", ids.doi_to_folder(F.col("raw")).alias("folder"))


@query("folder_decode", f"WITH {_RAW} SELECT seq, raw AS doi, TRUE AS canonical, TRUE AS is_folder FROM x")
def folder_decode(spark, d):
    rows = _raw_dois(spark, d).select("seq", ids.doi_to_folder(F.col("raw")).alias("f"))
    return rows.select("seq", ids.folder_to_doi(F.concat("f", F.lit(" (2)"))).alias("doi"), ids.round_trips(F.col("f")).alias("canonical"), ids.is_doi_folder(F.col("f")).alias("is_folder"))


@query("doi_url_forms", rf"WITH {fx.CANDIDATES} SELECT seq, regexp_replace(lower(trim(doi)), 'https?://(dx\.)?doi\.org/', 'https://doi.org/') AS url, nullif(regexp_extract(trim(doi), '^https?://(?:dx\.)?doi\.org/(10\..+)', 1), '') AS bare, regexp_replace(lower(doi), '[^a-z0-9]', '', 'g') AS key, {fx.sql_normalize_doi(chr(40) + "nullif(regexp_extract('see ' || doi, '10\\.\\d{4,9}/\\S+'), '')" + chr(41))} AS found FROM cand")
def doi_url_forms(spark, d):
    c = F.col("doi")
    return fx.candidates(spark, d).select("seq", ids.doi_url(c).alias("url"), ids.bare_doi(c).alias("bare"), ids.alnum_key(c).alias("key"), ids.first_doi(F.concat(F.lit("see "), c)).alias("found"))


@query("slugify_source", "SELECT doc_id, substr(regexp_replace(regexp_replace(lower(trim(text)), '[^a-z0-9_-]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 64) AS slug FROM documents")
def slugify_source(spark, d):
    return docs(spark, d).select("doc_id", ids.slugify(F.col("text")).alias("slug"))


@query("split_assign", "SELECT doc_id, CASE WHEN ('0x' || substr(sha256('gold:' || doc_id), 1, 8))::BIGINT / 4294967296.0 < 0.6 THEN 'test' ELSE 'dev' END AS split FROM documents")
def split_assign(spark, d):
    return docs(spark, d).select("doc_id", ids.split_of(F.col("doc_id").cast("string"), "gold").alias("split"))


@query("content_ids", "SELECT doc_id, substr(sha1(source || chr(31) || lang || chr(31) || text), 1, 10) AS id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS occurrence FROM documents")
def content_ids(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy(F.sha2("text", 256)).orderBy("doc_id")
    return docs(spark, d).select("doc_id", ids.content_id(F.col("source"), F.col("lang"), F.col("text")).alias("id"), F.row_number().over(w).cast("long").alias("occurrence"))


@query("artifact_stems", "SELECT page_id, 'p' || page_id AS stem, CASE page_id % 4 WHEN 0 THEN 'html' WHEN 1 THEN 'html' WHEN 2 THEN 'xml' ELSE 'pdf' END AS kind FROM pages")
def artifact_stems(spark, d):
    i = F.col("page_id")
    name = F.concat(F.lit("p"), i.cast("string"), F.element_at(F.array(*map(F.lit, [".fulltext.html", ".html", ".xml", ".pdf"])), (i % 4 + 1).cast("int")))
    kind = F.when(name.endswith(".html"), "html").when(name.endswith(".xml"), "xml").otherwise("pdf")
    return table(spark, d, "pages").select("page_id", ids.stem(name).alias("stem"), kind.alias("kind"))


@query("near_doi_pairs", "WITH x AS (SELECT doc_id, '10.1000/abcdef' || doc_id AS a, CASE doc_id % 3 WHEN 0 THEN '10.1000/abcdef' || doc_id || '.x' WHEN 1 THEN substr('10.1000/abcdef' || doc_id, 1, 9) ELSE '10.1000/abcdef' || (doc_id + 1) END AS b FROM documents) SELECT doc_id, (least(length(a), length(b)) >= 12 AND abs(length(a) - length(b)) <= 3 AND (starts_with(a, b) OR starts_with(b, a))) AS near FROM x")
def near_doi_pairs(spark, d):
    i = F.col("doc_id")
    a = F.concat(F.lit("10.1000/abcdef"), i.cast("string"))
    b = F.when(i % 3 == 0, F.concat(a, F.lit(".x"))).when(i % 3 == 1, F.substring(a, 1, 9)).otherwise(F.concat(F.lit("10.1000/abcdef"), (i + 1).cast("string")))
    return docs(spark, d).select("doc_id", ids.near_doi(a, b).alias("near"))


@query("title_normalize", f"SELECT doc_id, md5({fx.TITLE_SQL}) AS title FROM (SELECT doc_id, text AS title FROM documents)")
def title_normalize(spark, d):
    return docs(spark, d).select("doc_id", F.md5(text.normalize_title(F.col("text"))).alias("title"))


@query("deinvert_abstract", r"SELECT doc_id, md5(array_to_string(list_filter(str_split_regex(text, '\s+'), lambda w: w <> ''), ' ')) AS text FROM documents")
def deinvert_abstract(spark, d):
    return _deinverted(spark, d).withColumn("text", F.md5("text"))


def _deinverted(spark, d):
    """Whole texts from their inverted index, which is made row by row: no word is shuffled."""
    return docs(spark, d).select("doc_id", text.deinvert(text.inverted("text")).alias("text"))


@query("strip_html", "SELECT page_id, length(regexp_replace(html, '<[^>]+>', '', 'g')) AS n, md5(regexp_replace(html, '<[^>]+>', '', 'g')) AS digest FROM pages")
def strip_html(spark, d):
    plain = text.strip_tags(F.col("html"))
    return table(spark, d, "pages").select("page_id", F.length(plain).cast("long").alias("n"), F.md5(plain).alias("digest"))


@query("labels_and_buckets", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'unknown' WHEN 1 THEN CASE WHEN 2010 + doc_id % 16 <= 2018 THEN '<=2018' WHEN 2010 + doc_id % 16 <= 2022 THEN '2019-2022' ELSE '2023+' END ELSE CASE WHEN 2010 + doc_id % 16 <= 2018 THEN '<=2018' WHEN 2010 + doc_id % 16 <= 2022 THEN '2019-2022' ELSE '2023+' END END AS years, CASE doc_id % 5 WHEN 0 THEN 'psych' WHEN 1 THEN 'biomed' WHEN 2 THEN 'socsci' WHEN 3 THEN 'other' ELSE 'unknown' END AS grp FROM documents")
def labels_and_buckets(spark, d):
    i = F.col("doc_id")
    year = F.when(i % 4 == 0, " nan").when(i % 4 == 1, F.concat((2010 + i % 16).cast("string"), F.lit(".0"))).otherwise((2010 + i % 16).cast("string"))
    field = F.element_at(F.array(*map(F.lit, ["Psychology ", "genetics", "ECONOMICS", "astrology", " "])), (i % 5 + 1).cast("int"))
    return docs(spark, d).select("doc_id", text.year_bucket(year).alias("years"), text.discipline_group(field).alias("grp"))


_PEOPLE = "p AS (SELECT n_nationkey AS k, string_agg(CASE WHEN s_suppkey % 2 = 0 THEN 'Last' || (s_suppkey % 17) || ', F' ELSE 'Al Last' || (s_suppkey % 17) END, '; ' ORDER BY s_suppkey) AS a, string_agg('Q. Last' || (s_suppkey % 13), '; ' ORDER BY s_suppkey) AS b FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)"


def _people(spark, d):
    s = F.col("s_suppkey")
    one = F.when(s % 2 == 0, F.concat(F.lit("Last"), (s % 17).cast("string"), F.lit(", F"))).otherwise(F.concat(F.lit("Al Last"), (s % 17).cast("string")))
    two = F.concat(F.lit("Q. Last"), (s % 13).cast("string"))
    sorted_ = lambda c, n: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(s.alias("s"), c.alias("v")))), lambda x: x["v"]), "; ").alias(n)
    return table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(sorted_(one, "a"), sorted_(two, "b"))


@query("authors_jaccard", f"WITH {_PEOPLE}, n AS (SELECT k, list_sort(list_distinct(list_transform(str_split(a, '; '), lambda x: CASE WHEN contains(x, ',') THEN lower(str_split(x, ',')[1]) ELSE lower(str_split(x, ' ')[-1]) END))) AS x, list_sort(list_distinct(list_transform(str_split(b, '; '), lambda x: lower(str_split(x, ' ')[-1])))) AS y FROM p) SELECT k, array_to_string(x, ',') AS names, round(len(list_intersect(x, y))::DOUBLE / len(list_distinct(list_concat(x, y))), 9) AS jaccard, len(list_intersect(x, y))::DOUBLE / len(list_distinct(list_concat(x, y))) >= 0.7 AS same FROM n")
def authors_jaccard(spark, d):
    x, y = text.last_names(F.col("a")), text.last_names(F.col("b"))
    return _people(spark, d).select("k", F.array_join(x, ",").alias("names"), F.round(text.overlap(x, y), 9).alias("jaccard"), text.authors_match(F.col("a"), F.col("b")).alias("same"))


@query("author_quality", "SELECT doc_id, 2::BIGINT AS n, CASE doc_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 0 END::BIGINT AS n_full, doc_id % 4 IN (0, 2) AS better, CASE doc_id % 4 WHEN 0 THEN 'Ann Lee; Bo Ray' WHEN 1 THEN 'A. Lee; Ray, B.' WHEN 2 THEN 'Ann Lee; B. Ray' ELSE 'Lee A.; Ray B.C.' END AS formatted FROM documents")
def author_quality(spark, d):
    i = F.col("doc_id")
    a = F.element_at(F.array(*map(F.lit, ["Ann Lee; Bo Ray", "A Lee; Ray, B.", "Ann Lee; B Ray", "Lee A; Ray B.C."])), (i % 4 + 1).cast("int"))
    q = text.full_first_names(a)
    return docs(spark, d).select("doc_id", q["n"].cast("long").alias("n"), q["n_full"].cast("long").alias("n_full"), text.better_authors(F.lit("A. Lee; B. Ray"), a).alias("better"), text.format_initials(a).alias("formatted"))


@query("metadata_validation", "WITH x AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 1999 WHEN 1 THEN 2000 ELSE NULL END AS fy, CASE doc_id % 5 WHEN 0 THEN 'journal of things' WHEN 1 THEN 'other' ELSE '' END AS fj, CASE WHEN doc_id % 2 = 0 THEN '7' ELSE '' END AS fv FROM documents) SELECT doc_id, (fy IS NULL OR fy = 1999) AND (fj = '' OR fj = 'journal of things') AND (coalesce(fy = 1999, FALSE) OR fj = 'journal of things' OR fv = '7') AS valid FROM x")
def metadata_validation(spark, d):
    i = F.col("doc_id")
    got = {"year": F.when(i % 3 == 0, 1999).when(i % 3 == 1, 2000), "journal": F.when(i % 5 == 0, "Journal of Things").when(i % 5 == 1, "other").otherwise(""), "volume": F.when(i % 2 == 0, "7").otherwise("")}
    return docs(spark, d).select("doc_id", text.metadata_valid(got, {"year": F.lit("1999"), "journal": F.lit("of things"), "volume": F.lit(" 7")}).alias("valid"))


@query("full_titles", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 OR contains(lower(p_name), lower(p_type)) THEN p_name ELSE rtrim(p_name, ': ') || ': ' || p_type END AS title FROM part")
def full_titles(spark, d):
    sub = F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_type"))
    return table(spark, d, "part").select("p_partkey", text.full_title(F.col("p_name"), sub).alias("title"))


_STOP = ", ".join(f"'{w}'" for w in text.CLAIM_STOP_WORDS)
_FRAME = text.CLAIM_FRAME.replace("'", "''")
_TOK = lambda c: rf"list_filter(list_distinct(regexp_extract_all(regexp_replace(lower(trim({c})), '{_FRAME}', ''), '[a-z0-9]+')), lambda w: w NOT IN ({_STOP}))"


@query("dice_pairs", f"WITH x AS (SELECT d.doc_id, {_TOK('d.text')} AS a, {_TOK('e.text')} AS b FROM documents d JOIN documents e ON e.doc_id = d.doc_id + 1) SELECT doc_id, round(CASE WHEN len(a) > 0 AND len(b) > 0 THEN 2.0 * len(list_intersect(a, b)) / (len(a) + len(b)) ELSE 0 END, 9) AS dice FROM x")
def dice_pairs(spark, d):
    # the regular expressions run once a text, and words are what is shuffled
    parts = docs(spark, d).select("doc_id", text.claim_parts(F.col("text")).alias("a"))
    b = parts.select((F.col("doc_id") - 1).alias("doc_id"), F.col("a").alias("b"))
    return parts.join(b, "doc_id").select("doc_id", F.round(text.dice_of_parts(F.col("a"), F.col("b")), 9).alias("dice"))


_LINES = "list_filter(list_transform(str_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '' AND NOT regexp_matches(x, '^[#>|<]'))"


@query("prose_gate", f"SELECT doc_id, coalesce(list_aggregate(list_transform({_LINES}, lambda x: length(x)), 'median'), 0)::DOUBLE AS score, coalesce(list_aggregate(list_transform({_LINES}, lambda x: length(x)), 'median'), 0) >= 60 AS passes FROM documents")
def prose_gate(spark, d):
    score = text.prose_score(F.col("text"))
    return docs(spark, d).select("doc_id", score.cast("double").alias("score"), (score >= 60).alias("passes"))


@query("ref_legibility", r"WITH x AS (SELECT doc_id, list_filter(str_split(text, chr(10)), lambda x: length(trim(x)) > 15) AS l FROM documents) SELECT doc_id, round(CASE WHEN len(l) = 0 THEN 0 ELSE len(list_filter(l, lambda x: length(regexp_replace(x, '[^\p{L}]', '', 'g')) > 0 AND length(regexp_replace(x, '[^aeiouAEIOU]', '', 'g'))::DOUBLE / greatest(length(regexp_replace(x, '[^\p{L}]', '', 'g')), 1) >= 0.22 AND len(list_filter(str_split_regex(trim(x), '\s+'), lambda w: regexp_full_match(w, '[A-Za-z][A-Za-z''.-]{2,}'))) >= 3))::DOUBLE / len(l) END, 9) AS share FROM x")
def ref_legibility(spark, d):
    return docs(spark, d).select("doc_id", F.round(text.legible_share(F.col("text")), 9).alias("share"))


_NONE = "'[REFERENCE LIST: none]' || chr(10) || 'The reference list could not be read and is withheld.' || chr(10) || chr(10)"


@query("withhold_references", f"SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'BODY' || chr(10) || {_NONE} || '[END]' || chr(10) || 'x' WHEN 1 THEN 'BODY' || chr(10) || '[REFERENCE LIST: refs]' || chr(10) || 'Author and another wrote things in places' || chr(10) || '[END]' || chr(10) || 'x' WHEN 2 THEN 'BODY' || chr(10) || {_NONE} || 'Reply with JSON.' WHEN 3 THEN 'BODY' || chr(10) || {_NONE} WHEN 4 THEN 'BODY' || chr(10) || {_NONE} WHEN 5 THEN 'BODY only [REFERENCE LIST: no header]' END AS text FROM documents")
def withhold_references(spark, d):
    """A list before another section, a legible one, one before the last instruction, before too long a paragraph, an empty one, and none."""
    junk, good, head = "D 3&0201. 01&%00: 3. 0192 &%$ 2231 %%", "Author and another wrote things in places", "BODY\n[REFERENCE LIST: refs]\n"
    cases = [f"{head}{junk}\n[END]\nx", f"{head}{good}\n[END]\nx", f"{head}{junk}\n\nReply with JSON.", f"{head}{junk}\n\n" + "0192 &%$ 2231 %% " * 20, head, "BODY only [REFERENCE LIST: no header]"]
    whole = F.element_at(F.array(*map(F.lit, cases)), (F.col("doc_id") % 6 + 1).cast("int"))
    return docs(spark, d).select("doc_id", text.without_unreadable_references(whole).alias("text"))


@query("truncate_middle", "SELECT doc_id, md5(CASE WHEN length(text) <= 1000 THEN text ELSE substr(text, 1, 550) || chr(10) || chr(10) || '[... ' || format('{:,}', length(text) - 1000) || ' characters omitted from the middle of the full text ...]' || chr(10) || chr(10) || right(text, 450) END) AS digest FROM documents")
def truncate_middle(spark, d):
    return docs(spark, d).select("doc_id", F.md5(text.truncate_middle(F.col("text"), 1000)).alias("digest"))


@query("husk_gate", "SELECT doc_id, CASE WHEN doc_id % 7 <> 0 AND n_chars < 500 THEN 'under 500 characters' WHEN doc_id % 7 <> 0 AND n_chars < 2000 AND doc_id % 3 = 1 THEN 'one page under 2000 characters' END AS reason FROM documents")
def husk_gate(spark, d):
    i = F.col("doc_id")
    return docs(spark, d).select("doc_id", catalog.husk(F.col("n_chars"), i % 7 == 0, i % 3).alias("reason"))


_DW = lambda c: f"list_distinct(list_filter(regexp_extract_all(lower({c}), '[a-z0-9]+'), lambda w: length(w) > 4))"


@query("distinctive_overlap", f"WITH x AS (SELECT d.doc_id, {_DW('b.text')} AS w, {_DW('substr(d.text, 1, 5000)')} AS t FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % (SELECT count(*) FROM benchmark)) SELECT doc_id, len(w) > 0 AND len(list_intersect(w, t)) < least(2, len(w)) AS wrong FROM x")
def distinctive_overlap(spark, d):
    """Items of the benchmark stand for expected titles; the operator reads a text's first 5000 characters."""
    b = table(spark, d, "benchmark").select("item_id", F.col("text").alias("title"))
    n = table(spark, d, "benchmark").agg(F.count("*").alias("n"))  # one row
    a = docs(spark, d).join(F.broadcast(n)).select("doc_id", "text", (F.col("doc_id") % F.col("n")).alias("item_id"))
    return a.join(b, "item_id").select("doc_id", catalog.wrong_document(F.col("title"), F.col("text")).alias("wrong"))


@query("xml_list_text", "SELECT page_id, 'Ref one of ' || page_id || chr(10) || 'A & B two' AS text FROM pages")
def xml_list_text(spark, d):
    raw = F.concat(F.lit("<art><p>x</p><ref-list><ref><n>Ref one</n> of "), F.col("page_id").cast("string"), F.lit("</ref><ref>A &amp; B  <i>two</i></ref><ref>ab</ref></ref-list></art>"))
    return table(spark, d, "pages").select("page_id", text.bibliography_text(raw).alias("text"))


@query("render_references", "SELECT doc_id, '[1] A; B (' || (2000 + doc_id % 20) || ') Title ' || doc_id || '. J 3(4): 5-6. doi:10.1/x' || chr(10) || '[2] raw ' || doc_id AS text FROM documents")
def render_references(spark, d):
    i = F.col("doc_id").cast("string")
    s = lambda v: F.lit(v).cast("string")
    ref = lambda raw, a, y, t, j, v, n, p, x: F.struct(s(None).alias("id"), raw.alias("raw"), a.alias("authors"), y.alias("year"), t.alias("title"), j.alias("journal"), v.alias("volume"), n.alias("issue"), p.alias("pages"), x.alias("doi"))
    none = F.array().cast("array<string>")
    refs = F.array(ref(s(None), F.array(s("A"), s("B")), (2000 + F.col("doc_id") % 20).cast("string"), F.concat(F.lit("Title "), i, F.lit(".")), s("J"), s("3"), s("4"), s("5-6"), s("10.1/x")), ref(s(None), none, s(None), s(None), s(None), s(None), s(None), s(None), s(None)), ref(F.concat(F.lit("raw "), i), none, s(None), s(None), s(None), s(None), s(None), s(None), s(None)))
    return docs(spark, d).select("doc_id", text.rendered_references(refs).alias("text"))


_BODY = "CASE WHEN length(t) <= 20000 THEN t ELSE substr(t, 1, 11000) || chr(10) || chr(10) || '[... ' || format('{:,}', length(t) - 20000) || ' characters omitted from the middle of the full text ...]' || chr(10) || chr(10) || right(t, 9000) END"


@query("request_assembly", f"SELECT doc_id, md5('Extract replication data from the paper below.' || chr(10) || chr(10) || '[PAPER DOI]' || chr(10) || doc_id || chr(10) || chr(10) || CASE WHEN t IS NULL THEN '' ELSE '[FULL TEXT]' || chr(10) || {_BODY} || chr(10) || chr(10) END || '[REFERENCE LIST: md]' || chr(10) || 'r' || chr(10) || chr(10) || 'Reply with the JSON object only.') AS digest FROM (SELECT doc_id, trim(text, ' ') AS t FROM documents)")
def request_assembly(spark, d):
    """Requests of all documents; bodies beyond 20,000 characters are cut in the middle."""
    return docs(spark, d).select("doc_id", F.md5(text.assembled(F.col("doc_id").cast("string"), F.lit(""), F.col("text"), F.lit("r"), F.lit("md"), 10_000)).alias("digest"))


@query("source_buckets", "SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'fred' WHEN 1 THEN 'curate_science' WHEN 2 THEN 'repwiki_ai' WHEN 3 THEN 'darpa_score' WHEN 4 THEN 'manual_other' WHEN 5 THEN 'ai_pipeline' ELSE 'unattributed' END AS bucket FROM documents")
def source_buckets(spark, d):
    n = (F.col("doc_id") % 7 + 1).cast("int")
    pick = lambda v: F.element_at(F.array(*[F.lit(x).cast("string") for x in v]), n)
    return docs(spark, d).select("doc_id", text.source_bucket(pick(["FReD x", None, "Replication Wiki", None, "someone", " ", None]), pick([None, "Curate Science", "score", "SCORE", None, "", None]), pick([None, None, None, "8", "8", "8.1", None])).alias("bucket"))


@query("citation_check", "SELECT doc_id, doc_id % 2 = 0 AS author_found, doc_id % 3 = 0 AS year_found, doc_id % 2 = 1 AND doc_id % 3 = 0 AS mismatch FROM documents")
def citation_check(spark, d):
    i = F.col("doc_id")
    sentence = F.concat(F.lit("As "), F.when(i % 2 == 0, "SMITH").otherwise("Nobody"), F.lit(" ("), F.when(i % 3 == 0, "1999").otherwise("2001"), F.lit(")"))
    c = text.citation_mentions(sentence, F.lit("Smith, John; Jones, Al"), F.lit("1999"))
    backed = text.reference_supports(F.when(i % 3 == 0, "other 1998").otherwise("smith 1999"), F.array(F.lit("smith")), F.lit("1999"))
    return docs(spark, d).select("doc_id", c["author_found"].alias("author_found"), c["year_found"].alias("year_found"), (~(c["author_found"] & c["year_found"]) & ~backed).alias("mismatch"))


@query("excerpt_from_heading", "SELECT doc_id, md5(CASE WHEN doc_id % 2 = 0 THEN substr('# Discussion' || chr(10) || text, 1, 200) ELSE right('Intro' || chr(10) || replace(text, 'iscussion', ''), 200) END) AS digest FROM documents")
def excerpt_from_heading(spark, d):
    t = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("Intro\n# Discussion\n"), F.col("text"))).otherwise(F.concat(F.lit("Intro\n"), F.replace("text", F.lit("iscussion"), F.lit(""))))
    return docs(spark, d).select("doc_id", F.md5(text.from_heading(t, "Discussion|Conclusions?", 200)).alias("digest"))


@query("phrase_location", "SELECT doc_id, strpos(text, p) AS pos, length(left(text, strpos(text, p))) - length(replace(left(text, strpos(text, p)), chr(10), '')) + 1 AS line FROM (SELECT doc_id, text, substr(text, greatest(1, length(text) // 2), 12) AS p FROM documents)")
def phrase_location(spark, d):
    rows = docs(spark, d).withColumn("p", F.expr("substr(text, int(greatest(1, length(text) div 2)), 12)"))
    pos = F.expr("instr(text, p)")
    head = F.expr("left(text, instr(text, p))")
    return rows.select("doc_id", pos.cast("long").alias("pos"), (F.length(head) - F.length(F.replace(head, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("line"))


# domain-neutral rules for the driver's texts, in RE2's and Java's common subset
NEUTRAL = rules.RuleSet("the|and|de|und", ["Released under the [A-Z]+ License", "[Ll]icensed under"], {"secret": ["TOKEN = ", "[A-F0-9]{32}"], "contact": ["[a-z0-9]+@[a-z]+"]}, ["!!", "&&&", "[*]{3}"], ["[%$]{3}", "[0-9]{3}"], ("the", "der"), "")
_FLAT = {"strong": "|".join(NEUTRAL.strong), "secret": "|".join(NEUTRAL.exclusions["secret"]), "contact": NEUTRAL.exclusions["contact"][0]}
_CLEAN = "lower(a)"
for _p in NEUTRAL.strip:
    _CLEAN = f"regexp_replace({_CLEAN}, '{_p}', '', 'g')"
_RULES = f"""r AS (SELECT doc_id, CASE
 WHEN NOT regexp_matches(x, '{NEUTRAL.gate}') THEN 'no_replication_word'
 WHEN regexp_matches(x, '{_FLAT["strong"]}') THEN 'strong_positive'
 WHEN regexp_matches(x, '{_FLAT["secret"]}') THEN 'secret'
 WHEN regexp_matches(x, '{_FLAT["contact"]}') THEN 'contact'
 WHEN regexp_matches(a, '{"|".join(NEUTRAL.strip)}') AND NOT contains({_CLEAN}, 'the') AND NOT contains({_CLEAN}, 'der') THEN CASE WHEN regexp_matches(t, '{NEUTRAL.gate}') THEN 'title_has_replication' ELSE 'stat_replicates_only' END
 WHEN regexp_matches(x, '{"|".join(NEUTRAL.weak)}') THEN 'weak_positive' ELSE 'weak_replication_word' END AS reason,
 coalesce({", ".join(f"CASE WHEN regexp_matches(x, '{p}') THEN '{p}' END" for p in NEUTRAL.strong)}, '') AS s, coalesce({", ".join(f"CASE WHEN regexp_matches(x, '{p}') THEN '{p}' END" for p in NEUTRAL.weak)}, '') AS w
 FROM (SELECT doc_id, substr(text, 1, 80) AS t, text AS a, substr(text, 1, 80) || ' ' || text AS x FROM documents))"""


def _classified(spark, d):
    return docs(spark, d).select("doc_id", rules.classify(F.substring("text", 1, 80), F.col("text"), NEUTRAL).alias("r")).select("doc_id", "r.*")


@query("rule_classify", f"WITH {_RULES} SELECT doc_id, reason IN ('strong_positive', 'weak_positive', 'title_has_replication') AS keep, reason, CASE reason WHEN 'strong_positive' THEN s WHEN 'weak_positive' THEN w ELSE '' END AS detail FROM r")
def rule_classify(spark, d):
    return _classified(spark, d)


@query("rule_histogram", f"WITH {_RULES} SELECT reason, count(*) AS n, max(CASE WHEN reason IN ('strong_positive', 'weak_positive', 'title_has_replication') THEN 'KEEP' ELSE 'EXCLUDE' END) AS tag FROM r GROUP BY 1")
def rule_histogram(spark, d):
    return rules.histogram(_classified(spark, d))


@query("rule_first_match", "SELECT doc_id, CASE WHEN regexp_matches(text, '[0-9]{4}') THEN 'number' WHEN regexp_matches(text, '@') THEN 'at' WHEN regexp_matches(text, '!!') THEN 'shout' ELSE 'none' END AS rule FROM documents")
def rule_first_match(spark, d):
    return docs(spark, d).select("doc_id", rules.first_rule([("number", "[0-9]{4}"), ("at", "@"), ("shout", "!!")], F.col("text")).alias("rule"))


@query("screening_rules", "SELECT doc_id, (['strong_positive', 'bio_replication', 'measurement_repro', 'stat_replicates_only', 'weak_positive', 'no_replication_word'])[doc_id % 6 + 1] AS reason FROM documents")
def screening_rules(spark, d):
    """The default rules over whole texts with a phrase of theirs in the title or, for one kind, behind the text."""
    i = F.col("doc_id") % 6
    phrases = ["A direct replication", "viral replication", "assay reproducibility", "performed in triplicate; technical replicates", "replication of the effect", "nothing"]
    t = F.element_at(F.array(*map(F.lit, phrases)), (i + 1).cast("int"))
    abstract = F.concat_ws(" ", "text", F.when(i == 3, t))
    return docs(spark, d).select("doc_id", rules.classify(F.when(i != 3, t).otherwise("x"), abstract).alias("r")).select("doc_id", "r.reason")


@query("enum_validate", "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'success' WHEN 1 THEN 'close experiment' WHEN 2 THEN 'maybe' WHEN 3 THEN '' ELSE 'direct' END AS value, CASE doc_id % 5 WHEN 0 THEN 'Success -> success' WHEN 1 THEN 'close -> close experiment' WHEN 2 THEN 'not valid: maybe' END AS message FROM documents")
def enum_validate(spark, d):
    i = F.col("doc_id")
    v = F.element_at(F.array(*map(F.lit, ["Success", "Close", "maybe", "", "direct"])), (i % 5 + 1).cast("int"))
    return docs(spark, d).select("doc_id", validate.enum(v, [*validate.RESULTS, *validate.TYPES], validate.TYPE_ALIASES).alias("e")).select("doc_id", "e.*")


@query("stat_checks", "SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(list_filter([CASE WHEN l_linenumber % 4 = 1 THEN 'n is not a valid integer' END, CASE WHEN l_linenumber % 4 = 2 THEN 'n should be positive' END, CASE WHEN l_tax * 20 > 1 THEN 'p outside [0, 1]' END, CASE WHEN l_returnflag = 'R' THEN 'p type not valid' END, CASE WHEN l_discount > 0.05 THEN 'effect size without type' END], lambda x: x IS NOT NULL), '|') AS messages FROM lineitem")
def stat_checks(spark, d):
    n = F.when(F.col("l_linenumber") % 4 == 1, "many").when(F.col("l_linenumber") % 4 == 2, "0").when(F.col("l_linenumber") % 4 == 3, "").otherwise("12.0")
    p, kind = (F.col("l_tax") * 20).cast("string"), F.when(F.col("l_returnflag") == "R", "~").otherwise("<")
    es = F.when(F.col("l_discount") > 0.05, F.col("l_discount").cast("string")).otherwise("")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(validate.statistics_messages(n, p, kind, es, F.lit("")), "|").alias("messages"))


@query("envelope_checks", "SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN 'contains is true but there are no entries' WHEN conv_id % 3 = 1 THEN 'contains is false but there are entries' ELSE '' END AS messages, CASE WHEN conv_id % 3 = 0 THEN 'description|discipline' ELSE 'discipline' END AS missing FROM conversations GROUP BY conv_id")
def envelope_checks(spark, d):
    c = F.col("conv_id") % 3
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list("turn").alias("turns"))
    entries = F.when(c == 0, F.array().cast("array<bigint>")).otherwise(F.col("turns"))
    need = validate.missing({"description": F.when(c == 0, "").otherwise("x"), "result": F.lit("success"), "discipline": F.lit(None).cast("string")})
    return rows.select("conv_id", F.array_join(validate.envelope_messages(c != 1, entries), "|").alias("messages"), F.array_join(need, "|").alias("missing"))


@query("verdict_validation", "SELECT doc_id, CASE WHEN doc_id % 4 IN (0, 1) THEN doc_id % 2 = 0 END AS is_replication, CASE WHEN doc_id % 4 = 0 THEN 'high' WHEN doc_id % 4 = 1 THEN 'low' END AS confidence, CASE WHEN doc_id % 4 = 0 THEN 'direct' END AS kind FROM documents")
def verdict_validation(spark, d):
    i = F.col("doc_id") % 4
    pick = lambda v: F.element_at(F.array(*[F.lit(x).cast("string") for x in v]), (i + 1).cast("int"))
    v = validate.verdict(pick(["True", " false", "true", "perhaps"]), pick(["HIGH", "low", "direct", "high"]), pick([" Direct", "null", None, ""]))
    return docs(spark, d).select("doc_id", v["is_replication"].alias("is_replication"), v["confidence"].alias("confidence"), v["replication_type"].alias("kind"))


@query("ontology_check", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Psychology' WHEN 1 THEN 'Psychology' WHEN 2 THEN 'Alchemy' ELSE 'other' END AS discipline, CASE doc_id % 4 WHEN 1 THEN 'Social' ELSE '' END AS subdiscipline, CASE doc_id % 4 WHEN 0 THEN 'psychology -> Psychology' WHEN 1 THEN 'social -> Psychology (was subdiscipline)' WHEN 2 THEN 'not in list: Alchemy' END AS message FROM documents")
def ontology_check(spark, d):
    onto = spark.createDataFrame([("Psychology", "Social"), ("Psychology", "Cognitive"), ("Economics", "Labour")], "discipline string, sub string")
    top = onto.select(F.lower("discipline").alias("k"), F.col("discipline").alias("canonical")).distinct()
    sub = onto.select(F.lower("sub").alias("k2"), F.col("discipline").alias("parent"), F.col("sub").alias("parent_sub"))
    i = F.col("doc_id")
    rows = docs(spark, d).select("doc_id", F.element_at(F.array(*map(F.lit, ["psychology", "social", "Alchemy", "other"])), (i % 4 + 1).cast("int")).alias("v"))
    out = rows.join(F.broadcast(top), F.lower("v") == F.col("k"), "left").join(F.broadcast(sub), F.lower("v") == F.col("k2"), "left")  # an ontology of a few hundred rows
    return out.select("doc_id", validate.discipline(F.col("v"), F.lit(""), F.col("canonical"), F.col("parent"), F.col("parent_sub")).alias("x")).select("doc_id", "x.*")


@query("primary_model", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'small' WHEN c_custkey % 3 = 1 THEN 'large' ELSE 'small' END AS model FROM customer")
def primary_model(spark, d):
    i = F.col("c_custkey") % 3
    m = F.create_map(F.lit("small"), F.lit(5), F.lit("large"), F.when(i == 0, 2).when(i == 1, 9).otherwise(5))
    return table(spark, d, "customer").select("c_custkey", validate.primary_key(m).alias("model"))


@query("props_json", "SELECT event_type, count(*) AS n, sum((props->>'$.k')::BIGINT)::BIGINT AS total FROM events GROUP BY 1")
def props_json(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").cast("long")).alias("total"))


@query("reply_parse")
def reply_parse(spark, d):
    """Replies fenced, in prose, as a list and without JSON."""
    i, n = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    raw = F.when(i == 0, F.concat(F.lit('```json\n{"a": '), n, F.lit("}\n```"))).when(i == 1, F.concat(F.lit('Here: {"a": '), n, F.lit("} and {more}"))).when(i == 2, F.concat(F.lit('[{"a": '), n, F.lit("}]"))).when(i == 3, "no json here").otherwise("[]")
    return docs(spark, d).select("doc_id", text.parsed_reply(raw).alias("reply"))


@query("title_ratio")
def title_ratio(spark, d):
    """difflib's ratios of neighbouring part names, whole; difflib itself checks it in the tests."""
    p = table(spark, d, "part")
    both = p.select("p_partkey", F.col("p_name").alias("a")).join(p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("b")), "p_partkey")
    return both.select("p_partkey", F.when(text.could_reach("a", "b", 0.3), text.string_ratio("a", "b")).otherwise(0.0).alias("ratio"), text.title_similarity(0.9)("a", "b").alias("title_similarity"))


@query("folded_names")
def folded_names(spark, d):
    """Whole texts without diacritics; Python's own folding checks it in the tests."""
    return docs(spark, d).select("doc_id", F.md5(text.fold(F.col("text"))).alias("folded"))


@query("table_splice")
def table_splice(spark, d):
    md = F.concat(F.lit("intro\n| a | b |\n| 1 | "), F.col("page_id").cast("string"), F.lit(" |\nend"))
    return table(spark, d, "pages").select("page_id", text.splice_tables(md, F.when(F.col("page_id") % 2 == 0, '["<table/>"]').otherwise("[]")).alias("text"))


_TEMPLATE = "regexp_replace(text, '([^\n]{40})', '\\1' || chr(10), 'g')"


@query("mode_blocks", f"""WITH t AS (SELECT doc_id, {_TEMPLATE} AS b FROM documents)
SELECT doc_id, md5(CASE doc_id % 5 WHEN 0 THEN b || chr(10) || b WHEN 1 THEN b || chr(10) || 'end' WHEN 2 THEN b END) AS digest, CASE doc_id % 5 WHEN 2 THEN NULL WHEN 3 THEN 'mode:core opens inside mode:full' WHEN 4 THEN CASE WHEN doc_id % 2 = 0 THEN 'mode:full is not closed' ELSE 'a block closes that is not open' END END AS error FROM t""")
def mode_blocks(spark, d):
    """Whole texts, cut into lines, within blocks that stay, go, or are put wrongly."""
    body, i = F.regexp_replace("text", "([^\n]{40})", "$1\n"), F.col("doc_id")
    opened, core, closed = "<!-- mode:full -->\n", "<!-- mode:core -->\n", " <!-- /mode -->\n"
    template = (
        F.when(i % 5 == 0, F.concat(body, F.lit("\n" + opened), body, F.lit("\n" + closed))).when(i % 5 == 1, F.concat(body, F.lit("\n" + core), body, F.lit("\n" + closed + "end"))).when(i % 5 == 2, body)
        .when(i % 5 == 3, F.concat(F.lit(opened), body, F.lit("\n" + core + closed))).when(i % 2 == 0, F.concat(F.lit(opened), body)).otherwise(F.concat(body, F.lit("\n" + closed)))
    )
    found = docs(spark, d).withColumn("x", text.mode_blocks(template, ["full"]))
    return found.select("doc_id", F.md5(F.when(i % 5 == 0, F.expr("left(x.text, length(x.text) - 1)")).otherwise(F.col("x.text"))).alias("digest"), "x.error")
