"""Sources: CSV, JSON, JSON lines, artifact trees, recorded search pages, overlays, DOI lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.functions.ids import normalize_doi, stem
from curata.functions.text import deinvert, strip_tags

# Names of a DOI column, best first.
PREFERRED_COLUMNS = ["replication_doi", "doi", "replication_url", "doi_url", "url"]
CANDIDATE_FIELDS = ["pmid", "doi", "title", "abstract", "authors", "journal", "year", "source_api", "source_query"]


def csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All strings, quoted newlines, no limit on a cell's size; a byte-order mark before the first name goes. Blank cells become NULL."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("maxCharsPerColumn", -1)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    frame = reader.option("inferSchema", False).csv(path)
    return frame.toDF(*[c.lstrip("﻿") for c in frame.columns])


def workbooks(spark: SparkSession, path: str) -> DataFrame:
    """path, content of every .xlsx file in a tree."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")


def workbook_cells(files: DataFrame) -> DataFrame:
    """path, row, pos, cell of workbooks(path, content): cells of the sheet that is open, if not empty, rows and columns from 0.

    The sheet is the one that the workbook's own list names as the active, else the first in it. A file that isn't a
    workbook has no cells, a damaged one those before the damage. Sheets are parsed as a stream, so a task holds one file and its strings.
    """
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows: list = []
                for cell in _sheet(content):
                    rows.append((path, *cell))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_pylist([dict(zip(("path", "row", "pos", "cell"), r, strict=True)) for r in rows], schema=kinds)
                        rows = []
                yield pa.RecordBatch.from_pylist([dict(zip(("path", "row", "pos", "cell"), r, strict=True)) for r in rows], schema=kinds)

    import pyarrow

    kinds = pyarrow.schema([("path", pyarrow.string()), ("row", pyarrow.int64()), ("pos", pyarrow.int32()), ("cell", pyarrow.string())])
    return files.select("path", "content").mapInArrow(run, "path string, row long, pos int, cell string")


def workbook_rows(files: DataFrame) -> DataFrame:
    """path, row, cells (map of header -> trimmed text) of workbooks(path, content): each sheet as a table.

    The first row is the header; rows whose cells are all blank are none; of columns with one header the last counts; a
    cell that isn't there is empty, one without a header is left out.
    """
    cells = workbook_cells(files)
    header = cells.where("row = 0").groupBy("path").agg(F.array_sort(F.collect_list(F.struct("pos", "cell"))).alias("header"))  # one row of a sheet
    rows = cells.where("row > 0 and trim(cell) <> ''").groupBy("path", "row").agg(F.map_from_entries(F.collect_list(F.struct("pos", F.trim("cell").alias("cell")))).alias("at"))
    last = F.filter("header", lambda h, i: ~F.exists(F.slice("header", i + 2, F.size("header")), lambda x: x["cell"] == h["cell"]))
    named = F.map_from_entries(F.transform(last, lambda h: F.struct(h["cell"].alias("k"), F.coalesce(F.try_element_at("at", h["pos"]), F.lit("")).alias("v"))))
    return rows.join(header, "path").select("path", "row", named.alias("cells"))


def _open_sheet(book) -> str | None:
    """The part that holds a workbook's active sheet, by its own list; without one, the sheet of the least number."""
    import re
    from xml.etree import ElementTree

    name = lambda e: e.tag.rpartition("}")[2]
    parts = book.namelist()
    if "xl/workbook.xml" in parts and "xl/_rels/workbook.xml.rels" in parts:
        own = list(ElementTree.fromstring(book.read("xl/workbook.xml")).iter())
        listed = [next(v for k, v in e.items() if k.rpartition("}")[2] == "id") for e in own if name(e) == "sheet" and any(k.endswith("}id") for k in e.keys())]
        active = int(next((e.get("activeTab", "0") for e in own if name(e) == "workbookView"), "0"))
        where = {e.get("Id"): e.get("Target", "") for e in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")).iter() if name(e) == "Relationship"}
        if listed:
            target = where.get(listed[active if active < len(listed) else 0], "")
            target = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            if target in parts:
                return target
    sheets = sorted((n for n in parts if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.sub(r"\D", "", n)))
    return sheets[0] if sheets else None


def _sheet(content: bytes):
    """(row, column, text) of the cells of a workbook's open sheet, up to where it is damaged."""
    import io
    import re
    import zipfile
    import zlib
    from xml.etree import ElementTree

    name = lambda e: e.tag.rpartition("}")[2]
    text = lambda e: "".join(t.text or "" for t in e.iter() if name(t) == "t")
    try:
        book = zipfile.ZipFile(io.BytesIO(content))
        sheet = _open_sheet(book)
        strings, row, pos = [], -1, -1
        if "xl/sharedStrings.xml" in book.namelist():
            for _, e in ElementTree.iterparse(book.open("xl/sharedStrings.xml")):
                if name(e) == "si":
                    strings.append(text(e))
                    e.clear()
        for event, e in ElementTree.iterparse(book.open(sheet), events=("start", "end")) if sheet else ():
            if event == "start" and name(e) == "row":
                row, pos = int(e.get("r", row + 2)) - 1, -1
            elif event == "end" and name(e) == "c":
                letters = re.match(r"[A-Z]*", e.get("r", "")).group()
                pos = sum((ord(x) - 64) * 26**k for k, x in enumerate(reversed(letters))) - 1 if letters else pos + 1
                value = next((v.text or "" for v in e if name(v) == "v"), None)
                value = text(e) if e.get("t") == "inlineStr" else strings[int(value)] if e.get("t") == "s" and value else value
                if value:
                    yield row, pos, value
            elif event == "end" and name(e) == "row":
                e.clear()
    except (zipfile.BadZipFile, ElementTree.ParseError, IndexError, KeyError, ValueError, EOFError, zlib.error, NotImplementedError, RuntimeError, OSError, StopIteration):
        return  # what these say of a part that is cut off, names what isn't there, or is packed or locked in a way unknown


def json_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    """One object a line; blank lines are none, and a line that doesn't parse has only _corrupt."""
    full = T.StructType([*(T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields, T.StructField("_corrupt", T.StringType())])
    return spark.read.schema(full).option("columnNameOfCorruptRecord", "_corrupt").json(path)


def last_line(lines: DataFrame, order: str, value: str) -> DataFrame:
    return lines.agg(F.max_by(value, order).alias(value))


def papers_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """path, data, state: whole-file JSON; state is ok or bad_json, never an error."""
    text = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), "value")
    data = F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = text.withColumn("data", data)
    return rows.select("path", "data", F.when(F.col("data").isNull() | F.col("data._corrupt").isNotNull(), "bad_json").otherwise("ok").alias("state"))


def artifacts(spark: SparkSession, path: str) -> DataFrame:
    """path, name, stem, kind, length, modified of every file in a tree; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", F.col("modificationTime").alias("modified"))
    name = F.element_at(F.split("path", "/"), -1)
    kind = F.when(name.endswith(".fulltext.html"), "html").when(name.endswith(".html"), "html").when(name.endswith(".xml"), "xml").when(name.endswith(".pdf"), "pdf").otherwise("other")
    return files.withColumn("name", name).withColumn("stem", stem(F.col("name"))).withColumn("kind", kind)


def doi_column(cells: DataFrame) -> DataFrame:
    """One row: position, has_header. cells(row, pos, cell) of a pasted table, rows from 0; the column with the preferred
    name, else with most DOIs, else the first. Row 0 is a header if no cell of it is a DOI."""
    c = cells.withColumn("is_doi", normalize_doi(F.col("cell")).isNotNull())
    head = c.where("row = 0").agg((~F.coalesce(F.bool_or("is_doi"), F.lit(False))).alias("has_header"))
    per = c.groupBy("pos").agg(F.count_if("is_doi").alias("n"), F.max(F.when(F.col("row") == 0, F.lower(F.trim("cell")))).alias("name")).join(F.broadcast(head))  # head is one row
    position = F.array_position(F.array(*map(F.lit, PREFERRED_COLUMNS)), F.col("name"))
    rank = F.when(F.col("has_header") & (position > 0), position).otherwise(len(PREFERRED_COLUMNS) + 1)
    best = per.agg(F.min_by("pos", F.struct(rank.alias("r"), (-F.col("n")).alias("n"), F.col("pos").alias("p"))).alias("position"), F.first("has_header").alias("has_header"), F.sum("n").alias("n_dois"))
    return best.where("n_dois > 0").select("position", "has_header")


def doi_list(cells: DataFrame) -> DataFrame:
    """doi, row of the chosen column, in order, each once; counts of rows that are no DOI come from ``doi_counts``."""
    chosen = F.broadcast(doi_column(cells))  # one row
    own = cells.join(chosen, cells["pos"] == chosen["position"]).where(~F.col("has_header") | (F.col("row") > 0))
    found = own.select(normalize_doi(F.col("cell")).alias("doi"), "row").where("doi is not null")
    return found.groupBy("doi").agg(F.min("row").alias("row"))


def doi_counts(cells: DataFrame) -> DataFrame:
    """One row: n_rows, n_invalid of the chosen column."""
    chosen = F.broadcast(doi_column(cells))
    own = cells.join(chosen, cells["pos"] == chosen["position"]).where(~F.col("has_header") | (F.col("row") > 0))
    return own.agg(F.count("*").alias("n_rows"), F.count_if((F.trim("cell") != "") & normalize_doi(F.col("cell")).isNull()).alias("n_invalid"))


def _joined(items: Column, one) -> Column:
    return F.array_join(F.transform(items, one), "; ")


def _first(c: Column) -> Column:
    return F.get(c, F.lit(0))


def _source_fields(e: Column) -> dict[str, tuple[str, str, dict[str, Column]]]:
    """Of each source: where a recorded page has its items, their schema, and the candidate's fields of an item e."""
    text = lambda c: F.coalesce(c, F.lit(""))
    person = lambda a: F.trim(F.concat(text(a["given"]), F.lit(" "), text(a["family"])))
    named = F.filter(e["AID"], lambda x: x.endswith("[doi]"))
    works = (
        "results",
        "doi string, title string, abstract_inverted_index map<string, array<int>>, authorships array<struct<author struct<display_name string>>>, primary_location struct<source struct<display_name string>>, publication_year string",
        lambda: {"doi": F.replace(text(e["doi"]), F.lit("https://doi.org/"), F.lit("")), "title": e["title"], "abstract": deinvert(e["abstract_inverted_index"]), "authors": _joined(e["authorships"], lambda a: text(a["author"]["display_name"])), "journal": e["primary_location"]["source"]["display_name"], "year": e["publication_year"]},
    )
    return {
        "pubmed": ("records", "PMID string, AID array<string>, TI string, AB string, AU array<string>, TA string, DP string", lambda: {"pmid": e["PMID"], "doi": F.trim(F.replace(_first(named), F.lit(" [doi]"), F.lit(""))), "title": e["TI"], "abstract": e["AB"], "authors": F.array_join(e["AU"], "; "), "journal": e["TA"], "year": F.left(e["DP"], F.lit(4))}),
        "openalex": works,
        "openalex_broad": works,
        "europepmc": ("resultList.result", "pmid string, doi string, title string, abstractText string, authorString string, journalTitle string, pubYear string", lambda: {"pmid": e["pmid"], "doi": e["doi"], "title": e["title"], "abstract": e["abstractText"], "authors": e["authorString"], "journal": e["journalTitle"], "year": e["pubYear"]}),
        "crossref": ("message.items", "DOI string, title array<string>, abstract string, author array<struct<given string, family string>>, `container-title` array<string>, issued struct<`date-parts` array<array<string>>>", lambda: {"doi": F.lower(e["DOI"]), "title": _first(e["title"]), "abstract": F.trim(strip_tags(e["abstract"])), "authors": _joined(e["author"], person), "journal": _first(e["container-title"]), "year": _first(_first(e["issued"]["date-parts"]))}),
        "osf": ("data", "id string, attributes struct<doi string, title string, description string, date_published string>, relationships struct<provider struct<data struct<id string>>>", lambda: {"doi": F.lower(e["attributes"]["doi"]), "title": e["attributes"]["title"], "abstract": e["attributes"]["description"], "journal": F.coalesce(e["relationships"]["provider"]["data"]["id"], F.lit("osf")), "year": F.left(e["attributes"]["date_published"], F.lit(4))}),
        "semantic_scholar": ("data", "title string, abstract string, authors array<struct<name string>>, year string, venue string, externalIds struct<PubMed string, DOI string>", lambda: {"pmid": e["externalIds"]["PubMed"], "doi": F.lower(e["externalIds"]["DOI"]), "title": e["title"], "abstract": e["abstract"], "authors": _joined(e["authors"], lambda a: text(a["name"])), "journal": e["venue"], "year": e["year"]}),
    }


SEARCH_SOURCES = ["pubmed", "openalex", "openalex_broad", "europepmc", "crossref", "osf", "semantic_scholar"]


def recorded(pages: DataFrame, api: str) -> DataFrame:
    """Candidate rows of the recorded pages(query, body) of one of SEARCH_SOURCES; a body that doesn't parse has none.

    A preprint that two filters of a query find (osf) counts once.
    """
    path, schema, fields = _source_fields(F.col("e"))[api]
    outer = f"array<struct<{schema}>>"
    names = path.split(".")
    for name in reversed(names[1:]):
        outer = f"struct<{name}: {outer}>"
    found = F.from_json("body", f"{names[0]} {outer}")
    for name in names:
        found = found[name]
    items = pages.select("query", F.explode(found).alias("e"))
    if api == "osf":
        items = items.withColumn("_id", F.coalesce("e.id", F.lit(""))).dropDuplicates(["query", "_id"])
    own = fields()
    return items.select(*[F.coalesce(own[f].cast("string"), F.lit("")).alias(f) if f in own else F.lit("").alias(f) for f in CANDIDATE_FIELDS[:-2]], F.lit(api).alias("source_api"), F.col("query").alias("source_query"))


def overlaid(defaults: DataFrame, overlay: DataFrame) -> DataFrame:
    """key, items: an overlay entry replaces the default wholesale."""
    return defaults.select("key", F.col("items").alias("_d")).join(overlay.select("key", F.col("items").alias("_o")), "key", "full").select("key", F.coalesce("_o", "_d").alias("items"))


def fanned_out(lists: DataFrame, apis: DataFrame) -> DataFrame:
    """api, query: every query of the lists(key, items) that apis(api, keys) names, each once."""
    named = apis.select("api", F.explode("keys").alias("key")).join(lists, "key")
    return named.select("api", F.explode("items").alias("query")).distinct()


def published_dois(rows: DataFrame, column: str = "replication_url") -> DataFrame:
    from curata.functions.ids import first_doi

    return rows.select(first_doi(F.col(column)).alias("doi")).where("doi is not null").distinct()


def reference_ladder(*sources: tuple[str, Column], cap: int = 60_000) -> Column:
    """struct(text, source): the first of (name, text) that isn't blank, cut to cap; '' and none otherwise."""
    case = None
    for name, text in sources:
        there = F.trim(F.coalesce(text, F.lit(""))) != ""
        value = F.struct(F.substring(text, 1, cap).alias("text"), F.lit(name).alias("source"))
        case = F.when(there, value) if case is None else case.when(there, value)
    return case.otherwise(F.struct(F.lit("").alias("text"), F.lit("none").alias("source")))


def discovered(folders: DataFrame, readable: DataFrame, include: DataFrame, limit: int) -> DataFrame:
    """The first folders by name that are readable and on the list."""
    return folders.join(readable.select("folder"), "folder", "left_semi").join(include.select("folder"), "folder", "left_semi").orderBy("folder").limit(limit)


def filled(wanted: DataFrame, recorded: DataFrame, key: str, value: str) -> DataFrame:
    """Every wanted key with the recorded value, '' for a miss."""
    return wanted.join(recorded.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit("")))
