"""Text: titles, names, markup, legibility and similarity. Native Columns but for the Arrow UDFs at the end."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of disciplines by group, and words that say nothing about a claim.
DISCIPLINE_GROUPS = {
    "psych": ["psychology"],
    "biomed": ["medical fields", "neuroscience", "biology", "microbiology", "sports and exercise science", "biochemistry", "genetics"],
    "socsci": ["economics", "political science", "business & management", "sociology", "criminology", "public administration", "anthropology"],
    "lang_edu": ["linguistics", "education", "computer science education"],
}
CLAIM_STOP_WORDS = ["the", "a", "an", "of", "in", "to", "and", "with", "for", "on", "is", "was", "were", "that", "this", "replication", "replicating", "effect", "study", "experiment", "original", "claim", "claimed", "reported", "found", "showed", "tested", "replicated", "authors", "et", "al"]
# What errors of a limited service say.
USAGE_LIMIT_SIGNS = ["usage limit", "rate limit", "quota exceeded", "too many requests", "overloaded_error", "usage_limit_reached", "claude code session", "429"]
CLAIM_FRAME = r"^.{0,80}?\b(?:claimed|claims|reported|found|showed|demonstrated|proposed|argued|suggested)\s+that\s+"
STUDY_NUMBER = r"\b(?:study|experiment|exp\.?)\s*(\d+[a-z]?)\b"


def _udf(returns: str):
    """An Arrow UDF made where it is used, so that workers can import this module without a session."""
    def wrap(fn):
        def call(*columns):
            return F.pandas_udf(fn, returns)(*columns)

        call.__doc__, call.__name__ = fn.__doc__, fn.__name__
        return call

    return wrap


def norm(c: Column) -> Column:
    """Trimmed lower case; NULL and nan are empty."""
    low = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(low == "nan", "").otherwise(low)


def normalize_title(c: Column) -> Column:
    """Lower case, signs other than letters, digits and _ to blanks, blanks collapsed."""
    s = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}_\s]", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def deinvert(inverted: Column) -> Column:
    """The text of an inverted index map<word, array<position>>."""
    pairs = F.flatten(F.transform(F.map_entries(inverted), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.array_join(F.transform(F.array_sort(pairs), lambda x: x["w"]), " ")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def to_float(c: Column) -> Column:
    return F.when(~F.lower(F.trim(c)).isin("", "nan"), F.trim(c).try_cast("double"))


def year_bucket(c: Column) -> Column:
    v = to_float(c)
    return F.when(v.isNull(), "unknown").when(v <= 2018, "<=2018").when(v <= 2022, "2019-2022").otherwise("2023+")


def discipline_group(c: Column) -> Column:
    d, out = norm(c), None
    for group, members in DISCIPLINE_GROUPS.items():
        out = F.when(d.isin(members), group) if out is None else out.when(d.isin(members), group)
    return out.when(d != "", "other").otherwise("unknown")


def last_names(c: Column) -> Column:
    """Sorted distinct last names of a ;-joined string in either order ("Last, First" or "First Last")."""
    names = F.transform(F.split(norm(c), ";"), lambda a: F.trim(a))

    def one(a):
        tail = F.regexp_extract(a, r"(\S+)$", 1)
        return F.when(a.contains(","), F.trim(F.split_part(a, F.lit(","), F.lit(1)))).when(F.length(tail) > 1, tail).otherwise("")

    return F.array_sort(F.array_distinct(F.filter(F.transform(names, one), lambda n: n != "")))


def overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct values; 0 if one is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / F.size(F.array_union(a, b)))


def authors_match(a: Column, b: Column, threshold: float = 0.7) -> Column:
    return overlap(last_names(a), last_names(b)) >= threshold


def year_match(a: Column, b: Column) -> Column:
    one, two = (F.trim(F.replace(F.coalesce(x.cast("string"), F.lit("")), F.lit(".0"), F.lit(""))) for x in (a, b))
    return (one != "") & (one == two)


def metadata_valid(fetched: dict[str, Column], expected: dict[str, Column]) -> Column:
    """Year must be equal and journals contain one another where both are known; a volume may help; one must agree."""
    def text(c):
        return F.trim(F.coalesce(c.cast("string"), F.lit("")))

    fy, ey, fv, ev = text(fetched["year"]), text(expected["year"]), text(fetched["volume"]), text(expected["volume"])
    fj, ej = F.lower(text(fetched["journal"])), F.lower(text(expected["journal"]))
    year_bad = (ey != "") & (fy != "") & (fy != ey)
    near = fj.contains(ej) | ej.contains(fj)
    journal_bad = (ej != "") & (fj != "") & ~near
    passed = ((ey != "") & (fy == ey)) | ((ej != "") & (fj != "") & near) | ((ev != "") & (fv == ev))
    asked = (ey != "") | (ej != "") | (ev != "")
    return ~year_bad & ~journal_bad & (passed | ~asked)


def format_initials(c: Column) -> Column:
    """A full stop behind single letters, in each name of a ;-joined string."""
    def name(n):
        return F.array_join(F.transform(F.split(F.trim(n), r"\s+"), lambda w: F.when(w.rlike(r"^\p{L}$"), F.concat(w, F.lit("."))).otherwise(w)), " ")

    return F.array_join(F.transform(F.split(c, ";"), name), "; ")


def _is_initial(token: Column) -> Column:
    bare = F.replace(token, F.lit("."), F.lit(""))
    return (bare == "") | F.when(token.contains("."), bare.rlike(r"^\p{Lu}{1,3}$")).otherwise(bare.rlike(r"^\p{Lu}$"))


def full_first_names(c: Column) -> Column:
    """struct(n_full, n): authors with an unabbreviated first name, and all."""
    names = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda a: F.trim(a)), lambda a: a != "")

    def full(a):
        tokens = F.filter(F.split(a, r"\s+"), lambda t: t != "")
        first, last = F.get(tokens, F.lit(0)), F.element_at(tokens, -1)
        given = F.regexp_extract(F.trim(F.regexp_extract(a, "^[^,]*,(.*)$", 1)), r"^(\S*)", 1)
        surname_first = (F.size(tokens) >= 2) & ~_is_initial(first) & _is_initial(last)
        token = F.when(a.contains(","), given).when(surname_first, last).otherwise(first)
        return (token != "") & ~_is_initial(token)

    return F.struct(F.size(F.filter(names, full)).alias("n_full"), F.size(names).alias("n"))


def better_authors(current: Column, new: Column) -> Column:
    """Whether new has more full first names without losing too many authors."""
    blank = lambda c: c.isNull() | c.isin("", "NaN")
    a, b = full_first_names(current), full_first_names(new)
    fewer = b["n"] < a["n"] * 0.7
    poor = (b["n"] < a["n"] * 0.5) | (b["n_full"] / F.greatest(b["n"], F.lit(1)) < 0.9)
    return F.when(blank(new), False).when(blank(current), True).when((b["n"] == 0) | (fewer & poor), False).otherwise(b["n_full"] > a["n_full"])


def full_title(main: Column, subtitle: Column) -> Column:
    main, subtitle = F.coalesce(main, F.lit("")), F.coalesce(subtitle, F.lit(""))
    return F.when((subtitle != "") & ~F.lower(main).contains(F.lower(subtitle)), F.concat(F.regexp_replace(main, "[: ]+$", ""), F.lit(": "), subtitle)).otherwise(main)


def claim_tokens(c: Column) -> Column:
    """Words of a claim's description, without its framing and stop words."""
    x = F.regexp_replace(norm(c), CLAIM_FRAME, "")
    return F.array_sort(F.array_except(F.array_distinct(F.regexp_extract_all(x, F.lit("([a-z0-9]+)"))), F.array(*map(F.lit, CLAIM_STOP_WORDS))))


def claim_parts(c: Column) -> Column:
    """struct(words, studies, blank): what claim_dice compares. A column of its own side, so that it is made once, before pairs are."""
    return F.struct(claim_tokens(c).alias("words"), _studies(c).alias("studies"), (norm(c) == "").alias("blank"))


def dice_of_parts(a: Column, b: Column) -> Column:
    """claim_dice of two columns of ``claim_parts``."""
    ta, tb, sa, sb = a["words"], b["words"], a["studies"], b["studies"]
    dice = F.when((F.size(ta) > 0) & (F.size(tb) > 0), 2 * F.size(F.array_intersect(ta, tb)) / (F.size(ta) + F.size(tb))).otherwise(0.0)
    return F.when(~a["blank"] & ~b["blank"] & ((F.size(sa) == 0) | (F.size(sb) == 0) | (sa == sb)), dice).otherwise(0.0)


def claim_dice(a: Column, b: Column) -> Column:
    """Dice similarity of claim words; 0 if blank, or if both name studies but different ones."""
    ta, tb = claim_tokens(a), claim_tokens(b)
    dice = F.when((F.size(ta) > 0) & (F.size(tb) > 0), 2 * F.size(F.array_intersect(ta, tb)) / (F.size(ta) + F.size(tb))).otherwise(0.0)
    return F.when(_comparable(a, b), dice).otherwise(0.0)


def effect_similarity(a: Column, b: Column) -> Column:
    """The larger of claim_dice and difflib's ratio of the descriptions without their framing; 0 where claim_dice must be."""
    x, y = (F.regexp_replace(norm(c), CLAIM_FRAME, "") for c in (a, b))
    return F.when(_comparable(a, b), F.greatest(claim_dice(a, b), string_ratio(x, y))).otherwise(0.0)


def could_be_alike(a: Column, b: Column, threshold: float) -> Column:
    """Whether effect_similarity may reach the threshold: native."""
    x, y = (F.regexp_replace(norm(c), CLAIM_FRAME, "") for c in (a, b))
    return _comparable(a, b) & ((claim_dice(a, b) >= threshold) | could_reach(x, y, threshold))


def _studies(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(norm(c), F.lit(STUDY_NUMBER))))


def _comparable(a: Column, b: Column) -> Column:
    """Neither is blank, and they don't name different studies."""
    sa, sb = _studies(a), _studies(b)
    return (norm(a) != "") & (norm(b) != "") & ((F.size(sa) == 0) | (F.size(sb) == 0) | (sa == sb))


def lines(c: Column) -> Column:
    return F.transform(F.split(c, "\n"), lambda x: F.trim(x))


def prose_score(c: Column) -> Column:
    """Median length of the lines that aren't blank, headings, quotes, tables or markup."""
    sizes = F.array_sort(F.transform(F.filter(lines(c), lambda x: (x != "") & ~x.rlike("^[#>|<]")), lambda x: F.length(x)))
    n = F.size(sizes)
    mid = F.floor((n + 1) / 2).cast("int")
    return F.when(n == 0, 0.0).otherwise((F.get(sizes, mid - 1) + F.get(sizes, F.floor(n / 2).cast("int"))) / 2.0)


def legible_share(c: Column) -> Column:
    """Share of lines above 15 characters with enough vowels and word-shaped tokens; 0 without such lines."""
    rows = F.filter(F.split(c, "\n"), lambda x: F.length(F.trim(x)) > 15)

    def good(x):
        letters = F.length(F.regexp_replace(x, r"[^\p{L}]", ""))
        vowels = F.length(F.regexp_replace(x, "[^aeiouAEIOU]", ""))
        words = F.size(F.filter(F.split(F.trim(x), r"\s+"), lambda w: w.rlike("^[A-Za-z][A-Za-z'.-]{2,}$")))
        return (letters > 0) & (vowels / F.greatest(letters, F.lit(1)) >= 0.22) & (words >= 3)

    return F.when(F.size(rows) == 0, 0.0).otherwise(F.size(F.filter(rows, good)) / F.size(rows))


def without_unreadable_references(c: Column) -> Column:
    """Replaces a reference section that isn't legible by a note; all else stays.

    The section ends at the next line that is a header in brackets; where it is the last one, a last paragraph of
    less than 200 characters is not part of it (it is the instruction that ends a request).
    """
    header = r"(?m)^\[REFERENCE LIST: [^\]\n]*\]$"
    at = F.regexp_instr(c, F.lit(header))
    head = F.left(c, at - 1)
    rest = F.substr(c, at + F.length(F.regexp_substr(c, F.lit(header))))
    following = F.regexp_instr(rest, F.lit(r"(?m)^\[[A-Z][^\]]*\]$"))
    last = F.element_at(F.split(rest, "\n\n"), -1)
    short = rest.contains("\n\n") & (F.length(_stripped(last)) < 200)
    tail = F.when(following > 0, F.substr(rest, following)).when(short, last).otherwise("")
    block = F.when(following > 0, F.left(rest, following - 1)).when(short, F.left(rest, F.length(rest) - F.length(last) - 2)).otherwise(rest)
    note = F.lit("[REFERENCE LIST: none]\nThe reference list could not be read and is withheld.\n\n")
    return F.when((at > 0) & (legible_share(block) < 0.5), F.concat(head, note, tail)).otherwise(c)


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def truncate_middle(c: Column, budget: int) -> Column:
    """Head 55 % and tail of the budget, with a mark between that names what was left out."""
    head = int(budget * 0.55)
    omitted = F.length(c) - budget
    mark = F.concat(F.lit("\n\n[... "), F.format_number(omitted, 0), F.lit(" characters omitted from the middle of the full text ...]\n\n"))
    return F.when(F.length(c) <= budget, c).otherwise(F.concat(F.left(c, F.lit(head)), mark, F.right(c, F.lit(budget - head))))


def assembled(doi: Column, abstract: Column, body: Column, references: Column, source: Column, budget: int, least: int = 20_000) -> Column:
    """Sections of a request, the body cut to what the budget leaves (at least ``least``)."""
    intro, title = F.lit("Extract replication data from the paper below."), F.concat(F.lit("[PAPER DOI]\n"), doi)
    about = F.when(F.trim(abstract) != "", F.concat(F.lit("[ABSTRACT]\n"), F.trim(abstract)))
    reserved = F.length(intro) + F.length(title) + F.coalesce(F.length(about), F.lit(0)) + F.length(references) + 400
    room = F.greatest(F.lit(least), budget - reserved)
    head = (room * 0.55).cast("int")
    text = F.trim(body)
    cut = F.when(F.length(text) <= room, text).otherwise(F.concat(F.left(text, head), F.lit("\n\n[... "), F.format_number(F.length(text) - room, 0), F.lit(" characters omitted from the middle of the full text ...]\n\n"), F.right(text, room - head)))
    refs = F.when(references != "", F.concat(F.lit("[REFERENCE LIST: "), source, F.lit("]\n"), references)).otherwise(F.lit("[REFERENCE LIST: none]"))
    return F.concat_ws("\n\n", intro, title, about, F.concat(F.lit("[FULL TEXT]\n"), cut), refs, F.lit("Reply with the JSON object only."))


def rendered_references(refs: Column, cap: int = 300) -> Column:
    """One numbered line for each struct(id, raw, authors, year, title, journal, volume, issue, pages, doi), cap at most."""
    def text(r):
        where = F.concat(r["journal"], F.when(F.coalesce(r["volume"], F.lit("")) != "", F.concat(F.lit(" "), r["volume"])).otherwise(""), F.when(F.coalesce(r["issue"], F.lit("")) != "", F.concat(F.lit("("), r["issue"], F.lit(")"))).otherwise(""), F.when(F.coalesce(r["pages"], F.lit("")) != "", F.concat(F.lit(": "), r["pages"])).otherwise(""), F.lit("."))
        some = lambda c, x: F.when(F.coalesce(c, F.lit("")) != "", x)
        made = F.trim(F.concat_ws(" ", some(F.array_join(r["authors"], "; "), F.array_join(r["authors"], "; ")), some(r["year"], F.concat(F.lit("("), r["year"], F.lit(")"))), some(F.trim(r["title"]), F.concat(F.regexp_replace(F.trim(r["title"]), r"\.+$", ""), F.lit("."))), some(r["journal"], where), some(r["doi"], F.concat(F.lit("doi:"), r["doi"]))))
        return F.coalesce(F.when(F.trim(r["raw"]) != "", F.trim(r["raw"])), made)

    rows = F.slice(F.filter(F.transform(refs, lambda r: F.struct(r["id"].alias("id"), text(r).alias("t"))), lambda r: r["t"] != ""), 1, cap)
    return F.array_join(F.transform(rows, lambda r, i: F.concat(F.lit("["), F.coalesce(r["id"].cast("string"), (i + 1).cast("string")), F.lit("] "), r["t"])), "\n")


def bibliography_text(c: Column) -> Column:
    """The lines of an XML reference list, one an entry, without tags; lines of up to three characters go."""
    part = F.regexp_extract(c, r"(?is)(<(?:ref-list|ce:bibliography|bibliography)\b.*?)(?:</(?:ref-list|ce:bibliography|bibliography)>|\z)", 1)
    part = F.regexp_replace(part, r"(?i)</(ref|ce:bib-reference|sb:reference)>", "\n")
    part = F.regexp_replace(part, "<[^>]+>", " ")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        part = F.replace(part, F.lit(entity), F.lit(sign))
    rows = F.transform(F.split(part, "\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    return F.array_join(F.filter(rows, lambda x: F.length(x) > 3), "\n")


def from_heading(c: Column, heading: str, n: int) -> Column:
    """Up to n characters from the first line that begins with the heading, else the last n."""
    at = F.regexp_instr(c, F.lit(f"(?im)^#*\\s*(?:{heading})"))
    return F.when(at > 0, F.substr(c, at, F.lit(n))).otherwise(F.right(c, F.lit(n)))


def unwrapped_article(c: Column) -> Column:
    """The one article within an article set that the first 2000 characters announce; any other text as it is."""
    start = F.instr(c, "<article")
    end = F.length(c) - F.instr(F.reverse(c), ">elcitra/<") + 1
    wrapped = F.left(c, F.lit(2000)).contains("<pmc-articleset") & (start > 0) & c.contains("</article>")
    return F.when(wrapped, F.concat(F.lit('<?xml version="1.0"?>'), F.substr(c, start, end - start + 1))).otherwise(c)


def usage_limited(c: Column) -> Column:
    """Whether an error tells of a usage limit: one of its signs, or nothing after the first colon at a line's end."""
    low = F.lower(c)
    body = F.when(c.contains(":\n"), F.substr(c, F.instr(c, ":\n") + 2)).otherwise(c)
    return F.greatest(*[low.contains(x) for x in USAGE_LIMIT_SIGNS]) | (_stripped(body) == "")


def title_prefix(a: Column, b: Column) -> Column:
    """Whether one title is the beginning of the other."""
    x, y = norm(a), norm(b)
    return (x != "") & (y != "") & (x.startswith(y) | y.startswith(x))


def collapsed_result(result: Column, has_reversal_class: Column) -> Column:
    """A reversal counts as a failure where the truth has no such class."""
    low = norm(result)
    return F.when(~has_reversal_class & (low == "reversal"), "failure").otherwise(low)


def filled_template(template: str, values: dict[str, Column]) -> Column:
    """A template with {name} for each value, {{ and }} for braces; NULL values are empty."""
    import string

    parts = []
    for literal, name, *_ in string.Formatter().parse(template):
        parts.append(F.lit(literal))
        if name is not None:
            parts.append(F.coalesce(values[name].cast("string"), F.lit("")))
    return F.concat(*parts)


# Lines that open and close a block of a template.
MODE_OPEN, MODE_CLOSE = r"^\s*<!--\s*mode:([a-z_]+)\s*-->\s*$", r"^\s*<!--\s*/mode\s*-->\s*$"


def mode_blocks(template: Column, tags: list[str]) -> Column:
    """struct(text, error): the template without its marker lines and without blocks of other modes than tags.

    A fold over its lines, with the block that is open as its state; error (and no text) where a block opens within
    another, closes without one, or doesn't close. With the tag core, commas before a closing brace on a line of its own go.
    """
    lines = F.split(template, "(?<=\n)")
    text = F.lit("").cast("string")
    start = F.struct(text.alias("open"), text.alias("text"), F.lit(None).cast("string").alias("error"))

    def step(s, line):
        mode = F.regexp_extract(line, MODE_OPEN, 1)
        closes = line.rlike(MODE_CLOSE)
        error = F.when((mode != "") & (s["open"] != ""), F.concat(F.lit("mode:"), mode, F.lit(" opens inside mode:"), s["open"])).when(closes & (s["open"] == ""), "a block closes that is not open")
        kept = (mode == "") & ~closes & ((s["open"] == "") | s["open"].isin(tags))
        opened = F.when(mode != "", mode).when(closes, "").otherwise(s["open"])
        return F.struct(opened.alias("open"), F.concat(s["text"], F.when(kept, line).otherwise("")).alias("text"), F.coalesce(s["error"], error).alias("error"))

    def finish(s):
        error = F.coalesce(s["error"], F.when(s["open"] != "", F.concat(F.lit("mode:"), s["open"], F.lit(" is not closed"))))
        whole = F.regexp_replace(s["text"], r",([ \t]*\n[ \t]*\})", "$1") if "core" in tags else s["text"]
        return F.struct(F.when(error.isNull(), whole).alias("text"), error.alias("error"))

    return F.aggregate(lines, start, step, finish)


def source_bucket(validated_person: Column, source: Column, ai_version: Column) -> Column:
    person, origin = F.lower(F.coalesce(validated_person, F.lit(""))), F.lower(F.coalesce(source, F.lit("")))
    return (
        F.when(person.contains("fred"), "fred").when(person.contains("curate science") | origin.contains("curate science"), "curate_science").when(person.contains("replication wiki"), "repwiki_ai")
        .when(origin.contains("score"), "darpa_score").when(F.trim(person) != "", "manual_other").when(F.trim(F.coalesce(ai_version, F.lit(""))) != "", "ai_pipeline").otherwise("unattributed")
    )


def reference_supports(blob: Column, names: Column, year: Column) -> Column:
    """Whether a (folded) reference entry has the year and any of the (folded) names."""
    return (blob != "") & ((F.coalesce(year, F.lit("")) == "") | blob.contains(year)) & F.exists(names, lambda n: blob.contains(n))


def citation_mentions(sentence: Column, authors: Column, year: Column) -> Column:
    """struct(author_found, year_found) for a citing sentence."""
    low = F.lower(sentence)
    return F.struct(F.exists(last_names(authors), lambda n: low.contains(n)).alias("author_found"), ((F.coalesce(year, F.lit("")) != "") & sentence.contains(year)).alias("year_found"))


def _fold(s: pd.Series) -> pd.Series:
    """Lower case without diacritics."""
    import unicodedata

    return s.map(lambda t: "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c)) if t is not None else None)


def _string_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """difflib's ratio of two normalised strings, 0 if one is blank; repeated pairs are computed once a batch."""
    from difflib import SequenceMatcher

    def clean(s):
        s = (s or "").lower().strip()
        return "" if s == "nan" else s

    known: dict = {}

    def ratio(x, y):
        if not x or not y:
            return 0.0
        if (x, y) not in known:
            known[x, y] = 1.0 if x == y else SequenceMatcher(None, x, y).ratio()
        return known[x, y]

    return pd.Series([ratio(clean(x), clean(y)) for x, y in zip(a, b, strict=True)], dtype=float)


def _string_ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    """string_ratio of the texts of two arrays at equal places."""
    import itertools

    import numpy as np

    flat = _string_ratio(*(list(itertools.chain.from_iterable(x)) for x in (a, b)))
    return pd.Series(np.split(flat.to_numpy(), np.cumsum([len(x) for x in a])[:-1])) if len(a) else pd.Series(dtype=object)


def ratio_length(c) -> Column:
    """The length of what string_ratio compares of a text."""
    return F.length(F.lower(_stripped(_column(c))))


def could_reach(a: Column, b: Column, threshold: float) -> Column:
    """The ratio's upper bound by the lengths of what it compares: native, so it can stand before the UDF."""
    la, lb = ratio_length(a), ratio_length(b)
    return 2 * F.least(la, lb) / F.greatest(la + lb, F.lit(1)) >= threshold


# Groups of characters, each counted as one kind: common letters alone, the rest together.
_KINDS = ["e", "t", "a", "o", "i", "n", "s", "r", "h", "l", "d", "u", "c", "m", "0123456789", " "]


def letters(c) -> Column:
    """How often each kind of character stands in what string_ratio compares: a side's own column, made before pairs are."""
    s = F.lower(_stripped(_column(c)))
    return F.array(*[F.length(s) - F.length(F.translate(s, k, "")) for k in _KINDS], F.length(F.translate(s, "".join(_KINDS), "")))


def letters_could_reach(a: Column, b: Column, threshold: float) -> Column:
    """The ratio's upper bound by the characters in common, whatever their order; a and b: of ``letters``. Native, and tighter than lengths."""
    k = range(len(_KINDS) + 1)
    total = lambda x: sum((F.get(x, F.lit(i)) for i in k), F.lit(0))
    both = sum((F.least(F.get(a, F.lit(i)), F.get(b, F.lit(i))) for i in k), F.lit(0))
    return 2 * both / F.greatest(total(a) + total(b), F.lit(1)) >= threshold


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_similarity(threshold: float = 0.9):
    """UDF(query, found): ratio at or above the threshold, or a main title in common (then the threshold at least), else 0."""
    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        import html
        import re
        import unicodedata
        from difflib import SequenceMatcher

        def clean(t):
            return re.sub(r"\s+", " ", unicodedata.normalize("NFKD", html.unescape(t or ""))).strip().lower()

        def one(x, y):
            x, y = clean(x), clean(y)
            if not x or not y:
                return 0.0
            score = SequenceMatcher(None, x, y).ratio()
            if score >= threshold:
                return score
            mx, my = (t.partition(":")[0].strip() for t in (x, y))
            same_main = len(mx) >= 10 and (mx == my or len(my) >= 10 and (x == my or y == mx))
            return max(score, threshold) if same_main else 0.0

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype=float)

    return run


def _parsed_reply(s: pd.Series) -> pd.Series:
    """The JSON object in a reply - fenced, in prose or a bare list, which is wrapped - as canonical text; NULL if none."""
    import json
    import re

    def one(text):
        if not text:
            return None
        body = text.strip()
        if body.startswith("```"):
            body = body.partition("\n")[2].rpartition("```")[0].strip() or body.partition("\n")[2].strip()
        greedy = re.search(r"\{.*\}", body, re.DOTALL)
        for attempt in (lambda: json.loads(body), lambda: json.JSONDecoder().raw_decode(body[body.index("{") :])[0], lambda: json.loads(greedy.group())):
            try:
                value = attempt()
            except (ValueError, AttributeError):
                continue
            if isinstance(value, list):
                value = {"contains_replications": bool(value), "replications": value}
            return json.dumps(value, sort_keys=True) if isinstance(value, dict) else None
        return None

    return s.map(one)


def _splice_tables(markdown: pd.Series, html_tables: pd.Series) -> pd.Series:
    """Each pipe table replaced by the HTML table (JSON list) of the same rank, if there are as many."""
    import json
    import re

    table = re.compile(r"(?:^\|[^\n]*\|[ \t]*(?:\n|\Z)){2,}", re.MULTILINE)

    def one(text, tables):
        new = json.loads(tables or "[]")
        if text is None or len(table.findall(text)) != len(new):
            return text
        rest = iter(new)
        return table.sub(lambda _: next(rest) + "\n", text)

    return pd.Series([one(x, y) for x, y in zip(markdown, html_tables, strict=True)], dtype=object)


def _inverted(s: pd.Series) -> pd.Series:
    """The places of each word (from 0, by white space) of a text."""
    def one(t):
        if t is None:
            return None
        places: dict = {}
        for i, w in enumerate(t.split()):
            places.setdefault(w, []).append(i)
        return places

    return s.map(one)


inverted = _udf("map<string, array<int>>")(_inverted)
fold = _udf("string")(_fold)
string_ratio = _udf("double")(_string_ratio)
string_ratios = _udf("array<double>")(_string_ratios)
parsed_reply = _udf("string")(_parsed_reply)
splice_tables = _udf("string")(_splice_tables)
