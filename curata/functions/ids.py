"""Identifiers: DOIs, folder names, slugs, splits and content-derived ids. Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the identifier formats.
DOI = r"10\.\d{4,9}/\S+"
FORBIDDEN = ["<", ">", '"', "\\", "|", "?", "*"]
TRAILING = list(".,;>\"'/")
CLOSERS = {")": "(", "]": "[", "}": "{"}
SPLIT_TEST_SHARE = 0.6
# Suffixes of files beside a paper, longest first.
STEM_SUFFIXES = ["_from_html.md", "_from_xml.md", ".fulltext.html", ".html", ".xml", ".pdf"]


def _times(c: Column, what: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(what), F.lit("")))


def normalize_doi(c: Column) -> Column:
    """Lower case, without a resolver prefix and without trailing punctuation or unbalanced closers; NULL if not a DOI."""
    v = F.regexp_replace(F.lower(F.trim(c)), r"^https?://(dx\.)?doi\.org/", "")
    full = lambda x: x.rlike(f"^{DOI}$")

    def shorter(acc, _):
        last = F.right(acc, F.lit(1))
        drop = last.isin(*TRAILING)
        for closer, opener in CLOSERS.items():
            drop = drop | ((last == closer) & (_times(acc, closer) > _times(acc, opener)))
        return F.when(drop, F.left(acc, F.length(acc) - 1)).otherwise(acc)

    # as many steps as the value has characters that could go at all
    could = F.length(F.regexp_extract(v, r"([.,;>\"'/)\]}]*)$", 1))
    cut = F.aggregate(F.sequence(F.lit(0), could), v, shorter)
    return F.when(full(v) & full(cut), cut)


def doi_to_folder(c: Column) -> Column:
    """A reversible file-system name: / is --, : is ~, forbidden signs and ambiguous hyphens are ~hex~."""
    s = F.regexp_replace(F.trim(c), r"-(?=[-/])|(?<=[-/])-", "~2d~")
    s = F.replace(s, F.lit("/"), F.lit("--"))
    for sign in FORBIDDEN:
        s = F.replace(s, F.lit(sign), F.lit(f"~{ord(sign):02x}~"))
    return F.replace(s, F.lit(":"), F.lit("~"))


def folder_to_doi(c: Column) -> Column:
    """The inverse, after dropping a copy suffix such as " (1)"."""
    s = F.regexp_replace(F.trim(c), r"\s*\(\d+\)$", "")
    s = F.replace(s, F.lit("~2d~"), F.lit("\x00"))
    for sign in FORBIDDEN:
        s = F.replace(s, F.lit(f"~{ord(sign):02x}~"), F.lit(sign))
    for old, new in (("~", ":"), ("--", "/"), ("\x00", "-")):
        s = F.replace(s, F.lit(old), F.lit(new))
    return s


def is_doi_folder(c: Column) -> Column:
    return F.regexp_replace(c, r"\s*\(\d+\)$", "").rlike(r"^10\.\d+--")


def round_trips(c: Column) -> Column:
    """Whether encoding the decoded name gives the name back."""
    return doi_to_folder(folder_to_doi(c)) == c


def doi_url(c: Column) -> Column:
    """A resolver address in lower case, with the one host and scheme."""
    return F.regexp_replace(F.lower(F.trim(c)), r"https?://(dx\.)?doi\.org/", "https://doi.org/")


def bare_doi(c: Column) -> Column:
    """What follows the resolver in an address; NULL where there is none."""
    found = F.regexp_extract(F.trim(c), r"^https?://(?:dx\.)?doi\.org/(10\..+)", 1)
    return F.when(found != "", found)


def alnum_key(c: Column) -> Column:
    """Punctuation-blind key."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def first_doi(c: Column) -> Column:
    """The first DOI in free text, normalised."""
    found = F.regexp_extract(c, "(" + DOI + ")", 1)
    return normalize_doi(F.when(found != "", found))


def slugify(c: Column) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9_-]+", "-"), "^-+|-+$", ""), 1, 64)


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of SHA-256 over the parts, joined by a colon."""
    return F.conv(F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def split_of(doi: Column, salt: str, share: float = SPLIT_TEST_SHARE) -> Column:
    return F.when(unit_hash(F.lit(salt), doi) < share, "test").otherwise("dev")


def content_id(*parts: Column) -> Column:
    """First ten hex digits of SHA-1 over the parts, joined by the unit separator; NULL counts as empty."""
    return F.substring(F.sha1(F.concat_ws("\x1f", *[F.coalesce(p, F.lit("")) for p in parts])), 1, 10)


def stem(c: Column) -> Column:
    """A file name without the longest known suffix."""
    out = c
    for suffix in reversed(STEM_SUFFIXES):
        out = F.when(c.endswith(suffix), F.left(c, F.length(c) - len(suffix))).otherwise(out)
    return out


def near_doi(a: Column, b: Column) -> Column:
    """One is the other with up to three characters cut off its end."""
    short = F.when((F.length(a) < F.length(b)) | ((F.length(a) == F.length(b)) & (a <= b)), a).otherwise(b)
    long = F.when((F.length(a) < F.length(b)) | ((F.length(a) == F.length(b)) & (a <= b)), b).otherwise(a)
    return (F.length(short) >= 12) & long.startswith(short) & (F.length(long) - F.length(short) <= 3)
