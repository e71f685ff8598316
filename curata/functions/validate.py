"""Validation and correction of extracted entries, with messages as an array column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the extraction schema.
RESULTS = ["success", "failure", "inconclusive", "reversal"]
TYPES = ["direct", "close experiment", "close extension", "conceptual"]
CONFIDENCE = ["low", "medium", "high"]
P_TYPES = ["<", "=", ">"]
SCREEN_CONFIDENCE = ["high", "medium", "low"]
SCREEN_TYPES = ["direct", "close", "conceptual", "systematic", "multi-site"]
TYPE_ALIASES = {"close": "close experiment"}
CONFIDENCE_ALIASES = {"moderate": "medium"}
TYPE_COLLAPSE = {"direct or close": "direct_or_close", "close": "close experiment"}
REQUIRED = ["description", "result", "confidence", "discipline", "replication_type"]


def enum(value: Column, valid: list[str], aliases: dict[str, str] | None = None) -> Column:
    """struct(value, message): lower case and aliases resolved; a message where that changed it or it isn't valid."""
    low = F.lower(value)
    alias = F.element_at(F.create_map(*[F.lit(x) for kv in (aliases or {"": ""}).items() for x in kv]), low)
    fixed = F.when(F.coalesce(value, F.lit("")) == "", value).when(alias.isNotNull() & (alias != ""), alias).when(low.isin(valid), low).otherwise(value)
    said = F.when(F.coalesce(value, F.lit("")) == "", None).when(alias.isNotNull() & (alias != ""), F.concat(low, F.lit(" -> "), alias)).when(low.isin(valid) & (value != low), F.concat(value, F.lit(" -> "), low)).when(~low.isin(valid), F.concat(F.lit("not valid: "), value))
    return F.struct(fixed.alias("value"), said.alias("message"))


def statistics_messages(n: Column, p: Column, p_type: Column, es: Column, es_type: Column) -> Column:
    """What is wrong with a row of statistics (string columns; blank is absent)."""
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    n_int, p_num = n.try_cast("double"), p.try_cast("double")
    checks = [
        F.when(some(n) & n_int.isNull(), "n is not a valid integer"),
        F.when(some(n) & (n_int.cast("long") <= 0), "n should be positive"),
        F.when(some(p) & p_num.isNull(), "p is not a valid number"),
        F.when(some(p) & ((p_num < 0) | (p_num > 1)), "p outside [0, 1]"),
        F.when(some(p_type) & ~p_type.isin(P_TYPES), "p type not valid"),
        F.when(some(es) & ~some(es_type), "effect size without type"),
        F.when(some(es_type) & ~some(es), "type without effect size"),
    ]
    return F.array_compact(F.array(*checks))


def envelope_messages(contains: Column, entries: Column) -> Column:
    n = F.coalesce(F.size(entries), F.lit(0))
    yes = F.coalesce(contains, F.lit(False))
    return F.array_compact(F.array(F.when(yes & (n == 0), "contains is true but there are no entries"), F.when(~yes & (n > 0), "contains is false but there are entries")))


def missing(fields: dict[str, Column]) -> Column:
    """Names of the required fields that are blank."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit("")) == "", name) for name, c in fields.items()]))


def verdict(is_replication: Column, confidence: Column, kind: Column) -> Column:
    """struct(is_replication, confidence, replication_type) of a screening verdict, NULL if any value isn't valid."""
    flag, conf, low = F.lower(F.trim(is_replication)), F.lower(F.trim(confidence)), F.lower(F.trim(kind))
    blank = kind.isNull() | kind.isin("", "null")
    ok = flag.isin("true", "false") & conf.isin(SCREEN_CONFIDENCE) & (blank | low.isin(SCREEN_TYPES))
    return F.when(ok, F.struct((flag == "true").alias("is_replication"), conf.alias("confidence"), F.when(~blank, low).alias("replication_type")))


def discipline(value: Column, sub: Column, canonical: Column, parent: Column, parent_sub: Column) -> Column:
    """struct(discipline, subdiscipline, message), given the canonical discipline of the value and, if it is a
    subdiscipline, its parent and canonical form (left-joined from the ontology)."""
    other = F.coalesce(F.lower(value), F.lit("")).isin("", "other")
    fixed = F.when(other, value).when(canonical.isNotNull(), canonical).when(parent.isNotNull(), parent).otherwise(value)
    low_sub = F.when(~other & canonical.isNull() & parent.isNotNull() & (F.coalesce(sub, F.lit("")) == ""), parent_sub).otherwise(sub)
    said = F.when(other, None).when(canonical.isNotNull() & (canonical != value), F.concat(value, F.lit(" -> "), canonical)).when(canonical.isNull() & parent.isNotNull(), F.concat(value, F.lit(" -> "), parent, F.lit(" (was subdiscipline)"))).when(canonical.isNull(), F.concat(F.lit("not in list: "), value))
    return F.struct(fixed.alias("discipline"), low_sub.alias("subdiscipline"), said.alias("message"))


def primary_key(tokens: Column) -> Column:
    """The key with the most tokens of a map<string, number>; the first of equals."""
    entries = F.transform(F.map_entries(tokens), lambda e, i: F.struct(e["value"].alias("n"), (-i).alias("i"), e["key"].alias("k")))
    return F.array_max(entries)["k"]
