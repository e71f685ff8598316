"""Ordered rules as data: the first that applies decides. Compiled into one CASE expression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the default screening rules (Java regular expressions, case ignored).
GATE = r"\breplicat|\breproducib"
STRONG = [
    r"\breplicat\w*\s+stud(?:y|ies)\b",
    r"\breplicat\w*\s+(?:the|a|an|this|these|those|prior|previous|original|earlier)\s+(?:stud|finding|result|experiment|effect|observation)",
    r"\breplications?\s+and\s+extensions?\b",
    r"\breplication\s+and\s+(?:validation|cross[\s-]validation|adaptation)\b",
    r"\breplicat\w*\s+report\b",
    r"\breplicat\w*\s+and\s+adapt\w*\b",
    r"\bfailures?\s+to\s+replicat",
    r"\bnon[\s-]replication\b",
    r"\b(?:constructive|approximate|conceptual|systematic|large[\s-]scale|cross[\s-]cultural|cross[\s-]cent(?:er|re)|transethnic|preregistered|pre[\s-]registered|independent|successful|partial|attempted)\s+replicat",
    r"\breplicat\w+\s+and\s+extend\w*\b",
    r"\breproduc\w+\s+the\s+results?\b",
    r"\bfailed?\s+to\s+replicat",
    r"\bfailure\s+to\s+replicat",
    r"\bdirect\s+replicat",
    r"\bexact\s+replicat",
    r"\bclose\s+replicat",
    r"\bconceptual\s+replicat",
    r"\bsystematic\s+replicat",
    r"\breplicat\w*\s+attempt",
    r"\battempt\w*\s+to\s+replicat",
    r"\bregistered\s+replicat",
    r"\bmulti[\s-]?site\s+replicat",
    r"\bmultisite\s+replicat",
    r"\bwe\s+replicat\w+\b",
    r"\bfailed?\s+to\s+reproduc",
    r"\bcould\s+not\s+reproduc",
    r"\boriginal\s+(?:study|finding|result|experiment|author)",
    r"\breplicat\w+\s+(?:across|in)\s+(?:a\s+)?(?:new|different|independent|another)\b",
    r"\breplicat\w*\s+crisis",
    r"\breproducibility\s+crisis",
    r"\breproducibility\s+project",
    r"\breplication\s+cohort",
    r"\breplication\s+sample",
    r"\breplication\s+dataset",
    r"\bdiscovery\s+and\s+replication",
    r"\breplicat\w*\s+the\s+association",
    r"\bassociation\s+was\s+replicat",
    r"\breplicat\w*\s+(?:in|across)\s+(?:an?\s+)?independent\s+(?:cohort|sample|population|dataset)",
    r"\btwo[\s-]stage\s+(?:gwas|genome[\s-]wide|association|meta[\s-]analysis)",
    r"\bindependent\s+replication\b",
    r"\bstage\s+(?:2|II|two)\b.*\b(?:gwas|genome[\s-]wide|association)",
    r"\bvalidat(?:ion|ed)\s+in\s+(?:an?\s+)?independent\s+(?:cohort|sample|dataset|population)",
    r"\bconfirmatory\s+(?:study|analysis|sample|cohort)",
    r"\bconfirmed\s+in\s+(?:an?\s+)?(?:independent\s+)?(?:cohort|sample|dataset|population)",
    r"\breplicat\w+\s+in\s+(?:a\s+)?(?:japanese|chinese|african|european|asian|korean|han|caucasian|hispanic|latino|finnish|icelandic|ashkenazi|mexican|brazilian|indian)\s+(?:cohort|sample|population)",
]
BIOLOGY = [
    r"\bdna\s+replicat", r"\bviral\s+replicat", r"\bvirus\s+replicat", r"\breplicat\w*\s+fork", r"\breplicat\w*\s+origin",
    r"\borigin\s+of\s+replicat", r"\breplicat\w*\s+machinery", r"\breplicat\w*\s+complex", r"\breplicat\w*\s+initiat",
    r"\breplicat\w*\s+terminat", r"\breplicat\w*\s+stress", r"\bgenome\s+replicat", r"\bchromosom\w*\s+replicat",
    r"\breplication\s+protein", r"\breplication\s+factor", r"\breplication\s+enzyme", r"\breplicase\b", r"\breplicat\w*\s+cycle",
    r"\breplicat\w*\s+intermediat", r"\breplicat\w*\s+bubble", r"\bplasmid\s+replicat", r"\breplicat\w*\s+helicase",
    r"\breplicat\w*\s+primase", r"\breplicat\w*\s+polymerase", r"\brna\s+replicat", r"\bself[\s-]replicat",
    r"\breplicat\w*\s+niche", r"\breplicat\w*\s+competent", r"\breplication[\s-]deficient", r"\breplication[\s-]defective",
    r"\bnon[\s-]replicat\w+\s+(vector|virus|particle)", r"\breplicat\w*\s+kinetics", r"\btranscription\s+and\s+replicat",
    r"\bhiv\b.*\breplicat", r"\bhepatitis\b.*\breplicat", r"\binfluenza\b.*\breplicat", r"\bsars\b.*\breplicat", r"\bcovid\b.*\breplicat",
    r"\breplicat\w*\s+(?:of|in)\s+(?:the\s+)?(?:hiv|sars|covid|influenza|hepatitis|dengue|zika|ebola|filovirus|rotavirus|norovirus|coronaviruse?s?)\b",
    r"\breplicat\w*\s+of\s+\w*\s*virus\w*\b", r"\bcell\s+replicat", r"\bcellular\s+replicat",
]
MEASUREMENT = [
    r"\breproducib\w+\s+(?:of\s+)?(?:the\s+)?(?:measurement|method|technique|assay|test|imaging|scan)",
    r"\b(?:measurement|method|technique|assay|test|imaging)\s+reproducib",
    r"\binter[\s-]?(?:observer|rater|reader|examiner)\s+reproducib",
    r"\bintra[\s-]?(?:observer|rater|reader|examiner)\s+reproducib",
    r"\btest[\s-]retest\s+reproducib",
    r"\breproducib\w+\s+(?:and|or)\s+repeatab",
    r"\brepeatab\w+\s+(?:and|or)\s+reproducib",
]
STATISTICAL = [
    r"\bbiological\s+replicat", r"\btechnical\s+replicat",
    r"\b(?:three|3|two|2|four|4|five|5|six|6)\s+(?:biological|technical|independent)\s+replicat",
    r"\breplicat\w*\s+experiment\w*\s+were\s+performed", r"\bperformed\s+in\s+(?:triplicate|duplicate|quadruplicate)",
    r"\bn\s*=\s*\d+\s+replicat", r"\breplicat\w*\s+per\s+(?:condition|group|sample|well|plate)",
    r"\bindependent\s+replicat\w*\s+(?:of|per|for)\b", r"\breplicat\w*\s+wells?\b", r"\breplicat\w*\s+samples?\b", r"\breplicat\w*\s+measurements?\b",
]
WEAK = [r"\breplication\s+of\b", r"\breplicat\w*\s+in\s+(?:a\s+)?(?:new|second|different)\s+(?:sample|context|setting|population)"]


@dataclass(frozen=True)
class RuleSet:
    """Pattern lists of the ordered classifier; ``flags`` go before each pattern."""

    gate: str
    strong: list[str]
    exclusions: dict[str, list[str]]
    strip: list[str]
    weak: list[str]
    stems: tuple[str, ...]
    flags: str = "(?iu)(?U)"


SCREENING = RuleSet(GATE, STRONG, {"bio_replication": BIOLOGY, "measurement_repro": MEASUREMENT}, STATISTICAL, WEAK, ("replicat", "reproducib"))


def _hit(text: Column, patterns: list[str], flags: str) -> Column:
    return text.rlike(flags + "(?:" + "|".join(f"(?:{p})" for p in patterns) + ")")


def first_match(text: Column, patterns: list[str], flags: str = "(?iu)(?U)") -> Column:
    """The first pattern of the list that occurs, or NULL."""
    return F.coalesce(*[F.when(text.rlike(flags + p), F.lit(p)) for p in patterns])


def classify(title: Column, abstract: Column, rules: RuleSet = SCREENING) -> Column:
    """struct(keep, reason, detail). Order is meaning: gate, strong positives, exclusions, what is left
    of the abstract without the strippable phrases, weak positives, else rejection."""
    title, abstract = F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit(""))
    text, flags = F.concat(title, F.lit(" "), abstract), rules.flags
    cleaned = F.lower(abstract)
    for p in rules.strip:
        cleaned = F.regexp_replace(cleaned, flags + p, "")
    nothing_left = ~F.greatest(*[cleaned.contains(s) for s in rules.stems]) if len(rules.stems) > 1 else ~cleaned.contains(rules.stems[0])
    only_stat = _hit(abstract, rules.strip, flags) & nothing_left
    strong, weak = first_match(text, rules.strong, flags), first_match(text, rules.weak, flags)
    out = lambda keep, reason, detail="": F.struct(F.lit(keep).alias("keep"), F.lit(reason).alias("reason"), (F.lit(detail) if isinstance(detail, str) else detail).alias("detail"))
    case = F.when(~text.rlike(flags + rules.gate), out(False, "no_replication_word"))
    case = case.when(_hit(text, rules.strong, flags), out(True, "strong_positive", F.coalesce(strong, F.lit(""))))
    for reason, patterns in rules.exclusions.items():
        case = case.when(_hit(text, patterns, flags), out(False, reason))
    case = case.when(only_stat & title.rlike(flags + rules.gate), out(True, "title_has_replication")).when(only_stat, out(False, "stat_replicates_only"))
    case = case.when(_hit(text, rules.weak, flags), out(True, "weak_positive", F.coalesce(weak, F.lit(""))))
    return case.otherwise(out(False, "weak_replication_word"))


def first_rule(rules: list[tuple[str, str]], text: Column, default: str = "none") -> Column:
    """The name of the first (name, pattern) that occurs."""
    case = None
    for name, pattern in rules:
        case = F.when(text.rlike(pattern), name) if case is None else case.when(text.rlike(pattern), name)
    return case.otherwise(default)


def histogram(rows: DataFrame, reason: str = "reason", keep: str = "keep") -> DataFrame:
    """Counts by reason, most first, with KEEP or EXCLUDE."""
    return rows.groupBy(reason).agg(F.count("*").alias("n"), F.max(F.when(F.col(keep), "KEEP").otherwise("EXCLUDE")).alias("tag")).orderBy(F.desc("n"), reason)
