"""Secret scans: a trigram index picks the documents in which a rule can match, then the rule runs.

The Boolean trigram query of a rule is derived from its regular expression; a rule that needs no
trigram is run on every text.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.native import digest, let, lower_ascii, running, set_aside


@dataclass(frozen=True)
class Rule:
    """What one kind of secret looks like. ``least`` is the size that ``group`` must have."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The three kinds that every scan reports, in the order in which ties are listed.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# Published shapes of keys and tokens.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("login", r"https?://[^\s/:@]{1,128}:[^\s/:@]{1,128}@"),
)
RULES = BASE + MORE

#: A query is a list of clauses that must all hold; a clause lists sets of trigrams, one of which must be there whole.
Query = list[list[frozenset[str]]]
MOST_STRINGS = 64


def _clause(strings: set[str]) -> Query:
    """What holds if one of the strings occurs: nothing if one of them is shorter than a trigram.

    A set that holds another one asks for more than is needed and is left out.
    """
    sets = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings)]
    least = [s for s in dict.fromkeys(sets) if not any(other < s for other in sets)]
    return [least] if all(sets) else []


def _walk(items, flags: int) -> tuple[set[str] | None, Query]:
    """(all strings that the items can match, or None if too many; what else must hold)."""
    run, query = {""}, []

    def cut(next_run: set[str] | None = None) -> None:
        nonlocal run
        query.extend(_clause(run))
        run = next_run or {""}

    whole = True
    for code, arg in items:
        strings, more = _strings(code, arg, flags)
        query.extend(more)
        if strings is None:
            cut()
            whole = False
        elif len(run) * len(strings) > MOST_STRINGS:
            cut(strings)
            whole = False
        else:
            run = {a + b for a, b in product(run, strings)}
    if whole:
        return run, query
    cut()
    return None, query


def _strings(code, arg, flags: int) -> tuple[set[str] | None, Query]:
    """The strings one part of a pattern can match, if they are few, and what else must hold."""
    if code is op.LITERAL:
        return {chr(arg).lower()}, []
    if code is op.IN and all(c is op.LITERAL for c, _ in arg):
        return {chr(c).lower() for _, c in arg}, []
    if code is op.SUBPATTERN:
        return _walk(arg[3], flags)
    if code is op.BRANCH:
        found = [_walk(branch, flags) for branch in arg[1]]
        if all(s is not None for s, _ in found):
            return set().union(*(s for s, _ in found)), []
        return None, []
    if code in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, body = arg
        strings, more = _walk(body, flags)
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, []
        if least == most == 1:
            return strings, more
        return None, (more + _clause(strings) if strings else more) if least else []
    if code is op.AT:
        return {""}, []
    return None, []


def trigram_query(pattern: str) -> Query:
    """The trigrams, in lower case, that every text with a match must hold; [] if it needs none."""
    strings, query = _walk(parser.parse(pattern), 0)
    return query + (_clause(strings) if strings else [])


def needed(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({t for r in rules for clause in trigram_query(r.pattern) for way in clause for t in way})


KEY = ("doc_id", "digest")


def trigram_index(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Postings (trigram, doc_id, digest) of every trigram that a rule's query names."""
    tris = F.array(*[F.lit(t) for t in needed(rules)]).cast("array<string>")
    has = let(lower_ascii(F.col("text")), lambda low: F.filter(tris, lambda t: F.contains(low, t)))
    return docs.where(F.col("text").isNotNull()).select(
        F.explode(has).alias("trigram"), "doc_id", digest(F.col("text")).alias("digest")
    )


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, digest, kinds): the kinds whose query a document's postings satisfy."""
    found = index.groupBy(*KEY).agg(F.collect_set("trigram").alias("found"))

    def holds(query: Query) -> Column:
        ways = [
            reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.array_contains("found", t) for t in sorted(way)]) for way in clause])
            for clause in query
        ]
        return reduce(lambda a, b: a & b, ways)

    kinds = [F.when(holds(q), F.lit(r.kind)) for r in rules if (q := trigram_query(r.pattern))]
    if not kinds:
        return found.select(*KEY, F.array().cast("array<string>").alias("kinds")).limit(0)
    return found.select(*KEY, F.array_compact(F.array(*kinds)).alias("kinds")).where(F.size("kinds") > 0)


SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """The matches of a rule as (start, rank, end, kind), leftmost first, in code points."""
    pattern = F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    held = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole

    def place(parts: Column) -> Column:
        lengths = F.transform(parts["whole"], lambda x, i: F.length(F.get(parts["between"], i)) + F.length(x))

        def span(at: Column, i: Column) -> Column:
            start = at + F.length(F.get(parts["between"], i))
            end = start + F.length(F.get(parts["whole"], i))
            whole = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))
            return F.when(F.length(F.get(parts["held"], i)) >= rule.least, whole)

        return F.array_compact(F.transform(running(lengths), span))

    parts = F.struct(between.alias("between"), whole.alias("whole"), held.alias("held"))
    return F.when(F.regexp_like(text, pattern), let(parts, place)).otherwise(F.array().cast(SPANS))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with secrets: all spans of all rules, by start, then by the rules' order.

    ``docs`` has doc_id and text. Matches of one rule do not overlap; those of different rules may.
    Null and empty texts have none. Repeated rows, null ids and extra columns, whatever their names, stay as they
    are; an older column secrets is replaced. Time in one text grows little more than its spans. An empty
    table gives an empty one.
    """
    none = F.array().cast(SPANS)
    docs, columns = set_aside(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "secrets"]), "doc_id", "text")
    index = trigram_index(docs.select("doc_id", "text"), rules)
    picked = candidates(index, rules).select(F.col("doc_id").alias("id"), F.col("digest").alias("of"), "kinds")
    rows = docs.select("*", digest(F.col("text")).alias("digest"))
    joined = rows.join(picked, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")), "left")
    found = []
    for rank, rule in enumerate(rules):
        spans = rule_spans(F.col("text"), rule, rank)
        if trigram_query(rule.pattern):
            spans = F.when(F.array_contains("kinds", rule.kind), spans).otherwise(none)
        found.append(F.coalesce(spans, none))
    return joined.select(*columns, F.sort_array(F.concat(*found)).alias("secrets"))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets_digest(found: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("secrets", lambda s: s["rank"] < len(BASE))
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("secrets")).alias("spans"),
    )
