"""Secret scans over a trigram inverted index.

Each rule is a regular expression. From its parse tree follow strings that every match contains, and from these
a Boolean query over trigrams: of each run of literals one alternative, with all its trigrams. The index lists
the documents of each trigram that some query asks for, over lower-cased text. Queries intersect and unite
these postings; only the documents that remain are searched with the expression itself. A rule without mandatory
trigrams searches every text. All of it is Spark SQL: no Python runs on the executors.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as op, _parser as parser

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.session import materialise

from .common import likely, text_of

#: Alternatives of a run of literals, and members of a character class, that a query spells out.
ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and apart from each other, whose ``group`` has ``least`` characters."""

    name: str
    pattern: str
    least: int = 1
    group: int = 0


BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    # a run shorter than asked for hides no longer one, so the length may stand in the expression
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
#: Beyond the base rules: keys of well-known issuers.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
)


def _spelled(nodes) -> set[str] | None:
    """All strings that a sequence of parse nodes matches, if they are few."""
    made = {""}
    for kind, value in nodes:
        if kind is op.LITERAL:
            here = {chr(value)}
        elif kind is op.IN:
            here = set()
            for inner, what in value:
                if inner is op.LITERAL:
                    here.add(chr(what))
                elif inner is op.RANGE and what[1] - what[0] < ALTERNATIVES:
                    here |= {chr(c) for c in range(what[0], what[1] + 1)}
                else:
                    return None
        elif kind is op.SUBPATTERN:
            here = _spelled(value[3])
        elif kind is op.BRANCH:
            each = [_spelled(b) for b in value[1]]
            here = None if None in each else set().union(*each)
        elif kind is op.MAX_REPEAT and value[1] <= 4:
            part = _spelled(value[2])
            here = part and {"".join(p) for n in range(value[0], value[1] + 1) for p in product(part, repeat=n)}
        else:
            return None
        if not here or len(made) * len(here) > ALTERNATIVES:
            return None
        made = {a + b for a in made for b in here}
    return made


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Runs that all must hold; a run holds if all trigrams of one of its alternatives are there.

    Trigrams are lower-cased. An empty list: no trigram is mandatory.
    """
    runs: list[set[str]] = [{""}]
    for node in parser.parse(pattern):
        here = _spelled([node])
        if here and len(runs[-1]) * len(here) <= ALTERNATIVES:
            runs[-1] = {a + b for a in runs[-1] for b in here}
        else:
            runs += [here, {""}] if here else [{""}]
    query = []
    for run in runs:
        alternatives = {frozenset(s[i : i + 3].lower() for i in range(len(s) - 2)) for s in run}
        if frozenset() not in alternatives:
            query.append(sorted(alternatives, key=sorted))
    return query


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id): the inverted index over lower-cased texts, for the trigrams asked for.

    Lower-casing leaves ASCII letters side by side that stood side by side, so no posting is lost.
    """
    folded = docs.select("doc_id", F.lower(text_of()).alias("folded"))
    found = F.array_compact(F.array(*[F.when(F.col("folded").contains(t), F.lit(t)) for t in trigrams]))
    return folded.select("doc_id", F.explode(found).alias("trigram")).distinct()


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, rules): per document the rules whose trigram query it meets; others are not listed."""
    spark = docs.sparkSession
    asked = [(t, r.name, i, j, len(alternative))
             for r in rules for i, run in enumerate(trigram_query(r.pattern))
             for j, alternative in enumerate(run) for t in sorted(alternative)]
    runs = [(r.name, len(trigram_query(r.pattern))) for r in rules]
    # a few rows for each rule
    queries = F.broadcast(spark.createDataFrame(asked, "trigram string, rule string, run int, alternative int, needed int"))
    needed = F.broadcast(spark.createDataFrame(runs, "rule string, runs int"))
    index = postings(docs, sorted({a[0] for a in asked}))
    met = index.join(queries, "trigram").groupBy("doc_id", "rule", "run", "alternative", "needed").agg(
        F.count("*").alias("n")).filter("n = needed")
    met = met.select("doc_id", "rule", "run").distinct().groupBy("doc_id", "rule").agg(F.count("*").alias("met"))
    return met.join(needed, "rule").filter("met = runs").groupBy("doc_id").agg(F.collect_set("rule").alias("rules"))


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """Array of (start, rank, stop, kind) of the matches, in code points, stop exclusive.

    What lies between the matches and the matches themselves add up to their places.
    """
    between = F.split(text, rule.pattern, -1)
    whole, value = (F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(g)) for g in (0, rule.group))
    parts = F.arrays_zip(between.alias("gap"), whole.alias("whole"), value.alias("value"))
    kind = "array<struct<start:int,rank:int,stop:int,kind:string>>"
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))

    def add(state, part):
        start = state["at"] + F.length(part["gap"])
        stop = start + F.coalesce(F.length(part["whole"]), F.lit(0))
        one = F.struct(start.alias("start"), F.lit(rank).alias("rank"), stop.alias("stop"), F.lit(rule.name).alias("kind"))
        found = F.when(F.coalesce(F.length(part["value"]), F.lit(0)) >= rule.least, F.concat(state["found"], F.array(one)))
        return F.struct(stop.alias("at"), found.otherwise(state["found"]).cast(kind).alias("found"))

    return F.aggregate(parts, empty, add, lambda state: state["found"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """doc_id and found, the sorted spans of all rules, for every row of ``docs``.

    Null and empty texts have no spans. Rows that share a doc_id are searched for what any of them may hold, each
    with its own result. Spans of different rules may overlap; they are ordered by start, then rule.

    Rules without trigrams search every text where it is read. Of the other texts only those that a map of the
    candidates lets through are moved to meet their rules.
    """
    none = F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string>>")

    def searched(rule: Rule, wanted: Column) -> Column:
        text = F.col("text")
        return F.when(wanted & text.rlike(rule.pattern), spans(text, rule, rules.index(rule))).otherwise(none)

    indexed = tuple(r for r in rules if trigram_query(r.pattern))
    free = [searched(r, F.lit(True)) for r in rules if r not in indexed]
    rows = docs.select("doc_id", text_of().alias("text"))
    if not indexed:
        return rows.select("doc_id", F.sort_array(F.concat(none, *free)).alias("found"))
    held = materialise(candidates(docs, indexed).withColumnRenamed("doc_id", "holder"), "candidates")
    rows = likely(rows, F.col("doc_id"), held.select("holder"), "near").select(
        "doc_id", F.concat(none, *free).alias("free"), F.when(F.col("near"), F.col("text")).alias("text"))
    rows = rows.join(held, F.col("doc_id").eqNullSafe(F.col("holder")), "left").drop("holder")
    found = [searched(r, F.coalesce(F.array_contains("rules", r.name), F.lit(False))) for r in indexed]
    return rows.select("doc_id", F.sort_array(F.concat("free", *found)).alias("found"))


def written(found: Column) -> Column:
    """kind:start:stop of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
