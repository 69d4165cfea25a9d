"""Secret scans through a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression. From it a Boolean query over lower-cased trigrams is derived: an OR
of alternatives, each an AND of trigrams that every match contains. The index holds the postings of the
trigrams in these queries; intersected, they give the documents that a rule has to read. A rule
without mandatory trigrams reads all documents.

Cases: a null text is empty. A document is a row; rows with equal id and text get equal results. Null ids
are ids like others. Columns of the input whose names the result uses are replaced. An empty table gives
an empty table.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.session import cut


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` count where `group` has `least` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules, in the order of their kinds.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]{24,}"),  # shorter runs of these characters cannot change where longer ones begin
)
# Published formats of credentials that the base rules leave out.
ADDED = (
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("hub", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
)
SPELLINGS = 64  # spelled-out strings of a part of a pattern; beyond, the part asks for nothing

Query = frozenset[frozenset[str]]  # an OR of ANDs; an empty AND is always true
ALWAYS: Query = frozenset([frozenset()])


def _or(queries: list[Query]) -> Query:
    every = frozenset().union(*queries)
    return frozenset(a for a in every if not any(b < a for b in every))


def _and(a: Query, b: Query) -> Query:
    return _or([frozenset([x | y]) for x in a for y in b])


def _contains(spellings: set[str]) -> Query:
    return _or([frozenset([frozenset(s[k : k + 3] for k in range(len(s) - 2))]) for s in spellings])


def _spelled(code, value) -> set[str] | None:
    """All lower-cased strings that a part matches, if they are few."""
    if code is op.LITERAL:
        return {chr(value).lower()}
    if code is op.IN and all(c is op.LITERAL for c, _ in value):
        return {chr(v).lower() for _, v in value}
    if code is op.SUBPATTERN:
        return _spelled_all(value[3])
    if code is op.BRANCH:
        each = [_spelled_all(part) for part in value[1]]
        return None if None in each else set().union(*each)
    if code is op.MAX_REPEAT and value[1] <= 3:
        one = _spelled_all(value[2])
        if one is not None:
            return {"".join(p) for n in range(value[0], value[1] + 1) for p in itertools.product(one, repeat=n)}
    return None


def _spelled_all(parts) -> set[str] | None:
    found = {""}
    for code, value in parts:
        some = _spelled(code, value)
        if some is None or len(found) * len(some) > SPELLINGS:
            return None
        found = {a + b for a in found for b in some}
    return found


def _query(parts) -> Query:
    asked, run = ALWAYS, {""}
    for code, value in parts:
        some = _spelled(code, value)
        if some is not None and len(run) * len(some) <= SPELLINGS:
            run = {a + b for a in run for b in some}
            continue
        asked, run = _and(asked, _contains(run)), {""}
        if some is not None:
            run = some
        elif code is op.SUBPATTERN:
            asked = _and(asked, _query(value[3]))
        elif code is op.BRANCH:
            asked = _and(asked, _or([_query(part) for part in value[1]]))
        elif code is op.MAX_REPEAT and value[0]:
            asked = _and(asked, _query(value[2]))
    return _and(asked, _contains(run))


def trigram_query(pattern: str) -> Query:
    """What the lower-cased trigrams of a text must satisfy for `pattern` to match in it."""
    return _query(parser.parse(pattern))


def _tag(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """`trigram` and `doc_tag`: the inverted index of some trigrams over lower-cased `text`."""
    listed = F.array(*[F.lit(t) for t in trigrams])
    lower = texts.select("doc_tag", F.lower("text").alias("text"))
    return lower.select("doc_tag", F.explode(F.filter(listed, lambda t: F.contains(F.col("text"), t))).alias("trigram"))


def candidates(texts: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """`doc_tag` and `kinds`, the rules whose trigram query the document satisfies."""
    terms = [(kind, k, t) for kind, query in queries.items() for k, need in enumerate(sorted(map(sorted, query))) for t in need]
    asked = texts.sparkSession.createDataFrame(terms, "kind string, choice int, trigram string")
    needs = asked.groupBy("kind", "choice").agg(F.count("*").alias("need"))
    index = postings(texts, sorted({t for _, _, t in terms})).distinct()
    met = index.join(F.broadcast(asked), "trigram").groupBy("doc_tag", "kind", "choice").agg(F.count("*").alias("met"))
    whole = met.join(F.broadcast(needs), ["kind", "choice"]).where(F.col("met") == F.col("need"))  # as many rows as the rules have alternatives
    return whole.groupBy("doc_tag").agg(F.collect_set("kind").alias("kinds"))


def _pieces(texts: DataFrame, rule: Rule) -> DataFrame:
    """The matches of a rule in order, each with the length of the text since the one before."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all("text", pattern, F.lit(0))
    value = F.regexp_extract_all("text", pattern, F.lit(rule.group)) if rule.group else matches
    lengths = lambda a: F.transform(a, lambda x: F.char_length(x))
    gaps = F.slice(F.split("text", rule.pattern, -1), F.lit(1), F.size(matches))
    zipped = F.arrays_zip(lengths(gaps).alias("gap"), lengths(matches).alias("size"), lengths(value).alias("value"))
    rows = texts.where(F.col("text").rlike(rule.pattern)).select("doc_tag", F.lit(rule.kind).alias("kind"), F.posexplode(zipped).alias("k", "m"))
    return rows.select("doc_tag", "kind", "k", "m.gap", "m.size", "m.value")


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_tag`, `kind`, `begin` and `end` (code points, end exclusive), leftmost and non-overlapping per kind."""
    texts = docs.select(_tag(id_col, text_col).alias("doc_tag"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: q for kind, q in queries.items() if frozenset() not in q}
    pieces = None
    if indexed:
        chosen = texts.join(candidates(texts, indexed), "doc_tag")
    for rule in rules:
        part = _pieces(chosen.where(F.array_contains("kinds", rule.kind)) if rule.kind in indexed else texts, rule)
        pieces = part if pieces is None else pieces.unionByName(part)
    # rows with equal id and text give the same pieces
    pieces = pieces.repartition("doc_tag", "kind").dropDuplicates(["doc_tag", "kind", "k"])
    so_far = Window.partitionBy("doc_tag", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    spans = pieces.withColumn("end", end).withColumn("begin", F.col("end") - F.col("size"))
    enough = F.lit(False)
    for rule in rules:
        enough = enough | ((F.col("kind") == rule.kind) & (F.col("value") >= rule.least))
    return spans.where(enough).select("doc_tag", "kind", "begin", "end")


def _joined(rules: tuple[Rule, ...], spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, added: tuple[Rule, ...] = ADDED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with `base` and `spans`, arrays of (begin, rank, kind, end) by begin and kind."""
    rules = BASE + added
    rank = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind"))
    spans = secret_spans(docs, rules, id_col, text_col).select("doc_tag", F.struct("begin", rank.cast("int").alias("rank"), "kind", "end").alias("span"))
    listed = spans.groupBy("doc_tag").agg(F.array_sort(F.collect_list("span")).alias("spans"))
    others = [c for c in docs.columns if c not in ("doc_tag", "base", "spans")]
    rows = docs.select(*others, _tag(id_col, text_col).alias("doc_tag")).join(listed, "doc_tag", "left")
    none = F.array().cast(listed.schema["spans"].dataType)
    rows = rows.withColumn("spans", F.coalesce("spans", none))
    return rows.select(*others, F.filter("spans", lambda s: s["rank"] <= len(BASE)).alias("base"), "spans")


def span_text(spans: str) -> Column:
    """kind:begin:end, comma-joined."""
    return _joined(BASE, F.col(spans))
