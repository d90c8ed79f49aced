"""Secret scans with a trigram inverted index and exact verification.

From each rule's regex a Boolean trigram query is derived: the parts that every
match must hold, as an AND of ORs of trigram sets. The index holds a posting
(trigram, text) for each trigram that any query names; postings are intersected by
counting them per text and alternative. Only the texts that a rule's query leaves
are verified with its regex. A rule without a mandatory trigram scans all texts.

Only DataFrame functions are used. Match positions come from splitting a text at
the same regex: the lengths of the gaps and of the matches add up to the spans.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import staged, table

MOST_STRINGS = 64
MOST_CHARS = 4


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a match counts if ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules, then formats of well-known credentials.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # The same spans as runs of one or more cut to 16 or more: matches are whole runs.
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY(?: BLOCK)?-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("login_url", r"://[A-Za-z0-9._%+-]+:[A-Za-z0-9._%+!$-]+@"),
)
RULES = BASE_RULES + MORE_RULES


def _strings(items) -> set[str] | None:
    """All strings a parsed regex can match, if they are few; else None."""
    out = {""}
    for op, arg in items:
        found = _one(str(op), arg)
        if found is None or len(out) * len(found) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in found}
    return out


def _one(op: str, arg) -> set[str] | None:
    if op == "LITERAL":
        return {chr(arg)}
    if op == "AT":
        return {""}
    if op == "IN":
        chars: set[str] = set()
        for kind, x in arg:
            if str(kind) == "LITERAL":
                chars.add(chr(x))
            elif str(kind) == "RANGE" and x[1] - x[0] < MOST_CHARS:
                chars.update(map(chr, range(x[0], x[1] + 1)))
            else:
                return None
        return chars if len(chars) <= MOST_CHARS + 2 else None
    if op == "SUBPATTERN":
        return _strings(arg[-1])
    if op == "BRANCH":
        found = [_strings(b) for b in arg[1]]
        return None if None in found else set().union(*found)
    if op in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] <= MOST_CHARS:
        inner, out = _strings(arg[2]), set()
        for n in range(arg[0], arg[1] + 1) if inner is not None else ():
            if len(inner) ** n > MOST_STRINGS:
                return None
            step = {""}
            for _ in range(n):
                step = {a + b for a in step for b in inner}
            out |= step
        return out if inner is not None else None
    return None


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """AND of ORs of trigram sets (of the lower-cased text) that every match implies."""
    runs: list[set[str]] = []

    def walk(items) -> None:
        now = {""}
        for op, arg in items:
            name, found = str(op), _one(str(op), arg)
            if found is not None and len(now) * len(found) <= MOST_STRINGS:
                now = {a + b for a in now for b in found}
                continue
            runs.append(now)
            now = {""}
            if name == "SUBPATTERN":
                walk(arg[-1])
            elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
                walk(arg[2])
        runs.append(now)

    walk(re._parser.parse(pattern))
    query = []
    for strings in runs:
        sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in (x.lower() for x in strings)}
        if sets and frozenset() not in sets:
            query.append(sorted((s for s in sets if not any(o < s for o in sets)), key=sorted))
    return query


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index ``trigram, doc_id, mark`` over ``texts`` (doc_id, mark, text)."""
    low = texts.select("doc_id", "mark", F.lower("text").alias("low"))
    hits = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select(F.explode(hits).alias("trigram"), "doc_id", "mark")


def candidates(index: DataFrame, queries: dict[str, list[list[frozenset[str]]]]) -> DataFrame:
    """``doc_id, mark, kinds``: the kinds whose trigram query a text satisfies."""
    spark = index.sparkSession
    terms = [(k, len(q), c, a, len(s), t) for k, q in queries.items() for c, alts in enumerate(q)
             for a, s in enumerate(alts) for t in sorted(s)]
    names = ("kind", "clauses", "clause", "alt", "need", "trigram")
    wanted = spark.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(x).alias(c) for c, x in zip(names, t, strict=True)]) for t in terms])))
    # One exchange: the later groupings keep a text's rows where they are.
    at = index.join(F.broadcast(wanted), "trigram").repartition("doc_id", "mark")
    alternatives = (at.groupBy("doc_id", "mark", "kind", "clauses", "clause", "alt", "need")
                    .agg(F.size(F.collect_set("trigram")).alias("have")).filter("have = need"))
    kinds = (alternatives.groupBy("doc_id", "mark", "kind", "clauses")
             .agg(F.size(F.collect_set("clause")).alias("have")).filter("have = clauses"))
    return kinds.groupBy("doc_id", "mark").agg(F.collect_set("kind").alias("kinds"))


SPANS = "array<struct<start:int,ord:int,kind:string,end:int>>"


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _blocks(items: Column) -> Column:
    """An array cut into about as many blocks as each has elements."""
    def cut(x):
        width = F.ceil(F.sqrt(F.size(x))).cast("int")
        return F.when(F.size(x) > 0, F.transform(F.sequence(F.lit(1), F.size(x), width), lambda i: F.slice(x, i, width))) \
            .otherwise(F.slice(F.array(x), 1, 0))

    return _bound(items, cut)


def _scanned(items: Column, value, combine) -> Column:
    """Blocks of ``struct<before, item>``: with each element the combined ``value`` of those before it, from 0 on.

    An array grows by copying, so running values are taken in two levels: over the blocks,
    and within each from what the block starts with. n elements cost n times the root of n.
    """
    def running(block, first):
        start = F.struct(first.alias("at"), F.slice(F.transform(block, lambda x: F.struct(first.alias("before"), x.alias("item"))), 1, 0).alias("out"))

        def step(acc, x):
            one = F.struct(acc["at"].alias("before"), x.alias("item"))
            return F.struct(combine(acc["at"], value(x)).alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(block, start, step, lambda acc: acc["out"])

    def over(blocks):
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, x: combine(acc, value(x))))
        firsts = F.aggregate(totals, F.array(F.lit(0)), lambda acc, t: F.concat(acc, F.array(combine(F.element_at(acc, -1), t))))
        return _bound(firsts, lambda first: F.transform(blocks, lambda b, i: running(b, first[i])))

    return _bound(_blocks(items), over)


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """All spans of a rule: ``array<struct<start, ord, kind, end>>`` in code points."""
    gaps = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    steps = F.arrays_zip(F.slice(F.transform(gaps, F.length), 1, F.size(whole)).alias("gap"),
                         F.transform(whole, F.length).alias("len"), F.transform(part, F.length).alias("part"))

    def span(x):
        start = x["before"] + x["item"]["gap"]
        return F.struct(start.alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"),
                        (start + x["item"]["len"]).alias("end"))

    placed = F.flatten(_scanned(steps, lambda x: x["gap"] + x["len"], lambda a, b: a + b))
    return F.transform(F.filter(placed, lambda x: x["item"]["part"] >= rule.least), span).cast(SPANS)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) and ``secrets``, its spans.

    ``secrets`` is an array of (start, ord, kind, end) in code points, end
    exclusive, by start and then rule order; per rule, matches are the leftmost
    non-overlapping ones, and those too short are dropped. Null text is empty and
    has none. Rows with equal doc_id (null too) and text share their index entries
    and get equal results; a column named ``secrets`` is replaced. An empty table
    gives an empty result.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    queries = {k: q for k, q in queries.items() if q}
    kept = [c for c in docs.columns if c != "secrets"]
    keyed = docs.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in kept], "doc_id", "text",
                        F.xxhash64(F.lit("secret-scan"), body).alias("_mark"))
    trigrams = sorted({t for q in queries.values() for alts in q for s in alts for t in s})
    index = staged(docs.sparkSession, postings(
        keyed.select("doc_id", F.col("_mark").alias("mark"), body.alias("text")), trigrams), "trigram-index")
    found = staged(docs.sparkSession, candidates(index, queries), "secret-candidates") \
        .select(F.col("doc_id").alias("_id"), F.col("mark").alias("_m"), F.col("kinds").alias("_kinds"))
    joined = keyed.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_m")), "left")
    none = F.array().cast(SPANS)
    lists = []
    for i, r in enumerate(rules):
        wanted = F.array_contains("_kinds", r.kind) if r.kind in queries else body.rlike(r.pattern)
        lists.append(F.when(wanted, _spans(body, r, i)).otherwise(none))
    return joined.select(*[F.col(f"`in_{c}`").alias(c) for c in kept], F.array_sort(F.concat(*lists)).alias("secrets"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret in a text replaced by its kind in brackets.

    Overlapping spans become one replacement. Columns stay as they are, except that
    ``n_chars``, if there, follows a changed text; null texts stay null.
    """
    columns = docs.columns
    text = F.col("text")
    sealed = docs.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in columns], "doc_id", "text")

    def pieces(block):
        """What the spans of a block leave of the text before each, with its kind; read from that stretch of the text alone."""
        first = block[0]["before"]
        stretch = F.substring(text, first + 1, F.greatest(F.lit(0), F.element_at(block, -1)["item"]["start"] - first))
        return _bound(stretch, lambda part: F.array_join(F.transform(block, lambda x: F.when(
            x["item"]["start"] >= x["before"], F.concat(F.substring(part, x["before"] - first + 1, x["item"]["start"] - x["before"]),
                                                     F.lit("["), x["item"]["kind"], F.lit("]"))).otherwise(F.lit(""))), ""))

    covered = F.array_max(F.transform("secrets", lambda s: s["end"]))
    clean = F.concat(F.array_join(F.transform(_scanned(F.col("secrets"), lambda s: s["end"], F.greatest), pieces), ""),
                     F.substring(text, covered + 1, F.length(text)))
    changed = F.size("secrets") > 0
    out = {"text": F.when(changed, F.col("_clean")).otherwise(text)}
    if "n_chars" in columns:
        out["n_chars"] = F.when(changed, F.length("_clean")).otherwise(F.col("in_n_chars")).cast(docs.schema["n_chars"].dataType)
    return scan(sealed, rules).withColumn("_clean", F.when(changed, clean)) \
        .select(*[out.get(c, F.col(f"`in_{c}`")).alias(c) for c in columns])


def op10_secrets(spark, sf_dir):
    """Number and place of the secrets in every document."""
    found = scan(table(spark, sf_dir, "documents")).select("doc_id", "secrets")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["ord"] < len(BASE_RULES))
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
