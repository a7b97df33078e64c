"""Secret scan over a trigram inverted index, in DataFrame functions only.

From each rule's pattern a Boolean trigram query is derived: clauses that must
all hold, each a choice of literal strings whose trigrams must all occur.  The
index lists, for every trigram some rule needs, the texts that contain it;
intersecting the lists gives each rule's candidates, and the pattern is run on
those alone.  Rules without a mandatory trigram scan every text.

Spans are in code points, the end exclusive, leftmost and non-overlapping within
a rule.

Defined results: a null text is an empty one and has no spans; repeated rows get
equal results, each for itself; null ids are kept; an empty table gives no rows.
Results keep the input's columns; one named as an output is replaced.
"""

from __future__ import annotations

import re._constants as kinds
import re._parser as parser
from collections.abc import Callable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.names import unused


@dataclass(frozen=True)
class Rule:
    """A pattern; ``least`` characters are asked of group ``group`` (0: of the match) once it has matched."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


# fixed values: the rules, in the order that settles equal starts
RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, base=True),
    Rule("hex", r"[0-9a-f]+", least=24, base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
MASK = "[secret]"
#: Most strings one stretch of a pattern is expanded to before it is cut.
EXPAND = 64

#: Clauses, all needed; each is a choice of sets of trigrams.
TrigramQuery = list[list[frozenset[str]]]


def trigram_query(pattern: str) -> TrigramQuery:
    """What trigrams a lower-cased text must have for the pattern to match in it; empty: nothing is mandatory."""
    clauses: TrigramQuery = []
    strings = [""]

    def close() -> None:
        nonlocal strings
        if all(len(s) >= 3 for s in strings):
            options = {frozenset(s[k : k + 3] for k in range(len(s) - 2)) for s in strings}
            # a choice that asks for more than another adds nothing
            clauses.append(sorted((o for o in options if not any(p < o for p in options)), key=sorted))
        strings = [""]

    for choices in _choices(parser.parse(pattern)):
        if choices is None:
            close()
        elif len(strings) * len(choices) > EXPAND:
            close()
            strings = choices
        else:
            strings = [a + b for a, b in product(strings, choices)]
    close()
    return clauses


def _choices(tree) -> list[list[str] | None]:
    """The parts of a pattern in order: the strings a part can be, or None where they are too many."""
    parts: list[list[str] | None] = []
    for op, value in tree:
        if op is kinds.LITERAL:
            parts.append([chr(value).lower()])
        elif op is kinds.SUBPATTERN:
            parts.extend(_choices(value[-1]))
        elif op is kinds.BRANCH:
            branches = [_joined(_choices(branch)) for branch in value[1]]
            parts.append(None if any(b is None for b in branches) else [s for b in branches for s in b])
        elif op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
            low, high, inner = value
            one = _joined(_choices(inner))
            if one is None:
                parts.append(None)
            elif (low, high) == (0, 1):
                parts.append(["", *one])
            else:
                parts.extend([one] * min(low, 8))
                if high != low or low > 8:
                    parts.append(None)
        elif op is kinds.IN and len(value) <= 8 and all(o is kinds.LITERAL for o, _ in value):
            parts.append(sorted({chr(v).lower() for _, v in value}))
        elif op is kinds.AT:
            continue
        else:
            parts.append(None)
    return parts


def _joined(parts: list[list[str] | None]) -> list[str] | None:
    strings = [""]
    for part in parts:
        if part is None or len(strings) * len(part) > EXPAND:
            return None
        strings = [a + b for a, b in product(strings, part)]
    return strings


SPAN = "struct<start: int, rank: int, kind: string, end: int>"


def _content(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def postings(rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The index of (key, text): one row (trigram, key) for each trigram of some rule in each text."""
    needed = sorted({t for rule in rules for clause in trigram_query(rule.pattern) for option in clause for t in option})
    listed = F.array(*[F.lit(t) for t in needed])
    # bound once for a row: the lower-cased text
    present = F.transform(
        F.array(F.lower("text")), lambda low: F.filter(listed, lambda t: F.contains(low, t))
    )[0]
    return rows.select("key", F.explode(present).alias("trigram")).select("trigram", "key")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Intersected lists: (key, kinds), the rules whose trigram query the text fulfils."""
    terms = []
    for rule in rules:
        query = trigram_query(rule.pattern)
        for c, clause in enumerate(query):
            for o, option in enumerate(clause):
                terms.extend((t, rule.kind, c, o, len(option), len(query)) for t in sorted(option))
    wanted = index.sparkSession.createDataFrame(
        terms, "trigram string, kind string, clause int, choice int, n_trigrams int, n_clauses int"
    )
    met = index.distinct().join(F.broadcast(wanted), "trigram")
    options = (
        met.groupBy("key", "kind", "clause", "choice", "n_trigrams", "n_clauses")
        .agg(F.count("*").alias("n"))
        .filter("n = n_trigrams")
    )
    whole = options.groupBy("key", "kind", "n_clauses").agg(F.countDistinct("clause").alias("n")).filter("n = n_clauses")
    return whole.groupBy("key").agg(F.collect_set("kind").alias("kinds"))  # at most one entry a rule


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of one rule in a text: array of (start, order, kind, end)."""
    # each match with what lies before it; the last alternative takes the rest of the text in one step
    around = F.lit(rf"(?s)(.*?)(?:({rule.pattern})|\z)")
    parts = F.arrays_zip(
        F.regexp_extract_all(text, around, F.lit(1)).alias("gap"),
        F.regexp_extract_all(text, around, F.lit(2)).alias("match"),
        F.regexp_extract_all(text, around, F.lit(2 + rule.group)).alias("value"),
    )
    none = F.array().cast(f"array<{SPAN}>")

    def sized(part: Column) -> Column:
        keep = (F.length(part["match"]) > 0) & (F.length(part["value"]) >= rule.least)
        return F.struct(F.length(part["gap"]).alias("gap"), F.length(part["match"]).alias("match"), keep.alias("keep"))

    def span(start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(order).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))

    def step(done: Column, part: Column) -> Column:
        start = done["at"] + part["gap"]
        end = start + part["match"]
        return F.struct(
            end.alias("at"),
            F.when(part["keep"], F.concat(done["spans"], F.array(span(start, end)))).otherwise(done["spans"]).alias("spans"),
        )

    def after(done: Column, piece: Column) -> Column:
        moved = F.transform(piece["spans"], lambda s: span(s["start"] + done["at"], s["end"] + done["at"]))
        return F.struct((done["at"] + piece["at"]).alias("at"), F.concat(done["spans"], F.array(moved)).alias("spans"))

    def placed(listed: Column) -> Column:
        # positions within a stretch first, then the stretches one after another
        start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
        pieces = F.transform(stretches(listed), lambda stretch: F.aggregate(stretch, start, step))
        none_yet = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("spans"))
        return F.aggregate(pieces, none_yet, after, lambda done: F.flatten(done["spans"]))

    return once(F.transform(parts, sized), placed)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def stretches(listed: Column) -> Column:
    """An array cut into as many stretches as each has elements, about.

    What grows by copying grows within a stretch or by whole stretches, so that
    long arrays cost n * sqrt(n) small copies and not n * n.
    """
    n = F.greatest(F.size(listed), F.lit(1))
    length = F.ceil(F.sqrt(n)).cast("int")
    return F.transform(F.sequence(F.lit(1), n, length), lambda at: F.slice(listed, at, length))


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, name: str = "secrets"
) -> DataFrame:
    """The input's columns and the spans found: array of (start, rank, kind, end), by start and rank.

    The index and the verification name a text by its id and hash, so repeated
    rows share an entry.
    """
    content = _content(text)
    row_key = F.xxhash64(F.col(key), F.sha2(content, 256))
    hits = candidates(postings(docs.select(row_key.alias("key"), content.alias("text")), rules), rules)
    whole, row, hit, kinds_met = unused(docs.columns, "_text", "_row", "_hit", "_kinds")
    hits = hits.select(F.col("key").alias(hit), F.col("kinds").alias(kinds_met))
    joined = docs.withColumn(whole, content).withColumn(row, row_key).join(hits, F.col(row) == F.col(hit), "left")
    found = []
    for order, rule in enumerate(rules):
        if trigram_query(rule.pattern):
            tried = F.coalesce(F.array_contains(kinds_met, rule.kind), F.lit(False))
        else:
            # a full scan: a quick test for a run of the least length, then the exact pattern
            tried = F.col(whole).rlike(rule.pattern.removesuffix("+") + f"{{{max(rule.least, 1)}}}")
        found.append(F.when(tried, rule_spans(F.col(whole), rule, order)).otherwise(F.array().cast(f"array<{SPAN}>")))
    spans = F.array_sort(F.concat(*found))
    return joined.withColumn(name, spans).drop(whole, row, hit, kinds_met)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """The text with every span, overlapping ones merged, replaced by a mask."""

    def step(done: Column, span: Column, local: Column, base: Column) -> Column:
        start, end = span["start"] - base, span["end"] - base
        between = F.substring(local, done["at"] + 1, start - done["at"])
        return F.struct(
            F.greatest(done["at"], end).alias("at"),
            F.when(start >= done["at"], F.concat(done["out"], between, F.lit(mask))).otherwise(done["out"]).alias("out"),
        )

    def after(done: Column, stretch: Column) -> Column:
        # the text of a stretch is cut out once and its spans are looked for in it alone
        end = F.greatest(done["at"], F.array_max(F.transform(stretch, lambda s: s["end"])))
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        out = once(
            F.substring(text, done["at"] + 1, end - done["at"]),
            lambda local: F.aggregate(
                stretch, start, lambda inner, s: step(inner, s, local, done["at"]), lambda inner: inner["out"]
            ),
        )
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(out)).alias("out"))

    def rest(done: Column) -> Column:
        return F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text)))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    replaced = once(spans, lambda known: F.aggregate(stretches(known), start, after, rest))
    return F.when(F.size(spans) > 0, replaced).otherwise(text)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document: doc_id, a count for each base rule, the digest of the base spans, all spans as text."""
    found = scan(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "doc_id", "text", rules)
    base = [k for k, rule in enumerate(rules) if rule.base]
    of_base = F.filter("secrets", lambda s: s["rank"].isin(*base))

    def number(k: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["rank"] == k)).cast("long")

    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{rules[k].kind}") for k in base],
        F.sha2(spans_text(of_base), 256).alias("base_sha256"),
        spans_text(F.col("secrets")).alias("spans"),
    )


def report_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL for :func:`report` over the table ``documents``."""
    parts = []
    for order, rule in enumerate(rules):
        around = rf"(?s)(.*?)(?:({rule.pattern})|\z)".replace("'", "''")
        parts.append(
            f"SELECT doc_id, {order} AS rnk, '{rule.kind}' AS kind, generate_subscripts(gaps, 1) AS i, unnest(gaps) AS gap, "
            f"unnest(matches) AS match, unnest(vals) AS val, {rule.least} AS least, {str(rule.base).lower()} AS base "
            f"FROM (SELECT doc_id, regexp_extract_all(text, '{around}', 1) AS gaps, "
            f"regexp_extract_all(text, '{around}', 2) AS matches, regexp_extract_all(text, '{around}', {2 + rule.group}) AS vals "
            f"FROM docs)"
        )
    counts = ", ".join(
        f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in rules if rule.base
    )
    zeros = ", ".join(f"coalesce(n_{rule.kind}, 0) AS n_{rule.kind}" for rule in rules if rule.base)
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS ({' UNION ALL '.join(parts)}),
placed AS (
  SELECT *, sum(length(gap) + length(match)) OVER (PARTITION BY doc_id, rnk ORDER BY i) AS stop FROM parts
),
spans AS (
  SELECT doc_id, rnk, kind, base, (stop - length(match))::BIGINT AS start,
    kind || ':' || (stop - length(match))::BIGINT || ':' || stop::BIGINT AS span
  FROM placed WHERE length(match) > 0 AND length(val) >= least
),
joined AS (
  SELECT doc_id, {counts}, coalesce(string_agg(span, ',' ORDER BY start, rnk) FILTER (base), '') AS base_spans,
    string_agg(span, ',' ORDER BY start, rnk) AS spans
  FROM spans GROUP BY doc_id
)
SELECT doc_id, {zeros}, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (doc_id)"""
