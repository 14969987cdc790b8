"""Secret scans over a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived:
clauses of trigrams that every match contains, joined by or.  The index holds
postings (trigram, text) for the trigrams that some query names, over texts
with ASCII letters folded.  A text is a candidate of a rule if the postings
of all trigrams of one clause contain it; candidates are verified with the
regular expression itself.  A rule without mandatory trigrams (a run of hex
digits, say) scans every text.

Matches are leftmost and do not overlap; those that fail a rule's length test
are dropped afterwards, so they still hide what they cover.  Spans count code
points, their end is exclusive.

Everything on the main path is DataFrame functions; only the derivation of
the queries (a few rules) runs in the driver.  Defined cases: null and empty
texts have no spans; repeated rows get equal results; a null id is kept; an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as node
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrolmart.llm.common import ascii_lower, id_text, let


@dataclass(frozen=True)
class Rule:
    """A match counts if capture group ``group`` has at least ``least`` code points."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0


# The base kinds, in order, with their patterns and lengths.
BASE = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
# Kinds that this operator adds.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/=-]{16,}"),
)
RULES = BASE + MORE
# Exact string sets larger than this are given up (their trigrams so far are kept).
_MOST_STRINGS = 64
_MOST_CHARS = 8

Clauses = frozenset  # of frozensets of trigrams; the empty clause asks for nothing
ANYTHING: Clauses = frozenset([frozenset()])


def _absorb(clauses) -> Clauses:
    """Without clauses that ask for more than another one does."""
    return frozenset(c for c in clauses if not any(o < c for o in clauses))


def _both(a: Clauses, b: Clauses) -> Clauses:
    return _absorb({x | y for x, y in product(a, b)})


def _contains(strings) -> Clauses:
    return _absorb({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _fold(code: int) -> str:
    c = chr(code)
    return c.lower() if c.isascii() else c


def _walk(items) -> tuple[set[str] | None, Clauses]:
    """(all strings that the sequence matches, folded, or None if unknown; its query)."""
    current, query, whole = {""}, ANYTHING, True
    for op, arg in items:
        strings, own = _one(op, arg)
        if strings is not None and len(current) * len(strings) <= _MOST_STRINGS:
            current = {a + b for a, b in product(current, strings)}
            continue
        query = _both(query, _contains(current))
        if strings is None:
            query, current = _both(query, own), {""}
        else:
            current = strings
        whole = False
    return (current, query) if whole else (None, _both(query, _contains(current)))


def _one(op, arg) -> tuple[set[str] | None, Clauses]:
    if op is node.LITERAL:
        return {_fold(arg)}, ANYTHING
    if op is node.IN:
        chars = set()
        for kind, value in arg:
            if kind is node.LITERAL:
                chars.add(_fold(value))
            elif kind is node.RANGE and value[1] - value[0] < _MOST_CHARS:
                chars |= {_fold(c) for c in range(value[0], value[1] + 1)}
            else:
                return None, ANYTHING
        return (chars, ANYTHING) if len(chars) <= _MOST_CHARS else (None, ANYTHING)
    if op is node.SUBPATTERN:
        return _walk(arg[3])
    if op is node.BRANCH:
        parts = [_walk(p) for p in arg[1]]
        if all(s is not None for s, _ in parts):
            return set().union(*(s for s, _ in parts)), ANYTHING
        return None, _absorb(
            set().union(*(_contains(s) if s is not None else q for s, q in parts))
        )
    if op in (node.MAX_REPEAT, node.MIN_REPEAT):
        low, high, inner = arg
        strings, query = _walk(inner)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, ANYTHING
        if low == 0:
            return None, ANYTHING
        return None, _contains(strings) if strings is not None else query
    return None, ANYTHING  # anything else promises nothing


def trigram_query(regex: str) -> Clauses:
    """Clauses of trigrams (ASCII folded) of which every match satisfies one."""
    strings, query = _walk(_parser.parse(regex))
    return _contains(strings) if strings is not None else query


def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index (trigram, key): one row per text and trigram that it contains."""
    held = let(
        ascii_lower(F.col("text")),
        lambda t: F.filter(F.array(*[F.lit(g) for g in trigrams]), lambda g: F.contains(t, g)),
    )
    return texts.select(_key().alias("key"), F.explode(held).alias("trigram"))


def candidates(texts: DataFrame, queries: dict[int, Clauses]) -> DataFrame:
    """(key, rules): the texts that satisfy a clause, with the numbers of the rules concerned.

    Intersecting postings: each trigram of a clause is a bit, and a text that
    has them all has all bits.  Trigrams repeat in no clause, and repeated
    rows set the same bits.
    """
    rows = [
        (rule, n, trigram, 1 << i, (1 << len(clause)) - 1)
        for rule, clauses in queries.items()
        for n, clause in enumerate(sorted(map(sorted, clauses)))
        for i, trigram in enumerate(clause)
    ]
    terms = texts.sparkSession.createDataFrame(
        rows, "rule int, clause int, trigram string, bit long, whole long"
    )
    index = postings(texts, sorted({r[2] for r in rows}))
    return (
        index.join(F.broadcast(terms), "trigram")  # as many rows as the rules have trigrams
        .groupBy("key", "rule", "clause", "whole")
        .agg(F.bit_or("bit").alias("bits"))
        .where("bits = whole")
        .groupBy("key")
        .agg(F.collect_set("rule").alias("rules"))
    )


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """array<struct<start, kind_no, end>> of a rule's matches in a text that has one."""
    regex = F.lit(rule.regex)

    def placed(v):
        """The places are running sums over gaps and matches, by doubling steps: every step
        adds to each sum the one as many matches before it, so n matches take log n passes."""
        n = F.size(v["m"])
        sizes = F.transform(
            v["m"], lambda m, i: (F.length(F.get(v["gaps"], i)) + F.length(m)).cast("long")
        )
        steps = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda step: step < n)
        ends = F.aggregate(
            steps,
            sizes,
            lambda sums, step: F.transform(
                sums,
                lambda x, i: x + F.when(i >= step, F.get(sums, i - step)).otherwise(F.lit(0)),
            ),
        )
        return let(
            ends,
            lambda ends: F.filter(
                F.transform(
                    v["m"],
                    lambda m, i: F.when(
                        F.length(F.get(v["g"], i) if rule.group else m) >= rule.least,
                        F.struct(
                            (F.get(ends, i) - F.length(m)).cast("long").alias("start"),
                            F.lit(number).alias("kind_no"),
                            F.get(ends, i).alias("end"),
                        ),
                    ),
                ),
                lambda s: s.isNotNull(),
            ),
        )

    parts = [
        F.regexp_extract_all(text, regex, F.lit(0)).alias("m"),
        F.split(text, rule.regex, -1).alias("gaps"),
    ]
    if rule.group:
        parts.append(F.regexp_extract_all(text, regex, F.lit(rule.group)).alias("g"))
    found = F.struct(*parts)
    none = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>")
    return F.when(F.rlike(text, regex), let(found, placed)).otherwise(none)


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text, spans (start, kind_no, end, kind), ordered by start and then rule."""
    texts = id_text(docs, id_col, text_col)
    queries = {i: trigram_query(r.regex) for i, r in enumerate(rules)}
    indexed = {i: q for i, q in queries.items() if q != ANYTHING}
    none = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>")
    keyed = texts.withColumn("key", _key())
    if indexed:
        keyed = keyed.join(candidates(texts, indexed), "key", "left")
    parts = [
        F.when(F.array_contains("rules", i), _spans(F.col("text"), r, i)).otherwise(none)
        if i in indexed
        else _spans(F.col("text"), r, i)
        for i, r in enumerate(rules)
    ]
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    spans = F.transform(
        F.array_sort(F.concat(none, *parts)),
        lambda s: s.withField("kind", F.get(kinds, s["kind_no"])),
    )
    return keyed.select("doc_id", "text", spans.alias("spans"))


def as_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def op2(docs: DataFrame) -> DataFrame:
    def count(i):
        return F.size(F.filter("spans", lambda s: s["kind_no"] == i)).cast("long")

    base = F.filter("spans", lambda s: s["kind_no"] < len(BASE))
    return scan(docs).select(
        "doc_id",
        *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)],
        F.sha2(as_text(base).cast("binary"), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
    )


def _sql_rule(number: int, rule: Rule) -> str:
    p = "'" + rule.regex.replace("'", "''").replace('\\"', '"') + "'"
    return f"""
  SELECT doc_id, {number} AS kind_no, '{rule.kind}' AS kind, {rule.least} AS least,
         unnest(range(len(regexp_extract_all(t, {p})))) AS i,
         unnest(regexp_extract_all(t, {p})) AS m,
         unnest(regexp_extract_all(t, {p}, {rule.group})) AS g,
         unnest(list_slice(regexp_split_to_array(t, {p}), 1, len(regexp_extract_all(t, {p})))) AS gap
  FROM d"""


_SQL_RULES = "\n  UNION ALL".join(_sql_rule(i, r) for i, r in enumerate(RULES))
SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({_SQL_RULES}
), s AS (
  SELECT *, (sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind_no ORDER BY i)
             - length(m))::BIGINT AS s
  FROM m
), k AS (
  SELECT doc_id, kind_no, s, kind || ':' || s || ':' || (s + length(m)) AS span
  FROM s WHERE length(g) >= least
), per AS (
  SELECT doc_id, count(*) FILTER (kind_no = 0) AS a, count(*) FILTER (kind_no = 1) AS b,
         count(*) FILTER (kind_no = 2) AS c,
         string_agg(span, ',' ORDER BY s, kind_no) FILTER (kind_no < {len(BASE)}) AS base,
         string_agg(span, ',' ORDER BY s, kind_no) AS spans
  FROM k GROUP BY doc_id
)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_id)
"""
