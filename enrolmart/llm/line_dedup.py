"""Line dedup: globally repeated chunks of lines, cut where the content says so.

A text is split at line feeds.  A rolling hash over the hashes of the last
two lines decides whether a chunk ends after a line (one line in ``divisor``
on average), so an insertion moves boundaries only near itself.  A line of
more than ``solo_words`` words is a passage by itself and always its own
chunk.  Chunks of at least two lines, and solo lines, are candidates; those
without a visible character are not.

A candidate that occurs again anywhere in the corpus (same bytes, not just
same hash) is kept once: at its first place in the rows of the smallest
doc_id.  All its other occurrences are removed, line feeds between what is
left stay as they were.

The lines of a repeated passage before its first inner boundary and after
its last one share chunks with their surroundings, and short passages hold no
whole chunk.  So the window of two line hashes is looked at everywhere else
as well: two neighbouring lines that occur in this order at an earlier place
of the corpus are repeated, and runs of them are removed too if they have at
least three lines or more than ``solo_words`` words.  Whatever surrounds it,
a passage of whole lines that long stays at its first place only.

Everything is DataFrame functions.  Hashes alone find what may repeat (a map-
side sum, so a chunk held by a third of all rows is one row per task); only
occurrences of those carry their bytes on, which the second grouping
compares.  Windows carry hashes only: one grouping of all lines by hash finds
hashes whose lines differ in a byte, and windows with such a hash don't count.

Defined cases: a null text stays null (it has no lines); an empty text is
one empty line and stays; rows that share an id count as parts of one
document, so each keeps its first occurrence of a chunk whose smallest id is
theirs; a null id sorts after all others; rows equal in id and text get equal
results; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrolmart.llm.common import col, let, staged

DIVISOR = 2
SOLO_WORDS = 50
# The rolling hash: (previous * FACTOR + current) / SHIFT, of 32-bit line hashes.
FACTOR = 1_000_003
SHIFT = 65_536
# A window's repeats are dealt to so many parts, for windows that are everywhere.
_DEAL = 8


def _words(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _chunks(text: Column, divisor: int, solo_words: int) -> Column:
    """array<struct<first, lines, solo, body>> of a text, in order (first is a line number)."""

    def of_lines(lines):
        hashes = F.transform(
            lines, lambda x: F.conv(F.substring(F.md5(x.cast("binary")), 1, 8), 16, 10).cast("long")
        )
        solo = F.transform(lines, lambda x: _words(x) > solo_words)
        return let(
            F.struct(lines.alias("l"), hashes.alias("h"), solo.alias("s")), lambda v: of_hashes(v)
        )

    def of_hashes(v):
        lines, h, solo = v["l"], v["h"], v["s"]

        def ends_before(i):
            """Whether a chunk starts at line i."""
            two_back = F.when(i >= 2, F.get(h, i - 2)).otherwise(F.lit(0))
            roll = F.floor((two_back * FACTOR + F.get(h, i - 1)) / SHIFT) % divisor
            return (i == 0) | F.get(solo, i) | F.get(solo, i - 1) | (roll == 0)

        starts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), ends_before)
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda first, k: let(
                    F.coalesce(F.get(s, k + 1), F.size(lines)) - first,
                    lambda n: F.struct(
                        first.alias("first"),
                        n.alias("lines"),
                        F.get(solo, first).alias("solo"),
                        F.array_join(F.slice(lines, first + 1, n), "\n").alias("body"),
                    ),
                ),
            ),
        )

    return let(F.split(text, "\n", -1), of_lines)


def _candidates(docs: DataFrame, divisor: int, solo_words: int) -> DataFrame:
    """(doc_id, text_md5, at, body) of every chunk that may be removed; at holds its first
    line's number and its number of lines."""
    c = F.col("c")
    return (
        docs.select("doc_id", "text_md5", F.explode(_chunks(F.col("text"), divisor, solo_words)).alias("c"))
        .where(((c["lines"] >= 2) | c["solo"]) & c["body"].rlike(r"\S"))
        .select(
            "doc_id",
            "text_md5",
            F.struct(c["first"].alias("first"), c["lines"].alias("lines")).alias("at"),
            c["body"].alias("body"),
        )
    )


def _later(places: DataFrame, *key: str) -> DataFrame:
    """(doc_id, text_md5, at) of all occurrences but the first, of rows that share a key.

    In texts with the smallest id the first occurrence stays, elsewhere none.
    """
    per_text = places.groupBy("doc_id", "text_md5", *key, "first_id").agg(F.collect_set("at").alias("all"))
    later = F.when(
        F.col("doc_id").eqNullSafe(F.col("first_id")),
        F.array_except("all", F.array(F.array_min("all"))),
    ).otherwise(F.col("all"))
    return per_text.select("doc_id", "text_md5", F.explode(later).alias("at"))


def repeated_chunks(docs: DataFrame, divisor: int, solo_words: int) -> DataFrame:
    """(doc_id, text_md5, line): the lines of chunks that occurred before."""
    places = _candidates(docs, divisor, solo_words).withColumn("hash", F.xxhash64("body"))
    maybe = places.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    again = staged(places.join(maybe, "hash"), "repeated-chunks")
    # Written, so that both sides of the join are plain shuffles, whose skew can be split.
    once = staged(
        again.groupBy("hash", "body")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))
        .where("n > 1")
        .drop("n"),
        "repeated-bodies",
    )
    held = again.join(once, ["hash", "body"]).withColumn("body", F.md5(F.col("body").cast("binary")))
    first, n = F.col("at.first"), F.col("at.lines")
    return _later(held, "hash", "body").select(
        "doc_id", "text_md5", F.explode(F.sequence(first, first + n - 1)).alias("line")
    )


def _windows(text: Column, solo_words: int) -> Column:
    """array<struct<no, a, b, enough>> of neighbouring lines: line number, both hashes, and
    whether the two hold more than solo_words words; without pairs that show nothing."""

    def of_lines(lines):
        each = F.transform(
            lines,
            lambda x: F.struct(
                F.xxhash64(x).alias("h"), _words(x).alias("w"), x.rlike(r"\S").alias("shows")
            ),
        )
        return let(
            each,
            lambda e: F.filter(
                F.transform(
                    F.slice(e, 1, F.size(e) - 1),
                    lambda x, i: let(
                        F.get(e, i + 1),
                        lambda y: F.when(
                            x["shows"] | y["shows"],
                            F.struct(
                                i.alias("no"),
                                x["h"].alias("a"),
                                y["h"].alias("b"),
                                (x["w"] + y["w"] > solo_words).alias("enough"),
                            ),
                        ),
                    ),
                ),
                lambda p: p.isNotNull(),
            ),
        )

    return let(F.split(text, "\n", -1), of_lines)


def repeated_windows(docs: DataFrame, solo_words: int) -> DataFrame:
    """(doc_id, text_md5, line): the lines of runs of windows that occurred before."""
    lines = docs.select(F.explode(F.split("text", "\n", -1)).alias("line"))
    # Hashes whose lines are not all the same bytes.
    unlike = staged(
        lines.groupBy(F.xxhash64("line").alias("h"))
        .agg(F.min("line").alias("low"), F.max("line").alias("high"))
        .where("low <> high")
        .select("h"),
        "unlike-lines",
    )
    w = F.col("w")
    places = docs.select(
        "doc_id", "text_md5", F.explode(_windows(F.col("text"), solo_words)).alias("w")
    ).select(
        "doc_id",
        "text_md5",
        F.struct(w["no"].alias("no"), w["enough"].alias("enough")).alias("at"),
        w["a"].alias("a"),
        w["b"].alias("b"),
        F.pmod(F.xxhash64("text_md5"), F.lit(_DEAL)).alias("deal"),
    )
    for end in ("a", "b"):
        places = places.join(unlike, F.col(end) == F.col("h"), "left_anti")
    seen = (
        places.groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))
        .where("n > 1")
        .select("a", "b", "first_id", F.explode(F.array(*map(F.lit, range(_DEAL)))).alias("d"))
        .select("a", "b", "first_id", F.col("d").cast("long").alias("deal"))
    )
    later = _later(places.join(seen, ["a", "b", "deal"]), "a", "b")
    runs = later.groupBy("doc_id", "text_md5").agg(F.sort_array(F.collect_set("at")).alias("r"))
    long = F.filter(
        "r",
        lambda x, k: x["enough"]
        | F.coalesce(F.get("r", k + 1)["no"] == x["no"] + 1, F.lit(False))
        | F.coalesce(F.get("r", k - 1)["no"] == x["no"] - 1, F.lit(False)),
    )
    return runs.select("doc_id", "text_md5", F.explode(long).alias("x")).select(
        "doc_id", "text_md5", F.explode(F.array("x.no", F.col("x.no") + 1)).alias("line")
    )


def repeated(docs: DataFrame, divisor: int = DIVISOR, solo_words: int = SOLO_WORDS) -> DataFrame:
    """(doc_id, text_md5, gone): the line numbers to remove per (id, text) that has any, sorted.

    ``docs`` has (doc_id, text, text_md5).  A row pair equal in id and text counts as one row.
    """
    return (
        repeated_chunks(docs, divisor, solo_words)
        .union(repeated_windows(docs, solo_words))
        .groupBy("doc_id", "text_md5")
        .agg(F.sort_array(F.collect_set("line")).alias("gone"))
    )


def _without(text: Column, gone: Column) -> Column:
    """struct<text, lines>: the text without the lines of the sorted numbers ``gone``."""

    def kept(v):
        """The stretches between removed lines."""
        parts = F.transform(
            F.slice(v["g"], 2, F.size(v["g"]) - 1),
            lambda end, k: F.slice(v["l"], F.get(v["g"], k) + 2, end - F.get(v["g"], k) - 1),
        )
        return let(
            F.flatten(parts),
            lambda left: F.struct(
                F.array_join(left, "\n").alias("text"), F.size(left).alias("lines")
            ),
        )

    lines = F.split(text, "\n", -1)
    framed = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    return let(F.struct(lines.alias("l"), framed.alias("g")), kept)


def dedup(
    docs: DataFrame,
    divisor: int = DIVISOR,
    solo_words: int = SOLO_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All columns of ``docs`` with the shortened text, then __lines and __removed (line counts)."""
    names = [c for c in docs.columns if c != text_col]
    keyed = docs.select(
        F.struct(*[col(c) for c in names]).alias("rest"),
        col(id_col).cast("long").alias("doc_id"),
        col(text_col).cast("string").alias("text"),
    ).withColumn("text_md5", F.md5(F.col("text").cast("binary")))
    found = repeated(keyed.select("doc_id", "text", "text_md5"), divisor, solo_words).select(
        F.col("doc_id").alias("r_id"), F.col("text_md5").alias("r_md5"), "gone"
    )
    joined = keyed.join(
        found,
        F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_md5") == F.col("r_md5")),
        "left",
    )
    lines = F.size(F.split("text", "\n", -1))
    out = joined.select(
        "rest",
        "text",
        F.when(F.col("gone").isNotNull(), _without(F.col("text"), F.col("gone"))).alias("left"),
        lines.alias("n"),
    ).select(
        "rest",
        F.coalesce("left.text", "text").alias("text"),
        F.greatest("n", F.lit(0)).cast("long").alias("lines"),
        F.coalesce(F.col("n") - F.col("left.lines"), F.lit(0)).cast("long").alias("removed"),
    )
    return out.select(
        *[
            F.col("text").alias(text_col) if c == text_col else F.col("rest").getField(c).alias(c)
            for c in docs.columns
        ],
        F.col("lines").alias("__lines"),
        F.col("removed").alias("__removed"),
    )


def op1(docs: DataFrame) -> DataFrame:
    return dedup(docs).select(
        "doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), "text"
    )


SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS i
  FROM documents WHERE text IS NOT NULL
), h AS (
  SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h,
         length(line) - length(replace(line, ' ', '')) >= {SOLO_WORDS} AS solo
  FROM l
), p AS (
  SELECT *, lag(h, 1) OVER w AS h1, coalesce(lag(h, 2) OVER w, 0) AS h2,
         lag(solo, 1) OVER w AS solo1
  FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), c AS (
  SELECT *, sum(CASE WHEN i = 0 OR solo OR solo1
                       OR ((h2 * {FACTOR} + h1) // {SHIFT}) % {DIVISOR} = 0 THEN 1 ELSE 0 END)
            OVER (PARTITION BY doc_id ORDER BY i) AS no
  FROM p
), chunk AS (
  SELECT doc_id, no, count(*) AS n, bool_or(solo) AS solo,
         string_agg(line, chr(10) ORDER BY i) AS body
  FROM c GROUP BY doc_id, no
), ranked AS (
  SELECT *, (n >= 2 OR solo) AND regexp_matches(body, '\\S')
            AND row_number() OVER (PARTITION BY body, (n >= 2 OR solo) ORDER BY doc_id, no) > 1 AS gone
  FROM chunk
), two AS (
  SELECT doc_id, i, line, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS below FROM l
), w AS (
  SELECT *, below IS NOT NULL AND regexp_matches(line || below, '\\S')
            AND row_number() OVER (PARTITION BY line, below ORDER BY doc_id, i) > 1 AS again,
         length(line) - length(replace(line, ' ', ''))
         + length(below) - length(replace(below, ' ', '')) + 2 > {SOLO_WORDS} AS enough
  FROM two
), run AS (
  SELECT doc_id, i, again AND (enough OR coalesce(lag(again) OVER v, FALSE)
                               OR coalesce(lead(again) OVER v, FALSE)) AS long
  FROM w WINDOW v AS (PARTITION BY doc_id ORDER BY i)
), told AS (
  SELECT doc_id, i, long OR coalesce(lag(long) OVER (PARTITION BY doc_id ORDER BY i), FALSE) AS gone
  FROM run
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT (r.gone OR t.gone)) AS body,
         count(*) AS n_lines, count(*) FILTER (WHERE r.gone OR t.gone) AS n_removed
  FROM c JOIN ranked r USING (doc_id, no) JOIN told t USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0)::BIGINT AS n_lines,
       coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.body, '') END AS text
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
