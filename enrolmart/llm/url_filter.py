"""URL filters: exact membership of listed keys through a cascade of Bloom filters.

A key is a host (or parent domain) followed by a path prefix, such as
``example.com/en/``; a bare host has an empty path.  The key universe is every
key of every url in the corpus that a listed key could equal.  Level one of a
cascade is a Bloom filter of the listed keys.  Level two encodes the keys of
the universe that pass level one falsely, level three the listed keys that
pass level two falsely, and so on until a level lets nothing false through.
For every key of the universe, the first level that it fails then tells
exactly whether it is listed, so urls are judged in the scan, without a join.

Level one has about log2(universe / listed) bits a key and the others two, so
the bits grow with the listed keys, not with the corpus.  They are literals
of the judging expression, checked against ``max_bits``; longer lists are
joined to the urls' keys instead.

Everything is DataFrame functions.  Defined cases: a null url, or one without
``://``, has an empty host and path and fits no rule; repeated urls are judged
alike; a key listed twice counts once; empty lists allow everything; an empty
table gives an empty result.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrolmart.llm.common import ascii_lower, col, let, staged

# The rules (host, path, verdict) of the registered query.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# Names whose hosts are blocked where no rule fits.
BLOCKED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
BLOCKED_HOSTS = tuple(f"{n}.example.{top}" for n in BLOCKED_NAMES for top in ("com", "net", "org"))
MAX_BITS = 1 << 23


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII folded) and path of a url, both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def keys_of(host: Column, path: Column, listed: Iterable[tuple[str, str]]) -> Column:
    """array<string>: the host's domains of listed depths times the path's prefixes of listed lengths."""
    listed = list(listed)
    depth = max((h.count(".") + 1 for h, _ in listed), default=0)
    lengths = sorted({len(p) for _, p in listed})
    if not listed:
        return F.array().cast("array<string>")
    prefixes = F.filter(
        F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]),
        lambda p: p.isNotNull(),
    )
    # The host's last labels: -1 counts from the right.
    domains = F.filter(
        F.array(
            *[
                F.when(
                    F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) >= n,
                    F.substring_index(host, ".", -(n + 1)),
                )
                for n in range(depth)
            ]
        ),
        lambda d: d.isNotNull() & (d != ""),
    )
    return let(
        prefixes,
        lambda ps: F.flatten(F.transform(domains, lambda d: F.transform(ps, lambda p: F.concat(d, p)))),
    )


def _positions(key: Column, level: dict) -> list[Column]:
    return [
        F.pmod(F.xxhash64(key, F.lit(level["seed"] * 64 + j)), F.lit(level["bits"]))
        for j in range(level["hashes"])
    ]


def _passes(key: Column, level: dict) -> Column:
    """Whether all the key's bits are set; the words are a constant of the plan."""
    words = F.from_json(F.lit(json.dumps(level["words"])), "array<bigint>")
    ok = F.lit(True)
    for p in _positions(key, level):
        word = F.get(words, F.shiftright(p, 6).cast("int"))
        ok = ok & (F.getbit(word, F.pmod(p, F.lit(64)).cast("int")) == 1)
    return ok


def _level(keys: DataFrame, n: int, bits_per_key: float, seed: int) -> dict:
    """A Bloom filter of ``keys``: its words are or-ed together by Spark, one row per word."""
    bits = max(64, 64 * math.ceil(n * bits_per_key / 64))
    level = {"seed": seed, "bits": bits, "hashes": max(1, round(0.69 * bits_per_key))}
    p = F.col("p")
    one = F.expr("shiftleft(1L, cast(pmod(p, 64) as int))")
    words = (
        keys.select(F.explode(F.array(*_positions(F.col("key"), level))).alias("p"))
        .groupBy(F.shiftright(p, 6).alias("w"))
        .agg(F.bit_or(one).alias("bits"))
        .collect()
    )  # at most bits / 64 rows
    level["words"] = [0] * (bits // 64)
    for r in words:
        level["words"][r["w"]] = r["bits"]
    return level


def build(universe: DataFrame, flag: str, max_bits: int = MAX_BITS) -> list[dict] | None:
    """The cascade's levels for the keys with ``flag`` in (key, flag ...); None beyond max_bits."""
    n_listed, n_all = universe.agg(F.count(F.when(F.col(flag), 1)), F.count(F.lit(1))).first()
    left, inside, levels, used = universe, True, [], 0
    n = n_listed
    while n:
        per_key = max(2.0, 1.44 * math.log2(max(2.0, (n_all - n_listed) / n))) if not levels else 2.0
        used += max(64, n * per_key)
        if used > max_bits:
            return None
        own = left.where(F.col(flag) == inside)
        levels.append(_level(own.select("key"), n, per_key, len(levels) + 1))
        # The other side's keys that pass are what the next level encodes.
        left = left.where(_passes(F.col("key"), levels[-1]))
        inside = not inside
        n = left.where(F.col(flag) == inside).count()
    return levels


def is_listed(key: Column, levels: list[dict]) -> Column:
    """Exact for keys of the universe: decided by the first level that the key fails."""
    out = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        out = F.when(_passes(key, levels[i]), out).otherwise(F.lit(i % 2 == 1))
    return out


def judge(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]] = RULES,
    blocked_hosts: Iterable[str] = BLOCKED_HOSTS,
    id_col: str = "page_id",
    url_col: str = "url",
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """page_id, host, path, rule (the longest that fits, or null), verdict.

    Where no rule fits, a url is blocked if its host or a parent domain is listed as blocked.
    """
    spark = pages.sparkSession
    rules = [(h, p, v) for h, p, v in rules]
    hosts = list(blocked_hosts)
    host, path = host_path(col(url_col))
    urls = pages.select(col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule_keys = keys_of(F.col("host"), F.col("path"), [(h, p) for h, p, _ in rules])
    host_keys = keys_of(F.col("host"), F.lit(""), [(h, "") for h in hosts])
    urls = urls.withColumns({"rule_keys": rule_keys, "host_keys": host_keys})

    listed = [(h + p, True, v == "block", False) for h, p, v in rules]
    listed += [(h, False, False, True) for h in hosts]
    listed = spark.createDataFrame(
        listed, "key string, is_rule boolean, blocks boolean, is_host boolean"
    )
    found = urls.select(F.explode(F.array_union("rule_keys", "host_keys")).alias("key")).distinct()
    none = F.lit(False)
    universe = staged(
        found.select("key", none.alias("is_rule"), none.alias("blocks"), none.alias("is_host"))
        .union(listed)
        .groupBy("key")
        .agg(*[F.max(c).alias(c) for c in ("is_rule", "blocks", "is_host")]),
        "url-keys",
    )
    cascades = {c: build(universe, c, max_bits) for c in ("is_rule", "blocks", "is_host")}
    if any(levels is None for levels in cascades.values()):
        return _joined(urls, universe)
    rule = let(
        F.filter("rule_keys", lambda k: is_listed(k, cascades["is_rule"])),
        lambda ks: F.array_max(F.transform(ks, lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))))["k"],
    )
    by_host = F.exists("host_keys", lambda k: is_listed(k, cascades["is_host"]))
    return (
        urls.withColumn("rule", rule)
        .withColumn(
            "blocked",
            F.when(F.col("rule").isNull(), by_host).otherwise(
                is_listed(F.col("rule"), cascades["blocks"])
            ),
        )
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.when(F.col("blocked"), "block").otherwise("allow").alias("verdict"),
        )
    )


def _joined(urls: DataFrame, universe: DataFrame) -> DataFrame:
    """The same verdicts for lists too long to be literals: keys joined to the listed ones."""
    listed = universe.where("is_rule or is_host")
    best = F.max(
        F.when(F.col("is_rule"), F.struct(F.length("key").alias("n"), "key", "blocks"))
    ).alias("best")
    judged = (
        urls.select("host", "path", "rule_keys", "host_keys")
        .distinct()
        .select("host", "path", F.explode(F.array_union("rule_keys", "host_keys")).alias("key"))
        .join(listed, "key")
        .groupBy("host", "path")
        .agg(best, F.max("is_host").alias("by_host"))
        .withColumnsRenamed({"host": "h", "path": "p"})
    )
    out = urls.join(judged, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    blocked = F.coalesce("best.blocks", "by_host", F.lit(False))
    return out.select(
        "page_id",
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.when(blocked, "block").otherwise("allow").alias("verdict"),
    )


def op8(pages: DataFrame) -> DataFrame:
    return judge(pages)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows)


SQL = f"""
WITH rules(h, p, v) AS (VALUES {_values(RULES)}),
blocked(b) AS (VALUES {_values([(h,) for h in BLOCKED_HOSTS])}),
rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3)
                       ELSE '' END AS r
  FROM pages
), u AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), fits AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id
), hosts AS (
  SELECT DISTINCT page_id FROM u JOIN blocked ON host = b OR ends_with(host, '.' || b)
)
SELECT u.page_id, host, path, rule,
       coalesce(v, CASE WHEN hosts.page_id IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN fits USING (page_id) LEFT JOIN hosts USING (page_id)
"""
