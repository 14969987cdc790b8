import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from enrolmart.llm import url_filter as U

RULES = (*U.RULES, ("", "/x", "block"), ("org", "", "block"), ("a.b.org", "/deep/path", "allow"))
HOSTS = ["example.com", "www.example.com", "m.example.com", "x.net", "net", "a.b.org", "c.a.b.org",
         "notexample.com", "com", "spam-farm.example.info", "free-bets.example.info", "com:80", "", "a..com", ".net"]
PATHS = ["", "/", "/en", "/en/", "/en/1", "/EN/", "/es/2", "/fr/", "/deep/path/z", "/deep", "/x"]
BLOCKED = ("example.info", "spam-farm.example.info")


@pytest.fixture(scope="module")
def urls():
    rnd = random.Random(1)
    out = [
        f"{rnd.choice(['http', 'HTTPS', ''])}://{rnd.choice([h, h.upper()])}{p}{rnd.choice(['', '?q=/en/', '#/fr/'])}"
        for h in HOSTS
        for p in PATHS
        for _ in range(2)
    ]
    out += [None, "", "no scheme", "x://y://z/en/", "http:/one", "://", "http://Ünicode.com/é"]
    return [(k, u) for k, u in enumerate(out)] + [(0, out[0]), (None, "http://net/es/")]


def brute(url, rules=RULES, blocked=BLOCKED):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]

    def under(h):
        return h != "" and (host == h or host.endswith("." + h))

    fits = [(len(h + p), h + p, v) for h, p, v in rules if under(h) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    return host, path, None, "block" if any(under(b) for b in blocked) else "allow"


def got(df, **options):
    rows = U.judge(df, RULES, BLOCKED, **options).collect()
    return Counter(tuple(r) for r in rows)


def test_against_the_definition(frame, urls):
    want = Counter((k, *brute(u)) for k, u in urls)
    df = frame(urls, "page_id long, url string")
    assert got(df) == want
    assert got(df, max_bits=1) == want  # the joined way, for lists beyond the bound


def test_empty(frame):
    df = frame([], "page_id long, url string")
    assert U.op8(df).collect() == []
    one = frame([(1, "http://net/es/")], "page_id long, url string")
    assert [r.verdict for r in U.judge(one, (), ()).collect()] == ["allow"]


@pytest.mark.parametrize("listed, others", [(1, 500), (200, 5000), (3000, 3000), (50, 0), (0, 50)])
def test_cascade_is_exact(spark, listed, others):
    universe = spark.range(listed + others).select(
        F.concat(F.lit("key"), "id").alias("key"), (F.col("id") < listed).alias("flag")
    )
    levels = U.build(universe, "flag")
    wrong = universe.where(U.is_listed(F.col("key"), levels) != F.col("flag"))
    assert wrong.count() == 0
    if listed >= 200 and others > listed:
        assert len(levels) > 1
