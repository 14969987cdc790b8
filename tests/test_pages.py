"""Landings as published: page files of arrays, quarantine of broken texts, drift by key."""

import json
import os

import pytest
from pyspark.sql import functions as F

from enrolmart.plans.relations import release
from enrolmart.schemas import BY_STATE, DIMENSIONS, MEASURES
from enrolmart.sources import pages

from conftest import SF_SMALL

EXPECTED = {"YEAR": "error", "MONTH": "error", "TOT_BENES": "warn", "AGED_TOT_BENES": "warn"}


def records(start, n):
    return [{"YEAR": "2024", "MONTH": "May", "TOT_BENES": str(k)} for k in range(start, start + n)]


def land(path, sizes, indent=None, end=True):
    os.makedirs(path)
    at = 0
    for n in sizes:
        with open(f"{path}/page-{at:06d}.json", "w") as f:
            json.dump(records(at, n), f, indent=indent)
        at += n
    if end:
        with open(f"{path}/page-{at:06d}.json", "w") as f:
            f.write("[]\n")
    return at


def faults(spark, path):
    told = [(r.page_offset, r.n_rows, r.fault, r.ends) for r in pages.page_faults(spark, path).collect()]
    return sorted(told, key=lambda t: (t[0] is None, t[0]))


@pytest.mark.parametrize("indent", [None, 2])
def test_pages_on_one_line_and_on_many(spark, tmp_path, indent):
    path = str(tmp_path / "landing")
    total = land(path, [3, 3, 2], indent)
    got = pages.page_records(spark, path)
    assert got.count() == total == pages.require_pages(spark, path)
    assert sorted(int(r.TOT_BENES) for r in got.collect()) == list(range(total))
    assert {r.page_offset for r in got.collect()} == {0, 3, 6}
    assert faults(spark, path) == [(0, 3, None, False), (3, 3, None, False), (6, 2, None, False), (8, 0, None, True)]


@pytest.mark.parametrize("lost", [0, 3, 6])
def test_a_missing_page_shows(spark, tmp_path, lost):
    path = str(tmp_path / "landing")
    land(path, [3, 3, 2])
    os.remove(f"{path}/page-{lost:06d}.json")
    after = {0: 3, 3: 6, 6: 8}[lost]
    assert [f[0] for f in faults(spark, path) if f[2]] == [after]
    with pytest.raises(ValueError, match="gap"):
        pages.require_pages(spark, path)


def test_a_download_that_did_not_end(spark, tmp_path):
    land(str(tmp_path / "a"), [3, 3], end=False)
    with pytest.raises(ValueError, match="did not end"):
        pages.require_pages(spark, str(tmp_path / "a"))
    land(str(tmp_path / "b"), [1] * 4)
    with pytest.raises(ValueError, match="limit of 4 pages"):
        pages.require_pages(spark, str(tmp_path / "b"), max_pages=4)
    # A file without a byte is no empty page.
    land(str(tmp_path / "c"), [2], end=False)
    open(tmp_path / "c" / "page-000002.json", "w").close()
    with pytest.raises(ValueError):
        pages.require_pages(spark, str(tmp_path / "c"))


def test_broken_twice_and_nameless_pages(spark, tmp_path):
    path = str(tmp_path / "landing")
    land(path, [3, 3, 2])
    with open(f"{path}/page-000003.json", "w") as f:
        f.write(json.dumps(records(3, 3))[:-9])
    with open(f"{path}/page-6.json", "w") as f:
        json.dump(records(6, 2), f)
    with open(f"{path}/more.json", "w") as f:
        json.dump(records(0, 1), f)
    told = sorted(((o, f) for o, _, f, _ in faults(spark, path)), key=lambda t: (t[0] is None, t[0]))
    assert told == [(0, None), (3, "broken"), (6, "twice"), (6, "twice"), (8, None), (None, "no offset")]


def test_trailing_text_is_broken(spark, tmp_path):
    path = str(tmp_path / "landing")
    land(path, [2])
    with open(f"{path}/page-000000.json", "a") as f:
        f.write(" <html>error</html>")
    assert faults(spark, path)[0][2] == "broken"


def test_broken_page_is_quarantined_whole(spark, tmp_path):
    path = str(tmp_path / "landing")
    land(path, [3, 3, 2])
    cut = json.dumps(records(3, 3))[:-9]
    with open(f"{path}/page-000003.json", "w") as f:
        f.write(cut)
    found = pages.quarantine(pages.page_records(spark, path), str(tmp_path / "out"))
    assert (found.n_good, found.n_broken) == (5, 1)
    assert sorted(int(r.TOT_BENES) for r in found.good.collect()) == [0, 1, 2, 6, 7]
    assert [(r.page_offset, r.broken_text) for r in found.broken.collect()] == [(3, cut)]
    with pytest.raises(ValueError, match="1 broken"):
        pages.quarantine(pages.page_records(spark, path), str(tmp_path / "strict"), max_broken=0)


def test_lines_and_csv(spark, tmp_path):
    lines = [json.dumps(r) for r in records(0, 4)] + ['{"YEAR": "20', "not json"]
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text("\n".join(lines))
    found = pages.quarantine(pages.line_records(spark, str(tmp_path / "lines")), str(tmp_path / "out"))
    assert (found.n_good, found.n_broken) == (4, 2)
    assert sorted(r.broken_text for r in found.broken.collect()) == sorted(lines[4:])

    names = [f.name for f in BY_STATE.fields]
    row = {"year": "2024", "state": "TX"}
    good = ",".join(row.get(n, "") for n in names)  # missing cells are NULLs
    bad = [good.replace("2024", "20x4"), "2024,TX", good + ",more"]
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text("\n".join([",".join(names), good, *bad]))
    found = pages.quarantine(pages.csv_records(spark, str(tmp_path / "csv"), BY_STATE), str(tmp_path / "out2"))
    assert (found.n_good, found.n_broken) == (1, 3)
    kept = found.good.collect()[0]
    assert kept.year == 2024 and kept.state == "TX" and kept.fips_code is None
    assert sorted(r.broken_text for r in found.broken.collect()) == sorted(bad)


def test_nothing_broken_or_nothing_at_all(spark, tmp_path):
    land(str(tmp_path / "a"), [2])
    found = pages.quarantine(pages.page_records(spark, str(tmp_path / "a")), str(tmp_path / "o1"), max_broken=0)
    assert found.good.count() == 2 and found.broken.count() == 0
    land(str(tmp_path / "b"), [])
    found = pages.quarantine(pages.page_records(spark, str(tmp_path / "b")), str(tmp_path / "o2"))
    assert (found.n_good, found.n_broken, found.good.count(), found.broken.count()) == (0, 0, 0, 0)
    assert pages.require_pages(spark, str(tmp_path / "b")) == 0


def drift(df):
    return sorted((r.column_name, r.drift, r.severity) for r in df.collect())


@pytest.mark.parametrize("page_files", [True, False])
def test_drift_tells_absent_null_and_new_keys_apart(spark, tmp_path, page_files):
    rows = [{"YEAR": None, "TOT_BENES": str(k), "FLAG": "x"} for k in range(5)] + [{"TOT_BENES": "9", "AGED_TOT_BENES": None}]
    (tmp_path / "in").mkdir()
    text = json.dumps(rows) if page_files else "\n".join(map(json.dumps, rows)) + '\n{"cut'
    (tmp_path / "in" / "page-0.json").write_text(text)
    texts = pages.record_texts(spark, str(tmp_path / "in"), page_files)
    got = drift(pages.schema_drift(texts, "landed", EXPECTED))
    assert got == [
        ("AGED_TOT_BENES", "always_null", "warn"),
        ("FLAG", "unexpected", "warn"),
        ("MONTH", "absent", "error"),
        ("YEAR", "always_null", "warn"),
    ]


def test_drift_of_an_empty_landing(spark):
    texts = spark.createDataFrame([], "record string")
    assert [x[1] for x in drift(pages.schema_drift(texts, "landed", EXPECTED))] == ["absent"] * 4


def test_landed_page_files_hold_whole_pages(spark, tmp_path):
    landed = release(spark, SF_SMALL).landed
    path = str(tmp_path / "pages")
    pages.land_page_files(landed, path, 1000)
    total = landed.count()
    told = faults(spark, path)
    assert [t[0] for t in told] == [*range(0, total, 1000), total] and not any(t[2] for t in told)
    back = pages.page_records(spark, path).drop("page_offset", "file", pages.BROKEN_COL)
    upper = landed.toDF(*[c.upper() for c in landed.columns])
    assert back.exceptAll(upper).isEmpty() and upper.exceptAll(back).isEmpty()
    names = {c.upper(): "warn" for c in DIMENSIONS + MEASURES}
    told = drift(pages.schema_drift(pages.record_texts(spark, path, True), "landed", names))
    nulls = [c for c in landed.columns if landed.where(F.col(c).isNotNull()).isEmpty()]
    assert told == sorted((c.upper(), "always_null", "warn") for c in nulls)
