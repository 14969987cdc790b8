import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from enrolmart.llm import decontam, line_dedup, packing, simhash, toxicity
from enrolmart.llm.common import staged, table

SF = "/root/testdata/sf0.001"


def test_stage_names():
    assert [n for n, _ in P.STAGES] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "packing",
    ]
    assert P.ORACLE_SQL is None


def test_each_stage_against_its_operator(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in P.STAGES:
        out = staged(stage(spark, docs, SF), "t")
        before = {r.doc_id: r for r in docs.collect()}
        after = {r.doc_id: r for r in out.collect()} if name != "packing" else None
        if name != "packing":
            assert out.columns == columns and out.count() == len(after)
        if name == "toxicity":
            scores = toxicity.op5(docs, table(spark, SF, "labels")).collect()
            assert set(after) == {r.doc_id for r in scores if r.predicted == 0}
        elif name == "line_dedup":
            want = {r.doc_id: r.text for r in line_dedup.op1(docs).collect()}
            assert {d: r.text for d, r in after.items()} == want
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "simhash_near_dedup":
            groups = simhash.op9(docs).collect()
            assert set(after) == {r.component_id for r in groups}
        elif name == "decontamination":
            found = decontam.op4(docs, table(spark, SF, "benchmark")).collect()
            assert set(after) == {r.doc_id for r in found if not r.contaminated}
        else:
            tok = Tokenizer.from_file(packing.tokenizer_file())
            pieces = sorted(out.collect(), key=lambda r: (r.doc_id, r.start))
            for doc_id, r in before.items():
                own = b"".join(p.ids for p in pieces if p.doc_id == doc_id)
                want = [*tok.encode(r.text, add_special_tokens=False).ids, 1]
                assert np.frombuffer(own, "<u4").tolist() == want
        if name in ("toxicity", "simhash_near_dedup", "decontamination"):
            assert all(after[d] == before[d] for d in after)  # clean documents stay as they are
        docs = out


def test_run(spark):
    out = P.run(spark, SF)
    assert out.columns == [x.split()[0] for x in packing.PIECE_SCHEMA.split(", ")]
    assert out.count() > 0


@pytest.mark.parametrize("which", ["edge_docs", "no_docs"])
def test_edges(spark, request, which):
    from pyspark.sql import functions as F

    docs = request.getfixturevalue(which).withColumn("n_chars", F.length("text").cast("long"))
    for _, stage in P.STAGES:
        docs = staged(stage(spark, docs, SF), "t")
    assert (docs.count() > 0) == (which == "edge_docs")
