import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from enrolmart.session import build_session, clear_scratch

    # Tests run without a cluster-provided checkpoint folder: a private one per run.
    spark = build_session(
        "local[4]",
        app="enrolmart-tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="enrolmart-test-ckpt-"),
        },
    )
    yield spark
    clear_scratch(spark)
    spark.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="enrolmart-test-")
