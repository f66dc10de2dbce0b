import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def frame(spark):
    """Rows to a documents frame; each row is (doc_id, text) or (doc_id, text, source)."""
    def make(rows, schema="doc_id bigint, text string, lang string, source string, n_chars bigint"):
        if "lang" in schema:
            rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(rows, schema)
    return make
