"""Every registered query against its SQL counterpart over whole tables."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from cornerstore.oracles import ORACLES
from cornerstore.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, tables, name):
    result = entry.queries()[name](spark, FOLDER)
    assert differences(result, tables, entry.oracle_sql()[name]) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 6


@pytest.mark.parametrize("missing", ["xxhash", "public_tokenizers", "corpus_pipeline", "cornerstore.llm"])
def test_entry_without_optional_modules(missing):
    """The core queries are there whatever the training-data operators lack."""
    code = (
        f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; "
        "from cornerstore.queries import QUERIES; assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql())"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(entry.__file__).parent)
