"""Every query with SQL gives what the SQL gives; the others run."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from oracle import connect, same  # noqa: E402

from quarry.plans import registry  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    df = registry.queries()[name](spark, SF)
    if name in registry.oracle_sql():
        assert same(df, registry.oracle_sql()[name], connect(SF))
    else:
        assert df.count() > 0


def test_every_document_is_classified(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert registry.queries()["lm_classify_all"](spark, SF).select("key").distinct().count() == docs.count()


@pytest.mark.parametrize("name", ["balanced_chunks", "section_setdiff"])
def test_no_group_is_numbered_in_one_task(spark, name):
    assert "Window" not in registry.queries()[name](spark, SF)._jdf.queryExecution().toString()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
