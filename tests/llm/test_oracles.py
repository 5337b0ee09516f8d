"""Registered queries with SQL, on the smallest given tables."""
import pytest

import __spark_entry__ as E
from reelhouse.llm import registry
from tests.conftest import SF001
from tests.llm.helpers import same


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, name):
    tables = {t: spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark")}
    assert same(E.queries()[name](spark, SF001), registry.ORACLE[name], **tables)


def test_registered_names():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
