import inspect

import pytest

import __spark_entry__ as entry
import catalog
import check
from tests.conftest import SMALL, plan_of


@pytest.fixture(scope="module")
def db():
    return check.connect(SMALL)


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES) <= set(entry.queries())


def sound_plan(frame):
    plan = plan_of(frame)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time UDF


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, db, name):
    line = check.compare(spark, db, SMALL, name, sound_plan)
    assert ": same" in line, line


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["source", "kind", "n_hits"] and frame.count() > 0


def test_nothing_is_cut_short():
    for module in (catalog.enrichment, catalog.extraction, catalog.identity, catalog.pii, catalog.rules, catalog.sites, catalog.streams):
        assert ".sample(" not in inspect.getsource(module)
