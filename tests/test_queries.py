import pytest

import __spark_entry__ as entry
from check_oracles import connect, difference, same_type
from textmill.plans.oracles import ORACLES
from textmill.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
#: Charts over learned scores that SQL does not express; test_cky and test_eisner hold them against all trees.
WITHOUT_SQL = {"constituency_cky", "dependency_mst"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(REGISTRY) - WITHOUT_SQL == set(ORACLES)
    assert set(REGISTRY) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_without_sql_has_a_row_for_every_sentence(spark, name):
    sentences = REGISTRY["sentences"](spark, SF).select("doc_id", "sent_idx")
    got = REGISTRY[name](spark, SF).select("doc_id", "sent_idx")
    assert got.exceptAll(sentences).count() == 0 and got.count() == sentences.count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    result = entry.queries()[name](spark, SF)
    cursor = duck.execute(entry.oracle_sql()[name])
    want = cursor.df()
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    assert difference(result.toPandas(), want) is None
    assert [c for c, t in result.dtypes if not same_type(t, kinds.get(c))] == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
