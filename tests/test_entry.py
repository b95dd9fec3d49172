import pytest
from conftest import SMALL

import __spark_entry__ as entry
import check


@pytest.fixture(scope="module")
def con():
    return check.duck(SMALL)


#: The library's own queries; those of a subpackage are tested beside it.
OWN = [name for name in entry.queries() if name not in entry._MORE]


def test_every_query_has_its_sql():
    assert set(OWN) == set(entry.oracle_sql()) - set(entry._MORE)


def test_entry(spark):
    got = entry.entry(spark)
    assert len(got.columns) == 36 and got.limit(1).count() == 1


@pytest.mark.parametrize("name", [n for n in OWN if n != "output_schemas"])
def test_query_equals_sql(spark, con, name):
    assert check.compare(spark, con, SMALL, name) == ""
