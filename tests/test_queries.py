"""Every registered query of the library against its SQL on the same tables."""

import pytest
from compare import same

from wherry.plans import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    found = QUERIES[name](spark, sf_dir).toPandas()
    assert name in ORACLES, "every query of the library has SQL"
    same(found, duck.execute(ORACLES[name]).fetchdf())


def test_entry(spark):
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
