import oracle
import pytest

from rosterlens.plans import domain, exemplars

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = {**domain.QUERIES, **exemplars.QUERIES}, {**domain.ORACLES, **exemplars.ORACLES}


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_oracle(spark, name):
    assert oracle.spark_rows(QUERIES[name](spark, SF_DIR)) == oracle.duck(SF_DIR, ORACLES[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
