"""Every change-log query against its SQL."""

import compare
import pytest

from walloom import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    got = compare.actual(queries.QUERIES[name](spark, sf_dir))
    assert got == compare.expected(queries.ORACLES[name], sf_dir)


def test_stream_equals_batch(spark, sf_dir):
    stream, batch = queries.QUERIES["stream_replica"](spark, sf_dir), queries.QUERIES["latest_state"](spark, sf_dir)
    assert compare.actual(stream) == compare.actual(batch)


def test_order_is_read_from_one_dealing(spark, sf_dir):
    """Planned twice, the order is dealt to other partitions each time, as large as the columns that are read: then places of one run stand against ends of another."""
    plan = queries.QUERIES["commit_order"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "partition_id" not in plan and "monotonically" not in plan
