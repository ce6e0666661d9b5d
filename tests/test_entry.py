"""Driver contract smoke and a few oracle comparisons at sf0.001."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", ["observed_demand", "model_matrix", "leaderboard_sorted", "seasonal_naive_forecast",
                                 "ks_two_sample", "batch_score", "walk_forward_cv"])
def test_oracle_match(spark, key):
    import __spark_entry__ as E
    from tests.oracle_check import compare, duck

    problems, n, _, _ = compare(spark, key, SF, E.queries()[key], E.oracle_sql()[key], duck(SF))
    assert not problems, problems
