"""Every registered query against its SQL oracle (DuckDB) at sf0.001."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF
from tools.oracle_check import duck, rows_of

from cinerank.plans.oracle import ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    df = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    d_cols, d_rows = duck(SF, ORACLE[name])
    assert sorted(df.columns) == sorted(d_cols)
    assert rows_of(df.columns, s_rows) == rows_of(d_cols, d_rows)


def test_every_query_has_oracle_or_is_rows_only():
    from cinerank.plans.queries import REGISTRY

    rows_only = set(REGISTRY) - set(ORACLE)
    assert rows_only <= {"svd_vectors", "als_factors", "als_recall", "train_ranker", "score_ranker", "recommend_topk"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 1
