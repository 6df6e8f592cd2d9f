"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import digest

from .conftest import SMALL

ORACLE = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SMALL)
    s_cols, s_rows = sdf.columns, [tuple(r) for r in sdf.collect()]
    cur = duck.execute(ORACLE[name])
    d_cols, d_rows = [d[0] for d in cur.description], cur.fetchall()
    sc, sl, sh = digest(s_cols, s_rows)
    dc, dl, dh = digest(d_cols, d_rows)
    assert sc == dc
    assert len(sl) == len(dl)
    assert sh == dh, (sorted(set(sl) - set(dl))[:3], sorted(set(dl) - set(sl))[:3])


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(ORACLE) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["host", "n_pages", "n_sentences", "n_tokens", "vocab_size"]
