"""Driver contract: entry() at sf0.001, every SQL-checked query equal to its oracle at sf0.001."""

import sys

from conftest import ROOT, SF001

sys.path.insert(0, ROOT + "/tests")


def test_entry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["term", "score", "total_comments", "positive_comments"]
    assert len(rows) > 0


def test_sql_queries_match_oracle_sf0001(spark, monkeypatch):
    import __spark_entry__ as E
    from brandpulse.plans import extra_queries
    from oracle_compare import compare

    # The fitted models are checked by what SQL can state of them; few iterations do for that.
    monkeypatch.setitem(extra_queries.FIT, "iterations", 10)
    monkeypatch.setitem(extra_queries.FIT, "vector_size", 16)

    names = list(E.oracle_sql())
    res = compare(spark, SF001, names, verbose=False)
    bad = {k: v for k, v in res.items() if not v["ok"]}
    assert not bad, bad
