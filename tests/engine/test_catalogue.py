import pytest

from strandweave.plans.catalogue import ORACLES, QUERIES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_oracle(spark, name):
    compare(spark, SF, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_whole_intervals_take_every_row(spark):
    """Each start of lineitem lies in a merged interval, and intervals are neither one a supplier nor one a row."""
    con = connect(SF)
    merged = QUERIES["merge_intervals_whole"](spark, SF).toPandas()  # noqa: F841
    day = "date_diff('day', DATE '1970-01-01', l_shipdate::DATE)"
    rows, suppliers = con.execute("SELECT count(*), count(DISTINCT l_suppkey) FROM lineitem").fetchone()
    held = con.execute(f"""SELECT count(*) FROM lineitem l JOIN merged m ON m.l_suppkey = l.l_suppkey AND {day} >= m.start AND {day} < m."end" """).fetchone()[0]
    assert held == rows and 10 * suppliers < len(merged) < 0.7 * rows
    assert rows / 10 < QUERIES["mask_anti_join_whole"](spark, SF).count() < 0.9 * rows


def test_bootstrap_draws_the_operators_thousand_replicates(spark, monkeypatch):
    monkeypatch.setattr("strandweave.operators.attribution.intervals", lambda fitted: fitted)
    drawn = {r.replicate for r in QUERIES["bootstrap_attribution"](spark, SF).select("replicate").distinct().collect()}
    assert drawn == set(range(1001))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 96
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
