import pytest

from strandweave.llm.catalogue import ORACLES, QUERIES
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(k for k, v in ORACLES.items() if v))
def test_against_oracle(spark, name):
    compare(spark, SF, QUERIES[name], ORACLES[name])


def test_every_operator_has_a_query():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES if k.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
