import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strandweave.llm import common


def shuffle_files(spark):
    return set(Path(spark.conf.get("spark.local.dir")).rglob("shuffle_*"))


@pytest.mark.parametrize("step", [common.cut, common.stored])
def test_finished_steps_leave_no_shuffle_files(spark, step):
    had = shuffle_files(spark)
    before = spark.conf.get(common.CLEANUP, None)
    found = step(spark.range(20_000).select((F.col("id") % 7_000).alias("k")).groupBy("k").count())
    for _ in range(50):  # they go in the background
        if not shuffle_files(spark) - had:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - had
    assert found.count() == found.count() == 7_000 and found.agg(F.sum("count")).first()[0] == 20_000
    assert spark.conf.get(common.CLEANUP, None) == before
