"""Work tables: where they go and when they are dropped."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from keptvisit.operators import ranks
from keptvisit.queries import load
from keptvisit.session import together, use_checkpoints, work_tables, write_out


def folders(spark):
    use_checkpoints(spark)
    local = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return set(os.listdir(local))


def test_a_job_leaves_no_work_table(spark):
    before = folders(spark)
    with work_tables(spark) as folder:
        rows = spark.range(100).withColumn("p", F.rand(1))
        assert ranks.with_percent_rank(rows, [], "p", "rank").count() == 100
        assert os.listdir(folder.removeprefix("file:"))
    assert folders(spark) == before


def test_registered_queries_leave_none_inside_a_job(spark):
    before = folders(spark)
    with work_tables(spark):
        for name in ("batch_size_switch", "weekly_live_cycle"):
            assert load().runners()[name](spark, SMALL).count() > 0
    assert folders(spark) == before


def test_a_failed_job_keeps_its_tables(spark):
    with pytest.raises(ValueError), work_tables(spark) as folder:
        write_out(spark.range(3), "kept")
        raise ValueError("stopped")
    assert len(os.listdir(folder.removeprefix("file:"))) == 1
    # The next table is outside the failed job's folder.
    assert folder.rsplit("/", 1)[1] not in write_out(spark.range(3), "next").inputFiles()[0]


def test_calls_run_together_in_the_folder_of_their_job(spark):
    before, meet = folders(spark), threading.Barrier(3, timeout=60)

    def job(k):
        # Passes only if all three run at the same time.
        meet.wait()
        return k, write_out(spark.range(k), "rows").count()

    with work_tables(spark) as folder:
        assert together(spark, [lambda k=k: job(k) for k in (3, 1, 2)]) == [(3, 3), (1, 1), (2, 2)]
        assert len(os.listdir(folder.removeprefix("file:"))) == 3
    assert folders(spark) == before and together(spark, []) == []
    with pytest.raises(ZeroDivisionError):
        together(spark, [lambda: 1, lambda: 1 / 0])
