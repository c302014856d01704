"""Run by test_recovery.py in its own process (master local[4,4]: failed tasks
are retried). A step fails on its first attempt in one partition; the
retried results must equal an undisturbed run."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from trafficlens.functions.expressions import ntz_micros  # noqa: E402
from trafficlens.operators import ordered as O  # noqa: E402
from trafficlens.session import ensure_checkpoint_dir  # noqa: E402


def flaky(rows):
    """``rows`` through a step that fails on its first attempt in one partition."""
    schema = rows.schema

    def fn(batches):
        from pyspark import TaskContext

        tc = TaskContext.get()
        if tc.partitionId() == 1 and tc.attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        yield from batches

    return rows.repartition(4, "user_id").mapInArrow(fn, schema)


def run(spark, through=lambda df: df):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    df = through(ev.select((F.col("user_id") % 3).alias("user_id"), ntz_micros("ts").alias("us"), "event_id"))
    a = sorted(O.gap_sessions(df, ["user_id"], "us", 1_800_000_000, tie="event_id").collect())
    b = sorted(O.gap_stats(df, ["user_id"], "us", tie="event_id").collect())
    return a, b


if __name__ == "__main__":
    spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "6").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    ensure_checkpoint_dir(spark)
    clean = run(spark)
    st = spark.sparkContext.statusTracker()
    before = set(st.getJobIdsForGroup(None))
    retried = run(spark, flaky)
    stages = [s for j in st.getJobIdsForGroup(None) if j not in before and st.getJobInfo(j)
              for s in st.getJobInfo(j).stageIds]
    failed = sum(st.getStageInfo(s).numFailedTasks for s in stages if st.getStageInfo(s))
    print("FAILED_TASKS", failed)
    print("EQUAL" if clean == retried and len(clean[0]) > 0 else "DIFFERENT")
