"""Run the A/A and bootstrap pipelines with one input task failing on its
first attempt (Spark retries it), and print whether the rows equal an
undisturbed run. Executed in its own process by test_task_retry.py, because
task retries need a ``local[N,F]`` master."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from feedlens.operators import experiments as ex  # noqa: E402
from feedlens.plans import params as P  # noqa: E402
from feedlens.sources.actions import load_fixture  # noqa: E402


MARKERS = os.environ.get("RETRY_MARKERS", "/tmp")


def flaky(batches):
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        with open(os.path.join(MARKERS, f"failed-{ctx.stageId()}-{ctx.taskAttemptId()}"), "w"):
            pass
        raise RuntimeError("injected task failure")
    yield from batches


def main(ckpt: str) -> None:
    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", ckpt).getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    a = load_fixture(spark, "/root/testdata/sf0.01")
    users = ex.user_ctr(a.feed, P.EXP_START, P.EXP_END, P.ALL_GROUPS).repartition(4)
    disturbed = users.mapInPandas(flaky, users.schema)

    def runs(u):
        aa = ex.aa_stats(ex.aa_samples(u, P.AA_GROUPS, 500, 20), P.AA_GROUPS)
        boot = ex.poisson_bootstrap(u, P.AB_GROUPS, 200)
        return [sorted(map(tuple, df.collect())) for df in (aa, boot)]

    same = runs(users) == runs(disturbed)
    failures = len([f for f in os.listdir(MARKERS) if f.startswith("failed-")])
    print(json.dumps({"same": same, "failures": failures}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
