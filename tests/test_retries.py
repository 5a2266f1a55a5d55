"""Tasks that fail once and run again leave the right rows and the right counts."""

import json
import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import json, sys
from pyspark import TaskContext
from pyspark.sql import functions as F
from strata.session import build_session
from strata.sinks import write_layer

conf = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "3"}
spark = build_session("retries", conf, "local[2,3]")
spark.sparkContext.setLogLevel("OFF")

def fail_once(batches):
    first = TaskContext.get().attemptNumber() == 0
    for batch in batches:
        yield batch
    if first:
        raise RuntimeError("lost after all rows were handed over")

rows = spark.range(0, 1000, 1, 4).withColumn("k", F.col("id") % 5)
flaky = rows.mapInPandas(fail_once, "id long, k long")
out = sys.argv[1]
results = {
    # Fails in the task that writes.
    "plain": write_layer(flaky, out + "/plain", metrics={"ids": F.sum("id")}),
    # Fails before the shuffle of the write.
    "parted": write_layer(flaky, out + "/parted", partition_by=["k"], metrics={"ids": F.sum("id")}),
}
print(json.dumps({
    name: [r.rows, r.metrics["ids"], spark.read.parquet(r.path).count(),
           spark.read.parquet(r.path).select("id").distinct().count()]
    for name, r in results.items()
}))
"""


def test_failed_tasks_are_counted_once(tmp_path):
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path)],
        env={**os.environ, "PYTHONPATH": str(Path(__file__).resolve().parents[1])},
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert run.returncode == 0, run.stderr[-2000:]
    wanted = [1000, 499500, 1000, 1000]
    assert json.loads(run.stdout.strip().splitlines()[-1]) == {"plain": wanted, "parted": wanted}
