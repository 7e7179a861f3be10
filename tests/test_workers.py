"""Python workers can import the package even when the driver process only
has it on its own sys.path (the situation of a harness that imports
__spark_entry__ from the repository folder)."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false") \\
    .config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
from trackstream.plans import compose as P
from trackstream.operators import forest
v = P.valid_features(spark, "/root/testdata/sf0.001")
m = forest.fit_isolation_forest(v, n_trees=5)
print("SCORED", forest.score_frame(v, m).count())
from trackstream.operators import windows
from trackstream.streaming.stateful import ROCKSDB_PROVIDER, stream_trends
spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
v.write.parquet("valid")
src = spark.readStream.schema(v.schema).parquet("valid").withWatermark("event_time", "1 minute")
(stream_trends(windows.window_stats(src, duration="1 hour")).writeStream.format("parquet")
 .option("path", "trends").option("checkpointLocation", "ckpt").trigger(availableNow=True)
 .start().awaitTermination())
print("TRENDS", spark.read.parquet("trends").count())
"""


def test_udfs_run_without_package_on_worker_path():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    cwd = tempfile.mkdtemp(prefix="ts-workers-")
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "SCORED" in out.stdout, out.stderr[-3000:]
    assert "TRENDS" in out.stdout, out.stderr[-3000:]


def test_streaming_cli_end_to_end(spark, scratch):
    """The command-line job lands all four tables from landed message files."""
    from trackstream.plans import compose as P
    from trackstream.sources import messages as M
    M.messages_from_flights(P.flights(spark, "/root/testdata/sf0.001")) \
        .coalesce(1).write.parquet(scratch + "/landing/p0")
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = subprocess.run(
        [sys.executable, "-m", "trackstream.streaming.cli", "--source", "files",
         "--path", scratch + "/landing/*", "--output", scratch + "/out",
         "--checkpoint", scratch + "/ckpt", "--window", "1 day", "--trigger", "availableNow"],
        cwd=scratch, env=env, capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-3000:]
    counts = {t: spark.read.parquet(f"{scratch}/out/{t}").count()
              for t in ("processed", "invalid", "dead_letters", "windows")}
    assert all(n > 0 for n in counts.values()), counts
