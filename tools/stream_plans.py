"""Append the physical plans of the streaming jobs (last micro-batch) to
PLANS.md: classification fan-out (watermark dedup state) and the streaming
device state (update-mode aggregation).

usage: python tools/stream_plans.py [sf_dir] >> PLANS.md
"""
import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewatch import fixtures as X  # noqa: E402
from tidewatch.plans import classify as C  # noqa: E402
from tidewatch.session import build_session, scratch_path  # noqa: E402
from tidewatch.sources.messages import read_message_files, write_replay_files  # noqa: E402
from tidewatch.streaming import jobs as J  # noqa: E402


def explain(q) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        q.explain()
    return buf.getvalue().strip()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    base = scratch_path(spark, "stream-plans")
    write_replay_files(X.messages(spark, sf), f"{base}/in", 5000)
    paths = {k: f"{base}/{k}" for k in ("archive", "keyed", "index", "alerts")}
    q1 = J.run(J.classification_stream(read_message_files(spark, f"{base}/in"), X.FIXTURE_LAYOUT,
                                       C.fixture_stats(spark, sf), C.fixture_scorer, X.FIXTURE_CLASS_MAP,
                                       X.FIXTURE_FEATURES, paths, f"{base}/ck1", X.device_registry(spark, sf)))
    X.containment_commands(spark, sf).write.parquet(f"{base}/commands")
    alerts = spark.readStream.schema(spark.read.parquet(paths["alerts"]).schema).parquet(paths["alerts"])
    cmds = spark.readStream.schema(spark.read.parquet(f"{base}/commands").schema).parquet(f"{base}/commands")
    q2 = J.run(J.device_state_stream(alerts, cmds, f"{base}/state", f"{base}/ck2"))
    print("\n# Streaming plans (last micro-batch)\n")
    print("## classification_stream (parse -> watermark dedup -> prepare -> score -> foreachBatch fan-out)\n")
    print("```\n" + explain(q1) + "\n```\n")
    print("## device_state_stream (update-mode aggregation of last values by device)\n")
    print("```\n" + explain(q2) + "\n```\n")


if __name__ == "__main__":
    main()
