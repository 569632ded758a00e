"""Counters of a stream in a log, over a restart."""

import json

from pyspark.sql import functions as F

from palisade.operators import metrics


def test_rows_a_batch_and_rule_over_a_restart(spark, tmp_path):
    log = f"file://{tmp_path}/log"
    listener = metrics.MetricsLog(log)
    spark.streams.addListener(listener)
    (tmp_path / "in").mkdir()

    def run(name, values):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps({"v": v}) for v in values))
        stream = metrics.observed_stream(spark.readStream.schema("v int").json(str(tmp_path / "in")), "rules", even=F.col("v") % 2 == 0, large=F.col("v") > 5)
        q = stream.writeStream.queryName("counted").format("noop").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
        assert metrics.wait_for_log(spark, log, "counted", q.lastProgress.batchId)

    def rows():
        return {(r.batch, r.counter): r.n for r in metrics.read_log(spark, log).where("step = 'rules' and n > 0").collect()}

    try:
        run("a.json", [1, 2, 4, None])
        assert rows() == {(0, "n_rows"): 4, (0, "even"): 2}
        run("b.json", [6, 7])
        want = {(0, "n_rows"): 4, (0, "even"): 2, (1, "n_rows"): 2, (1, "even"): 1, (1, "large"): 2}
        assert rows() == want
        assert metrics.compact_log(spark, log) == 2 and rows() == want and metrics.compact_log(spark, log) == 0
        run("c.json", [8])
        assert rows() == want | {(2, "n_rows"): 1, (2, "even"): 1, (2, "large"): 1}
    finally:
        spark.streams.removeListener(listener)
    assert metrics.read_log(spark, f"file://{tmp_path}/none").count() == 0
