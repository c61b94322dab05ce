"""The streaming band report equals the batch report on the same rows."""

import os
import uuid


from tests.conftest import SF_SMALL
from valuator.operators import evaluate as ev
from valuator.plans.q_evaluate import scored_long
from valuator.session import ensure_checkpoint_dir
from valuator.streaming.scoring import band_report_stream, finish_report


def test_stream_report_matches_batch(spark):
    base = os.path.join(ensure_checkpoint_dir(spark), f"stream-{uuid.uuid4().hex[:8]}")
    long = scored_long(spark, SF_SMALL).select("model", "listing_id", "price", "prediction")
    long.repartition(4).write.parquet(f"{base}/in")
    q = (band_report_stream(spark, f"{base}/in").writeStream.outputMode("complete").format("memory")
         .queryName("band_stream").option("checkpointLocation", f"{base}/ckpt").start())
    q.processAllAvailable()
    q.stop()
    got = {(r["model"], r["band"]): (r["count"], round(r["rmse"], 4))
           for r in finish_report(spark.table("band_stream")).collect()}
    want = {(r["model"], r["band"]): (r["count"], round(r["rmse"], 4))
            for r in ev.band_report(scored_long(spark, SF_SMALL)).collect()}
    assert got == want
