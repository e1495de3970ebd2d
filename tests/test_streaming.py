import shutil
import time
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from lectern.streaming.conversations import alert_once, empty_message_counts, read_alerts, stream_session
from lectern.session import path_exists
from standins.views import view


def run(spark, source, schema, work, limit=1):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session = stream_session(spark, 2)
    arriving = session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = alert_once(arriving, f"{work}/alerts", f"{work}/state", limit, available_now=True)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    query.awaitTermination()
    return read_alerts(spark, f"{work}/alerts")


@pytest.mark.parametrize("files,limit", [(1, 1), (4, 0)])
def test_same_conversations_as_the_batch_form(spark, small, folder, files, limit):
    from lectern.operators.conversations import stuck_conversations

    events = view(spark, small, "conversation_events")
    events.repartition(files).write.parquet(f"{folder}/in")
    got = run(spark, f"{folder}/in", events.schema, folder, limit)
    wanted = stuck_conversations(events, limit)
    assert sorted(r.conv_id for r in got.collect()) == sorted(r.conv_id for r in wanted.collect())
    assert wanted.count() > 0


def test_alert_comes_once_across_restarts(spark, folder):
    schema = "conv_id long, turn long, role string, text string"
    mark = "[no text content]"

    def arrive(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in/{name}")

    arrive("one", [(1, 0, "user", mark), (2, 0, "user", mark), (2, 1, "user", mark)])
    first = run(spark, f"{folder}/in/*", schema, folder)
    assert [(r.conv_id, r.empty_messages) for r in first.collect()] == [(2, 2)]
    arrive("two", [(1, 1, "user", mark), (2, 2, "user", mark), (3, 0, "user", "fine")])
    again = run(spark, f"{folder}/in/*", schema, folder)
    assert sorted(r.conv_id for r in again.collect()) == [1, 2]
    # A conversation told of stays so although nothing reads the earlier alerts.
    shutil.rmtree(urlparse(f"{folder}/alerts").path)
    arrive("three", [(2, 3, "user", mark), (None, 0, "user", mark), (None, 1, "user", mark), (4, 0, "user", mark), (4, 1, "user", mark)])
    assert [r.conv_id for r in run(spark, f"{folder}/in/*", schema, folder).collect()] == [4]


def test_state_is_forgotten_after_a_while(spark, folder):
    schema, mark = "conv_id long, turn long, role string, text string", "[no text content]"

    def arrive(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in/{name}")

    def wait_for(wanted):
        deadline, found = time.time() + 40, None
        while found != wanted and time.time() < deadline:
            time.sleep(1)
            if path_exists(spark, f"{folder}/alerts"):
                found = sorted((r.conv_id, r.empty_messages) for r in read_alerts(spark, f"{folder}/alerts").collect())
        assert found == wanted

    arrive("one", [(1, 0, "user", mark), (2, 0, "user", mark), (2, 1, "user", mark)])
    arriving = stream_session(spark, 1).readStream.schema(schema).parquet(f"{folder}/in/*")
    with pytest.raises(ValueError, match="does not end"):
        alert_once(arriving, f"{folder}/alerts", f"{folder}/state", available_now=True, forget_after_ms=1)
    query = alert_once(arriving, f"{folder}/alerts", f"{folder}/state", 1, forget_after_ms=1500)
    try:
        wait_for([(2, 2)])
        time.sleep(6)
        arrive("two", [(1, 1, "user", mark), (2, 2, "user", mark), (2, 3, "user", mark)])
        wait_for([(2, 2), (2, 2)])
    finally:
        query.stop()


def test_counts_only_hold_conversations_with_empty_messages(spark):
    events = spark.createDataFrame([(1, "x"), (2, None)], "conv_id long, text string")
    assert empty_message_counts(events, 0).count() == 0
    every = empty_message_counts(events, 0, F.col("text").isNull())
    assert [r.conv_id for r in every.collect()] == [2]
