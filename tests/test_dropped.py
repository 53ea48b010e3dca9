"""Counts of what falls behind the watermark."""

from instants import at

from gaugeworks.schemas import ROLLING, STREAM_EVENT, conform
from gaugeworks.sources import changes, lake
from gaugeworks.streaming import jobs


def test_dropped_windows_are_counted(spark, readings, folder):
    topic, checkpoint, table, lost = (folder(n) for n in ("topic", "checkpoint", "table", "lost"))

    def put(*rows):
        conform(readings(list(rows)), STREAM_EVENT).coalesce(1).write.mode("append").parquet(topic)
        events = jobs.event_time(lake.folder_stream(spark, topic, STREAM_EVENT))
        query = jobs.start(jobs.rolling_windows(events), checkpoint, changes.append_each(table), "update", state_partitions=2)
        query.awaitTermination()
        assert query.exception() is None
        for _ in range(2):  # noting a batch again counts once
            jobs.note_dropped(spark, query, lost, "rolling")
        return jobs.dropped(query)

    assert jobs.dropped_counts(spark, lost).count() == 0
    assert put(("a", at(0), 1.0, 1), ("a", at(60), 2.0, 1)) == []
    # The watermark stands at minute 55. Two events of one window group are one row of each of five windows.
    late = put(("a", at(0), 5.0, 1), ("a", at(1), 5.0, 1), ("b", at(0), 5.0, 1), ("a", at(57), 3.0, 1))
    assert [rows for _, _, rows in late] == [10]
    # Of an event at minute 52 the windows that end at 54 are over, those that end at 56 and later are not.
    assert [rows for _, _, rows in put(("c", at(52), 4.0, 1))] == [1]
    noted = jobs.dropped_counts(spark, lost).collect()
    assert sorted(r["rows"] for r in noted) == [1, 10] and {r["query"] for r in noted} == {"rolling"}
    kept = changes.newest(spark, table, ROLLING, ["city_id", "window_end_time"])
    by_city = {r.city_id: r["count"] for r in kept.groupBy("city_id").count().collect()}
    assert by_city == {"a": 5 + 5 + 2, "c": 4}  # minute 57 adds the ends 58 and 60
