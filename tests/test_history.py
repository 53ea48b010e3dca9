"""Taking upserts back."""

import pytest

from gaugeworks.sources import history, sinks

COLUMNS = "k INT, day DATE, v STRING"


@pytest.fixture
def table(spark, folder):
    path = folder("kept")

    def rows(*given):
        return spark.createDataFrame([(k, d, v) for k, d, v in given], "k INT, d STRING, v STRING").selectExpr(
            "k", "CAST(d AS DATE) AS day", "v"
        )

    def content():
        return sorted((r.k, str(r.day), r.v) for r in spark.read.schema(rows().schema).parquet(path).collect())

    def put(*given):
        return history.upsert_kept(rows(*given), path, ["k", "day"], "day")

    sinks.upsert(rows((1, "2024-01-01", "a"), (2, "2024-01-01", "b"), (3, "2024-01-02", "c")), path, ["k", "day"], "day")
    return path, rows, content, put


def test_restore_takes_back_a_version_and_all_after(spark, table):
    path, rows, content, put = table
    states = [content()]
    assert history.versions(spark, path) == []
    for n, given in enumerate([[(1, "2024-01-01", "A")], [(9, "2024-01-03", "new"), (3, "2024-01-02", "C")], [(9, "2024-01-03", "N"), (2, "2024-01-01", "B")]]):
        assert put(*given) == n
        states.append(content())
    assert history.versions(spark, path) == [0, 1, 2] and states[3] != states[2] != states[1] != states[0]
    assert history.restore(spark, path, rows().schema, "day", 2) == 2
    assert content() == states[2] and history.versions(spark, path) == [0, 1]
    history.restore(spark, path, rows().schema, "day", 0)
    assert content() == states[0] and history.versions(spark, path) == []
    with pytest.raises(ValueError):
        history.restore(spark, path, rows().schema, "day", 0)
    assert put((1, "2024-01-01", "A")) == 0 and content() == states[1]


def test_only_touched_partitions_are_kept(spark, table):
    path, rows, content, put = table
    put((1, "2024-01-01", "A"), (7, "2024-01-09", "x"))
    kept = spark.read.schema(rows().schema).parquet(f"{path}/_history/version=0/data")
    assert sorted((r.k, str(r.day), r.v) for r in kept.collect()) == [(1, "2024-01-01", "a"), (2, "2024-01-01", "b")]
    assert {(r.value, r.existed) for r in history.changed(spark, path).collect()} == {("2024-01-01", True), ("2024-01-09", False)}
    put((1, "2024-01-01", "AA"))
    history.forget(spark, path, 1)
    assert history.versions(spark, path) == [1]


def test_cut_off_work(spark, table, monkeypatch):
    path, rows, content, put = table
    before = content()
    with monkeypatch.context() as m:  # the driver goes after the copies and before the table changes
        m.setattr(history, "upsert", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            put((1, "2024-01-01", "A"), (8, "2024-01-08", "n"))
    assert content() == before and history.versions(spark, path) == [0]
    history.restore(spark, path, rows().schema, "day", 0)
    assert content() == before
    put((1, "2024-01-01", "A"), (8, "2024-01-08", "n"))
    with monkeypatch.context() as m:  # and in a restore, before the copies are in place
        m.setattr(history, "finish_pending", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            history.restore(spark, path, rows().schema, "day", 0)
    history.restore(spark, path, rows().schema, "day", 0)
    assert content() == before


def test_null_and_empty(spark, table):
    path, rows, content, put = table
    before = content()
    assert put() == 0 and content() == before
    put((5, None, "nowhere"))
    assert (5, "None", "nowhere") in content()
    history.restore(spark, path, rows().schema, "day", 0)
    assert content() == before
