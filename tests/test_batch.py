"""Flattening, the gate, the daily run, sinks, serving and monitoring on small frames."""

import datetime as dt
import json
from inspect import signature

import pytest
from instants import at
from pyspark.sql import functions as F

from gaugeworks import schemas
from gaugeworks.functions.times import resolve_run_date, trailing_start
from gaugeworks.operators import alerts, daily, drift, flatten, gate, keep, monitor, responses, serving
from gaugeworks.plans import daily_run
from gaugeworks.sources import lake, sinks

DAY = dt.date(2024, 3, 1)

# Every field that an event is made from has a value of its own, so that a mix-up shows.
MAIN = {k: 1.5 + n for n, k in enumerate(("temp", "feels_like", "temp_min", "temp_max"))} | {"pressure": 987, "humidity": 41}
WEATHER = {
    "coord": {"lat": -3.125, "lon": 11.75},
    "weather": [{"main": "Fog", "description": "thin fog over the bay"}],
    "main": MAIN,
    "visibility": 640,
    "wind": {"speed": 9.25, "deg": 77},
    "clouds": {"all": 63},
    "dt": 1709294400,
}
GASES = {k: 100.25 + n for n, k in enumerate(("co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3"))}
AIR = {"list": [{"main": {"aqi": 3.0}, "components": GASES}]}


def without(payload, key):
    return {k: v for k, v in payload.items() if k != key}


@pytest.fixture
def flat(spark):
    def run(**payloads):
        rows = [
            (name, at(0), w if isinstance(w, str) else json.dumps(w), a if isinstance(a, str) else json.dumps(a))
            for name, (w, a) in payloads.items()
        ]
        pairs = spark.createDataFrame(
            rows, "city_id STRING, poll_timestamp TIMESTAMP, weather STRING, air_pollution STRING"
        )
        cities = spark.createDataFrame([(n, n.title(), 1.5, 2.5) for n in payloads], schemas.CITY)
        pairs = flatten.with_city(pairs, cities)
        return {r.city_id: r for r in flatten.flatten(pairs).collect()}, flatten.malformed(pairs).collect()

    return run


def test_flatten_fills_every_column(flat):
    events, bad = flat(full=(WEATHER, AIR))
    e = events["full"].asDict()
    assert bad == []
    raw = e.pop("raw_payload_json")
    assert json.loads(raw) == {"weather": WEATHER, "air_pollution": AIR}
    assert raw == json.dumps({"weather": WEATHER, "air_pollution": AIR}, separators=(",", ":"))
    sky, wind = WEATHER["weather"][0], WEATHER["wind"]
    assert e == MAIN | GASES | WEATHER["coord"] | {
        "city_id": "full",
        "poll_timestamp": e["poll_timestamp"],
        "source": "azure-function-timer",
        "schema_version": "1.0",
        "ingestion_date": DAY,
        "dt": WEATHER["dt"],
        "visibility": WEATHER["visibility"],
        "wind_speed": wind["speed"],
        "wind_deg": wind["deg"],
        "clouds_all": WEATHER["clouds"]["all"],
        "weather_main": sky["main"],
        "weather_description": sky["description"],
        "aqi": 3,
    }


def test_compact_leaves_strings_alone(spark):
    text = '{ "a b" : "x  \\\" y" ,\n\t"n" : [ 4.0 , 1e3 ] }'
    row = spark.createDataFrame([(text,)], "t STRING").select(flatten.compact("t").alias("c")).first()
    assert row.c == '{"a b":"x  \\\" y","n":[4.0,1e3]}'


def test_flatten_edge_payloads(flat):
    events, bad = flat(
        absent=(without(WEATHER, "coord"), AIR),
        null=(WEATHER | {"coord": None}, AIR),
        half=(WEATHER | {"coord": {"lat": None, "lon": 9.0}}, AIR),
        nolon=(WEATHER | {"coord": {"lat": 8.0}}, AIR),
        sky=(WEATHER | {"weather": [], "main": None}, {"list": []}),
        comp=(WEATHER | {"brand_new": {"a": 1}}, {"list": [{"main": None, "components": None}]}),
        typed=(WEATHER | {"visibility": "n/a", "wind": {"speed": "calm", "deg": 7}}, AIR),
        text=("<html>bad gateway</html>", AIR),
        cut=(WEATHER, '{"list": [{'),
    )
    assert {n: (events[n].lat, events[n].lon) for n in ("absent", "null", "half", "nolon")} == {
        "absent": (1.5, 2.5),
        "null": (1.5, 2.5),
        "half": (None, 9.0),
        "nolon": (8.0, 2.5),
    }
    assert (events["sky"].weather_main, events["sky"].temp, events["sky"].aqi) == (None, None, None)
    assert (events["comp"].aqi, events["comp"].pm10) == (None, None)
    typed = events["typed"]
    assert (typed.visibility, typed.wind_speed, typed.wind_deg, typed.temp, typed.aqi) == (None, None, 7, MAIN["temp"], 3)
    assert "brand_new" in events["comp"].raw_payload_json
    assert {(r.city_id, r.reason) for r in bad} == {
        ("text", "unreadable payload: weather"),
        ("cut", "unreadable payload: air_pollution"),
    }
    assert set(events).isdisjoint({"text", "cut"})


def test_parsing_happens_once(spark):
    pairs = spark.range(5).select(
        F.col("id").cast("string").alias("city_id"),
        F.lit(at(0)).alias("poll_timestamp"),
        F.concat(F.lit('{"dt":'), "id", F.lit("}")).alias("weather"),
        F.concat(F.lit('{"dt":'), "id", F.lit("}")).alias("air_pollution"),
    )
    plan = flatten.flatten(pairs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2


def test_event_schema_matches_bronze(flat, spark):
    pairs = spark.createDataFrame(
        [("c", at(0), json.dumps(without(WEATHER, "visibility")), json.dumps(AIR))],
        "city_id STRING, poll_timestamp TIMESTAMP, weather STRING, air_pollution STRING",
    )
    events = flatten.flatten(pairs)
    assert schemas.schema_diff(events, schemas.BRONZE) == []
    assert len(schemas.BRONZE.fields) == 30 and len(schemas.SILVER.fields) == 21 and len(schemas.GOLD.fields) == 12
    wire = json.loads(flatten.to_wire(events).first().value)
    assert list(wire) == schemas.BRONZE.fieldNames()
    assert wire["visibility"] is None and wire["temp"] == MAIN["temp"]


def test_schema_report(spark):
    odd = spark.createDataFrame([("x", 1.0, 2)], "city_id STRING, temp DOUBLE, extra INT").withColumn("aqi", F.lit("3"))
    diff = {(r.field, r.difference) for r in schemas.schema_report(spark, odd, schemas.STREAM_EVENT).collect()}
    assert {("extra", "extra"), ("aqi", "type"), ("pm10", "missing")} <= diff
    assert ("temp", "type") not in diff


def test_publish_round_trip(spark, folder, flat):
    events = flatten.flatten(
        spark.createDataFrame(
            [(c, at(0, 0, 123456), json.dumps(WEATHER), json.dumps(AIR)) for c in ("a", "b")],
            "city_id STRING, poll_timestamp TIMESTAMP, weather STRING, air_pollution STRING",
        )
    )
    sinks.publish(events, folder("topic"))
    records = spark.read.parquet(folder("topic"))
    assert {r.key for r in records.collect()} == {"a", "b"}
    back = lake.decode(records, schemas.BRONZE)
    assert back.exceptAll(events).isEmpty() and back.count() == 2


# --- gate -------------------------------------------------------------------------------------


def bronze_rows(spark, rows):
    """(city, poll, dt, temp, aqi) as full bronze rows."""
    thin = spark.createDataFrame(rows, "city_id STRING, poll_timestamp TIMESTAMP, dt BIGINT, temp DOUBLE, aqi INT")
    thin = thin.withColumn("ingestion_date", F.to_date("poll_timestamp"))
    lacking = [f for f in schemas.BRONZE.fields if f.name not in thin.columns]
    return schemas.conform(thin.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking}), schemas.BRONZE)


def test_gate_splits_rows_completely(spark):
    rows = bronze_rows(
        spark,
        [("a", at(0), 1, 1.0, 1), (None, at(0), 1, 1.0, 1), ("b", at(0), None, 1.0, 1), ("c", at(0), 1, None, None)],
    )
    good, bad = gate.split_required(gate.convert(rows))
    assert [r.city_id for r in good.collect()] == ["a"]
    reasons = {r.city_id: r.reason for r in gate.with_reason(bad).collect()}
    assert reasons == {None: "missing city_id", "b": "missing observation_timestamp", "c": "missing temp,aqi"}
    assert good.unionByName(bad).exceptAll(gate.convert(rows)).isEmpty()


def test_gate_passes_all_good(spark):
    good, bad = gate.split_required(gate.convert(bronze_rows(spark, [("a", at(0), 1, 1.0, 1)])))
    assert good.count() == 1 and bad.isEmpty()


def test_gate_refuses_missing_column(spark):
    batch = gate.convert(bronze_rows(spark, [("a", at(0), 1, 1.0, 1)])).drop("temp")
    with pytest.raises(gate.SchemaValidationError, match="temp"):
        gate.split_required(batch)


def test_dedup_keeps_earliest_and_combines_before_the_shuffle(spark):
    rows = [("hot", at(0, s), 600, float(s), 1) for s in range(50)] + [("a", at(0), 600, 5.0, 1), ("a", at(0), 600, 5.0, 1)]
    silver = gate.to_silver(gate.convert(bronze_rows(spark, rows)))
    assert {(r.city_id, r.temp) for r in silver.collect()} == {("hot", 0.0), ("a", 5.0)}
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")  # the partial limit is below the exchange
    assert "raw_payload_json" not in plan


def test_same_observation_across_midnight(spark):
    late, early = dt.datetime(2024, 3, 1, 23, 59), dt.datetime(2024, 3, 2, 0, 4)
    rows = gate.convert(bronze_rows(spark, [("a", late, 600, 1.0, 1), ("a", early, 600, 1.0, 1)]))
    assert gate.to_silver(rows).count() == 2
    assert gate.to_silver(rows, across_days=True).count() == 1


def test_quality_counters(spark):
    rows = bronze_rows(spark, [("a", at(0), 1, 1.0, 1), ("a", at(1), 1, 1.0, 1), ("a", at(2), 1, None, 1), ("b", at(0), 1, None, 1)])
    r = gate.quality_counters(rows).first()
    assert (r.rows_in, r.quarantined, r.good, r.after_dedup, r.duplicates_removed, r.quarantined_pct) == (4, 2, 2, 1, 1, 50.0)


# --- daily run --------------------------------------------------------------------------------


def write_raw(spark, paths, rows, day=DAY, extra_lines=()):
    lines = [json.dumps(without(r.asDict(), "ingestion_date"), default=lambda v: v.isoformat()) for r in bronze_rows(spark, rows).collect()]
    frame = spark.createDataFrame([(line,) for line in [*lines, *extra_lines]], "value STRING")
    frame.write.mode("overwrite").text(f"{paths.raw}/ingestion_date={day}")


def test_daily_run_and_rerun(spark, folder):
    paths = daily_run.Paths.under(folder("lake"))
    rows = [
        ("a", at(0), 600, 10.0, 2), ("a", at(5), 1200, 20.0, 4), ("a", at(6), 1200, 20.0, 4),
        ("b", at(0), 600, 5.0, 1), ("c", at(0), 600, None, 1),
    ]
    write_raw(spark, paths, rows, extra_lines=["{not json", '{"city_id": "d", "aqi": 4.0, "temp": 1.5, "dt": 600, "visibility": "n/a"}'])
    results = daily_run.run_daily(spark, paths, DAY)
    assert [(r.stage, r.status) for r in results] == [("bronze", "written"), ("silver", "written"), ("gold", "merged")]
    assert results[0].counters == {"rows_in": 7, "unreadable": 1, "rows_out": 6}
    assert results[1].counters == {"rows_in": 6, "quarantined": 1, "rows_out": 4, "good": 5, "duplicates_removed": 1}
    assert results[2].counters == {"rows_merged": 3}
    unreadable = lake.read_days(spark, paths.unreadable, DAY).collect()
    assert [(r.line, r.reason) for r in unreadable] == [("{not json", "unreadable line")]
    assert [r.reason for r in lake.read_days(spark, paths.quarantine, DAY).collect()] == ["missing temp"]

    def gold():
        return sorted(tuple(r[c] for c in schemas.GOLD.fieldNames()) for r in spark.read.parquet(paths.gold).collect())

    first = gold()
    assert [(r[0], r[2], r[7], r[10], r[11]) for r in first] == [("a", 15.0, 4, 2, 15.0), ("b", 5.0, 1, 1, 5.0), ("d", 1.5, 4, 1, 1.5)]
    daily_run.run_daily(spark, paths, DAY)
    assert gold() == first and spark.read.parquet(paths.silver).count() == 4
    assert daily_run.status_frame(spark, results).count() == 3

    # A corrected day replaces its rows; the quarantine empties; gold keeps a city the day now lacks.
    write_raw(spark, paths, [("a", at(0), 600, 12.0, 2), ("c", at(0), 600, 3.0, 1)])
    daily_run.run_daily(spark, paths, DAY)
    assert [(r[0], r[2]) for r in gold()] == [("a", 12.0), ("b", 5.0), ("c", 3.0), ("d", 1.5)]
    assert lake.read_days(spark, paths.quarantine, DAY).isEmpty()
    assert lake.read_days(spark, paths.unreadable, DAY).isEmpty()


def test_daily_run_stops_without_events(spark, folder):
    paths = daily_run.Paths.under(folder("lake"))
    assert [(r.stage, r.status) for r in daily_run.run_daily(spark, paths, DAY)] == [("bronze", "zero_events")]
    assert lake.read_or_none(spark, paths.bronze) is None


def test_day_without_a_complete_row_leaves_no_old_silver(spark, folder):
    paths = daily_run.Paths.under(folder("lake"))
    write_raw(spark, paths, [("a", at(0), 600, 10.0, 2)])
    daily_run.run_daily(spark, paths, DAY)
    write_raw(spark, paths, [("a", at(0), 600, None, 2)])
    results = daily_run.run_daily(spark, paths, DAY)
    assert results[-1].status == "zero_rows"
    assert lake.read_days(spark, paths.silver, DAY).isEmpty()


def test_range_of_days_equals_day_by_day(spark, folder):
    days = [DAY + dt.timedelta(days=n) for n in range(3)]
    one, many = daily_run.Paths.under(folder("one")), daily_run.Paths.under(folder("many"))
    for paths in (one, many):
        for n, day in enumerate(days):
            t = dt.datetime.combine(day, dt.time(8))
            write_raw(spark, paths, [("a", t, 600, 10.0 + n, 2), ("b", t, 600, 1.0 * n, 5)][: 2 - n % 2], day)
    for day in days:
        daily_run.run_daily(spark, one, day)
    daily_run.run_daily(spark, many, days[0], days[-1])
    a, b = spark.read.parquet(one.gold), spark.read.parquet(many.gold)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() == 5


def test_run_parameters():
    assert list(signature(daily_run.run_daily).parameters)[2] == "run_date"
    assert resolve_run_date("2024-03-01") == DAY and trailing_start("2024-03-07") == DAY
    assert resolve_run_date("") == dt.datetime.now(dt.timezone.utc).date()


def test_gold_forms_agree(spark):
    rows = [("a", at(-1440 * n), 600 * n, 1.0 * n, n % 5 + 1) for n in range(9)] + [("b", at(-1440), 600, 3.0, 1)]
    silver = gate.to_silver(gate.convert(bronze_rows(spark, rows)))
    frames = [daily.gold_day(silver, DAY), daily.gold_day_joined(silver, DAY), daily.gold_range(silver, DAY, DAY)]
    results = [sorted(map(tuple, f.collect())) for f in frames]
    assert results[0] == results[1] == results[2]
    assert [(r[0], r[-1]) for r in results[0]] == [("a", 3.0)]  # days 0..6, and nothing for the silent city
    assert all(schemas.schema_diff(f, schemas.GOLD) == [] for f in frames)


# --- sinks ------------------------------------------------------------------------------------


def test_upsert_cases(spark, folder):
    def rows(*values):
        frame = spark.createDataFrame([(c, d, v) for c, d, v in values], "city_id STRING, date DATE, v INT")
        return frame

    other = DAY + dt.timedelta(days=1)
    table = folder("gold")

    def put(frame):
        sinks.upsert(frame, table, ["city_id", "date"], "date")
        return sorted((r.city_id, r.date, r.v) for r in spark.read.parquet(table).collect())

    assert put(rows(("a", DAY, 1), ("b", DAY, 1), ("a", other, 1))) == [("a", DAY, 1), ("a", other, 1), ("b", DAY, 1)]
    assert put(rows(("a", DAY, 2), ("c", DAY, 2))) == [("a", DAY, 2), ("a", other, 1), ("b", DAY, 1), ("c", DAY, 2)]
    again = put(rows(("a", DAY, 2), ("c", DAY, 2)))
    assert again == put(rows(("a", DAY, 2), ("c", DAY, 2)))
    assert put(rows(("a", DAY, 3), ("b", other, 3)))[-1] == ("c", DAY, 2)


def test_append_adds_to_a_partition(spark, folder):
    frame = spark.createDataFrame([("a", DAY)], "city_id STRING, ingestion_date DATE")
    sinks.append(frame, folder("t"))
    sinks.append(frame, folder("t"))
    assert lake.read_days(spark, folder("t"), DAY).count() == 2


def test_upsert_reads_touched_partitions_only(spark, folder, monkeypatch):
    table = folder("t")
    days = [DAY + dt.timedelta(days=n) for n in range(4)]
    make = lambda v: spark.createDataFrame([("a", d, v) for d in days], "city_id STRING, date DATE, v INT")
    sinks.upsert(make(1), table, ["city_id", "date"], "date")
    seen = []
    plain = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths: seen.extend(paths) or plain(self, *paths))
    sinks.upsert(make(2).filter(F.col("date") == F.lit(days[2])), table, ["city_id", "date"], "date")
    monkeypatch.undo()
    assert [p for p in seen if "date=" in p] == [f"{table}/date={days[2]}"] and table not in seen
    assert [r.v for r in spark.read.parquet(table).orderBy("date").collect()] == [1, 1, 2, 1]


def test_upsert_that_ends_halfway_loses_nothing(spark, folder, monkeypatch):
    table, schema = folder("t"), "city_id STRING, date DATE, v INT"
    put = lambda *rows: sinks.upsert(spark.createDataFrame(rows, schema), table, ["city_id", "date"], "date")
    put(("a", DAY, 1), ("b", DAY, 1))

    def die(df, path, partition):
        df.limit(0).write.mode("overwrite").parquet(f"{path}/{partition}={DAY}")  # as far as the old folder is gone
        raise RuntimeError("driver lost")

    monkeypatch.setattr(sinks, "overwrite_partitions", die)
    with pytest.raises(RuntimeError):
        put(("a", DAY, 2))
    monkeypatch.undo()
    assert put(("c", DAY, 3)) == 1
    assert sorted((r.city_id, r.v) for r in spark.read.parquet(table).collect()) == [("a", 2), ("b", 1), ("c", 3)]


def test_clustered_files_cover_narrow_ranges(spark, folder):
    frame = spark.range(4000).select((F.col("id") % 100).alias("city_id"), F.col("id").alias("date"))
    sinks.clustered(frame, "city_id", "date").write.parquet(folder("c"))
    spread = spark.read.parquet(folder("c")).groupBy(F.input_file_name()).agg(F.min("city_id").alias("lo"), F.max("city_id").alias("hi"))
    ranges = sorted((r.lo, r.hi) for r in spread.collect())
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_tables_and_views(spark, folder):
    spark.createDataFrame([("a", DAY, 1)], "city_id STRING, date DATE, v INT").write.partitionBy("date").parquet(folder("p"))
    schema = spark.read.parquet(folder("p")).schema
    assert lake.external_table(spark, "ext_p", folder("p"), schema, partitioned_by=("date",)).count() == 1
    spark.sql("DROP TABLE ext_p")
    assert lake.lake_view(spark, "view_p", folder("p")).first().date == DAY
    plan = spark.sql(f"SELECT * FROM view_p WHERE date = DATE '{DAY}'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    name = "made_here"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    frame = spark.range(3)
    assert sinks.create_if_absent(frame, name) and not sinks.create_if_absent(frame, name)
    assert spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_city_dimension(spark, folder):
    assert lake.read_cities(spark).count() == 12
    path = folder("cities.json")
    with open(path, "w") as f:
        json.dump([{"city_id": "x", "name": "X", "lat": 1, "lon": 2.5}], f, indent=1)
    assert lake.read_cities(spark, path).collect() == [("x", "X", 1.0, 2.5)]


def test_recorded_responses_and_logs(spark, folder):
    lines = [
        {"cycle_id": 1, "city_id": "a", "endpoint": "weather", "attempt": 1, "status": 200.0, "body": "{}", "responded_at": "2024-03-01T12:00:00.5+00:00"},
        {"cycle_id": 1, "city_id": "a", "endpoint": "air_pollution", "attempt": 1, "responded_at": "2024-03-01T12:00:01Z"},
    ]
    with open(folder("r.json"), "w") as f:
        f.writelines(json.dumps(line) + "\n" for line in lines)
    got = sorted(lake.read_responses(spark, folder("r.json")).collect(), key=lambda r: r.endpoint)
    assert [(r.endpoint, r.status, r.responded_at) for r in got] == [
        ("air_pollution", None, at(0, 1)),
        ("weather", 200, at(0, 0, 500000)),
    ]
    metrics = spark.createDataFrame([(at(0), "p", "m", 1.0, 2.0)], schemas.METRIC_LOG)
    metrics.write.json(folder("m"))
    assert lake.read_log(spark, folder("m"), schemas.METRIC_LOG, "json").collect() == metrics.collect()


# --- responses and drift ----------------------------------------------------------------------


def test_response_log(spark):
    ok, bad = json.dumps(WEATHER), "x" * 500
    log = [
        ("good", "weather", 1, 200, ok), ("good", "air_pollution", 1, 200, json.dumps(AIR)),
        ("retry", "weather", 1, 429, bad), ("retry", "weather", 2, 200, ok), ("retry", "air_pollution", 1, 200, json.dumps(AIR)),
        ("down", "weather", 1, 500, bad), ("down", "weather", 2, 502, bad), ("down", "weather", 3, 503, bad),
        ("net", "weather", 1, None, None), ("net", "weather", 2, None, None), ("net", "weather", 3, None, None),
        ("bad", "weather", 1, 400, bad), ("key", "weather", 1, 401, bad), ("gone", "weather", 1, 404, bad),
        ("half", "weather", 1, 200, ok), ("half", "air_pollution", 1, 500, bad),
    ]
    frame = spark.createDataFrame([(1, *r, at(0)) for r in log], schemas.RESPONSE_LOG)
    outcomes = {(r.city_id, r.endpoint): r.outcome for r in responses.response_outcomes(frame).collect()}
    assert outcomes["good", "weather"] == outcomes["retry", "weather"] == "ok"
    assert outcomes["down", "weather"] == "retries_exhausted" and outcomes["net", "weather"] == "network_error"
    assert outcomes["bad", "weather"] == outcomes["gone", "weather"] == "failed_fast"
    assert outcomes["key", "weather"] == "unauthorized" and outcomes["half", "air_pollution"] == "pending_retry"
    details = {r.city_id: r for r in responses.failure_details(frame).collect()}
    assert set(details) == {"bad", "key", "gone"} and len(details["bad"].error_text) == 200
    assert [c for c, r in details.items() if r.concerns_all_cities] == ["key"]
    s = responses.poll_summary(frame).first()
    assert (s.cities, s.cities_succeeded, s.cities_failed, s.calls) == (8, 2, 6, 16)
    assert {r.city_id for r in responses.failed_cities(frame).collect()} == {"down", "net", "bad", "key", "gone", "half"}
    assert {r.city_id for r in flatten.pair_payloads(frame).collect()} == {"good", "retry"}
    assert responses.rate_budget(frame, limit=15).first().over_budget is True


def test_drift_report(spark, flat):
    raw = {"weather": WEATHER | {"uvi": 3, "rain": {"1h": 3.1}}, "air_pollution": AIR}
    frame = spark.createDataFrame([(json.dumps(raw),), (json.dumps({"weather": WEATHER}),), (None,)], "raw_payload_json STRING")
    found = {r.path: r.payloads for r in drift.unmapped_fields(frame).collect()}
    assert found == {"weather.uvi": 1, "weather.rain": 1, "weather.rain.1h": 1}


def test_drift_reads_every_level_and_list_element(spark):
    deep = {"a": {"b": {"c": {"d": {"e": {"f": {"g": {"h": [[{"i": None}]]}}}}}}}}
    lists = [{"dt": 1}, {"dt": 2, "late": 1}, {"late": 2, "x": [1, {"y": 0}]}, 5, None]
    payloads = [{"weather": deep}, {"weather": {"weather": lists}}, {"weather": {"weather": lists[1:]}}, [{"top": 1}, {"top": 2, "{[": "{["}], 3, {}]

    def paths(value, path=()):
        if isinstance(value, dict):
            return {p for k, v in value.items() for p in {".".join((*path, k))} | paths(v, (*path, k))}
        return {p for v in value for p in paths(v, path)} if isinstance(value, list) else set()

    want = {}
    for payload in payloads:
        for path in paths(payload):
            want[path] = want.get(path, 0) + 1
    rows = [(json.dumps(p),) for p in payloads] + [('{"cut":',), (None,)]
    frame = spark.createDataFrame(rows, "raw_payload_json STRING")
    got = {r.path: r.payloads for r in drift.path_counts(frame).collect()}
    assert got == want | {drift.UNREADABLE: 1}
    assert got["weather.a.b.c.d.e.f.g.h.i"] == 1 and got["weather.weather.late"] == 2


# --- serving and monitoring -------------------------------------------------------------------


def test_trend_and_tiles(spark, readings):
    gold = spark.createDataFrame(
        [("b", DAY, 1.0, 2.0, 3.0), ("a", DAY - dt.timedelta(days=30), 1.0, 2.0, 3.0), ("a", DAY - dt.timedelta(days=31), 1.0, 2.0, 3.0)],
        "city_id STRING, date DATE, avg_temp DOUBLE, avg_aqi DOUBLE, rolling_7day_avg_temp DOUBLE",
    )
    assert [r.city_id for r in serving.trend(gold, DAY).collect()] == ["a", "b"]
    assert serving.trend(gold).isEmpty()
    events = readings([("a", at(0), 1.0, 1), ("a", at(9), None, 4), ("b", at(1), 7.0, 5)])
    assert {(r.city_id, r.temp, r.aqi) for r in serving.current_readings(events).collect()} == {("a", None, 4), ("b", 7.0, 5)}
    series = serving.sparkline(alerts.rolling_averages(events)).filter("city_id = 'b'").first()
    assert [p["at"] for p in series.points] == [at(m) for m in (2, 4, 6, 8, 10)]


def test_recent_alerts(readings):
    found = alerts.newest_alerts(alerts.anomaly_alerts(readings([("a", at(m), 1.0, 5) for m in range(0, 60, 20)])))
    recent = serving.recent_alerts(found).limit(2).collect()
    assert [r.detected_at for r in recent] == [at(40), at(20)]
    assert serving.recent_alerts(found, since=str(at(10)), until=str(at(40))).count() == 1
    assert serving.alerts_for_city(found, "nobody").isEmpty()


def test_monitoring_edges(spark):
    runs = spark.createDataFrame(
        [
            ("r1", monitor.PIPELINE, "Failed", at(0), at(0), at(1), "p"),
            ("r2", monitor.PIPELINE, "Failed", at(1), at(0), at(1), "p"),
            ("r3", monitor.PIPELINE, "Succeeded", at(1), at(0), at(1), "p"),
        ],
        schemas.PIPELINE_RUN_LOG,
    )
    acts = spark.createDataFrame(
        [
            ("r1", "bronze_ingest", "Failed", at(0), at(1), "1", "boom"),
            ("r1", "silver_clean_dedup", "TimedOut", at(0), at(1), "2", "slow"),
            ("r1", "elsewhere", "Failed", at(0), at(1), "3", "x"),
            ("r3", "bronze_ingest", "Succeeded", at(0), at(1), None, None),
        ],
        schemas.ACTIVITY_RUN_LOG,
    )
    got = monitor.failed_runs(runs, acts).collect()
    assert {(r.RunId, r.FailedActivityName, r.ErrorMessage) for r in got} == {
        ("r1", "bronze_ingest", "boom"),
        ("r1", "silver_clean_dedup", "slow"),
    }
    empty = spark.createDataFrame([], schemas.BROKER_LOG)
    quiet = spark.createDataFrame([(at(0), "OTHER", "x", "g", "h", "0", 1.0)], schemas.BROKER_LOG)
    assert tuple(monitor.lag_presence(empty).first()) == (0, 0)
    assert tuple(monitor.lag_presence(quiet).first()) == (1, 0)
    metrics = spark.createDataFrame(
        [(at(1), monitor.STREAM_PROVIDER, "ResourceUtilization", 90.0, 95.0), (at(4), monitor.STREAM_PROVIDER, "ResourceUtilization", 70.0, 99.0)],
        schemas.METRIC_LOG,
    )
    r = monitor.utilisation(metrics).first()
    assert (r.TimeGenerated, r.AvgUtilization, r.MaxUtilization) == (at(0), 80.0, 99.0)
    assert monitor.utilisation_alert(metrics).isEmpty()


def test_first_per_key(spark):
    frame = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k STRING, v INT")
    assert sorted(map(tuple, keep.first_per_key(frame, ["k"], ["v"]).collect())) == [("a", 1), ("b", 5)]
