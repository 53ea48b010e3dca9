"""Payloads against a declared schema."""

from datetime import date

from pyspark.sql.types import StructType

from gaugeworks.operators.conformance import conformance, declared_fields

SCHEMA = "a STRUCT<b: INT, c: STRING>, l ARRAY<STRUCT<x: DOUBLE, y: BOOLEAN>>, m MAP<STRING, DOUBLE>, t TIMESTAMP"
WHOLE = '{"a":{"b":1,"c":"x"},"l":[{"x":1.5,"y":true}],"m":{"any":1,"other":null},"t":"2024-01-01"}'
ONE, TWO = date(2024, 1, 1), date(2024, 1, 2)


def report(spark, rows):
    events = spark.createDataFrame(rows, "ingestion_date DATE, raw_payload_json STRING, payloads STRING, _d STRING").repartition(3)
    return sorted((tuple(r) for r in conformance(events, StructType.fromDDL(SCHEMA)).collect()), key=repr)


def of(spark, *texts):
    return {r[1:] for r in report(spark, [(ONE, t, "p", "d") for t in texts])}


def test_declared_fields(spark):
    fields = declared_fields(StructType.fromDDL(SCHEMA))
    assert ("l[].x", "l[]", "number") in fields and ("m.*", "m", "number") in fields


def test_conforming_payloads_give_nothing(spark):
    assert of(spark, WHOLE, '{"a":null,"l":[],"m":{},"t":null}', WHOLE, None) == set()


def test_missing_of_an_object_that_is_there(spark):
    assert of(spark, '{"a":{"b":1},"l":[{"x":1},{"x":2}],"m":{}}') == {
        ("a.c", "missing", "string", None, 1),
        ("l[].y", "missing", "boolean", None, 1),
        ("t", "missing", "string", None, 1),
    }
    assert ("a", "missing", "object", None, 2) in of(spark, '{"l":[],"m":{},"t":""}', '{"t":"u"}')


def test_extra_and_other_types(spark):
    got = of(spark, WHOLE[:-1] + ',"new":{"deep":1}}', WHOLE.replace('"y":true', '"y":"yes","z":[1]'), WHOLE.replace('"any":1', '"any":"1"'))
    assert got == {
        ("new", "extra", None, "object", 1),
        ("l[].z", "extra", None, "list", 1),
        ("l[].y", "type", "boolean", "string", 1),
        ("m.any", "type", "number", "string", 1),
    }
    assert of(spark, WHOLE.replace('{"b":1,"c":"x"}', '[{"b":1}]')) == {("a", "type", "object", "list", 1)}
    assert of(spark, "[1]", "7") == {("(payload)", "type", "object", "list", 1), ("(payload)", "type", "object", "number", 1)}


def test_elements_of_several_kinds_count_a_payload_once(spark):
    text = WHOLE.replace('[{"x":1.5,"y":true}]', '[{"x":"s","y":true},{"x":"t","y":false},{"x":1,"y":true},7]')
    assert of(spark, text, text) == {("l[].x", "type", "number", "string", 2), ("l[]", "type", "object", "number", 2)}


def test_days_nulls_and_unreadable(spark):
    rows = [(ONE, "{", "p", "d"), (ONE, "", "p", "d"), (TWO, "{", "p", "d"), (None, WHOLE[:-1] + ',"n":1}', None, None), (TWO, None, None, None)]
    assert report(spark, rows) == sorted(
        [
            (ONE, "(unreadable)", "unreadable", None, None, 2),
            (TWO, "(unreadable)", "unreadable", None, None, 1),
            (None, "n", "extra", None, "number", 1),
        ],
        key=repr,
    )
    assert report(spark, []) == []
