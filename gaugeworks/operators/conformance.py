"""Payloads against a declared schema, on every level, by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, MapType, NumericType, StructType

from gaugeworks.operators.drift import UNREADABLE, opened, shape

ELEMENT = "[]"
ANY_KEY = "*"


def kind_of(declared: DataType) -> str:
    """What a value of a declared type looks like in JSON; dates and the like are strings."""
    for types, name in (((StructType, MapType), "object"), (ArrayType, "list"), (NumericType, "number"), (BooleanType, "boolean")):
        if isinstance(declared, types):
            return name
    return "string"


def declared_fields(declared: DataType, path: str = "") -> list[tuple[str, str, str]]:
    """(path, path of the object it belongs to, kind) of all that a schema names, below ``path``. The
    elements of a list are ``path[]``, the values of a map ``path.*``. Fields come before what is in them."""
    if isinstance(declared, StructType):
        below = [(f.name if not path else f"{path}.{f.name}", f.dataType) for f in declared.fields]
    elif isinstance(declared, ArrayType):
        below = [(path + ELEMENT, declared.elementType)]
    elif isinstance(declared, MapType):
        below = [(f"{path}.{ANY_KEY}", declared.valueType)]
    else:
        return []
    return [row for name, t in below for row in [(name, path, kind_of(t)), *declared_fields(t, name)]]


def found_kind(value: Column) -> Column:
    """The kind of a variant, in the words of ``kind_of``, or ``null``."""
    told = F.schema_of_variant(value)
    return (
        F.when(told.startswith("OBJECT"), "object")
        .when(told.startswith("ARRAY"), "list")
        .when(told == "STRING", "string")
        .when(told == "BOOLEAN", "boolean")
        .when(told == "VOID", "null")
        .otherwise("number")
    )


def found_fields(value: str, rounds: Column) -> Column:
    """The distinct (path, kind) of a variant column on as many levels as ``rounds``; the root is ``''``."""

    def entry(node):
        return F.struct(node["path"].alias("path"), found_kind(node["value"]).alias("kind"))

    def level(state, _):
        nodes = opened(state["nodes"], ELEMENT)
        return F.struct(nodes.alias("nodes"), F.array_union(state["fields"], F.transform(nodes, entry)).alias("fields"))

    root = F.array(F.struct(F.lit("").alias("path"), F.col(value).alias("value")))
    start = F.struct(root.alias("nodes"), F.transform(root, entry).alias("fields"))
    return F.aggregate(F.sequence(F.lit(0), rounds), start, level, lambda state: state["fields"])


def differences(fields: str, expected: StructType) -> Column:
    """(field, difference, expected, found) of one payload's (path, kind) list."""
    declared = declared_fields(expected)
    kinds = F.create_map(*[F.lit(x) for path, _, kind in [("", "", "object"), *declared] for x in (path, kind)])
    maps = {owner for path, owner, _ in declared if path.endswith(f".{ANY_KEY}")}
    named = F.array(
        *[
            F.struct(F.lit(path).alias("path"), F.lit(owner).alias("owner"), F.lit(kind).alias("kind"))
            for path, owner, kind in declared
            if not path.endswith((ELEMENT, f".{ANY_KEY}"))
        ]
    )
    paths = F.transform(fields, lambda f: f["path"])
    objects = F.transform(F.filter(fields, lambda f: f["kind"] == "object"), lambda f: f["path"])

    def owner(path):
        inside = F.when(path.contains("."), F.regexp_replace(path, r"\.[^.]*$", "")).otherwise("")
        return F.when(path.endswith(ELEMENT), F.left(path, F.length(path) - len(ELEMENT))).otherwise(inside)

    def wanted(path):
        known = F.try_element_at(kinds, path)
        if not maps:
            return known
        return F.when(known.isNull() & owner(path).isin(*maps), F.try_element_at(kinds, F.concat(owner(path), F.lit(f".{ANY_KEY}")))).otherwise(known)

    def row(path, difference, want, found):
        return F.struct(path.alias("field"), F.lit(difference).alias("difference"), want.alias("expected"), found.alias("found"))

    nothing = F.lit(None).cast("string")
    lacking = F.filter(named, lambda d: F.array_contains(objects, d["owner"]) & ~F.array_contains(paths, d["path"]))
    extra = F.filter(
        fields,
        lambda f: wanted(f["path"]).isNull()
        & F.array_contains(objects, owner(f["path"]))
        & (F.try_element_at(kinds, owner(f["path"])) == "object"),
    )
    other = F.filter(fields, lambda f: (f["kind"] != "null") & (wanted(f["path"]) != f["kind"]))
    return F.concat(
        F.transform(lacking, lambda d: row(d["path"], "missing", d["kind"], nothing)),
        F.transform(extra, lambda f: row(f["path"], "extra", nothing, f["kind"])),
        F.transform(other, lambda f: row(F.when(f["path"] == "", "(payload)").otherwise(f["path"]), "type", wanted(f["path"]), f["kind"])),
    )


def conformance(events: DataFrame, expected: StructType, payload: str = "raw_payload_json", day: str = "ingestion_date") -> DataFrame:
    """(day, field, difference, expected, found, payloads): in how many payloads of a day a field departs
    from the schema.

    A declared field is ``missing`` where the object it belongs to is there without it, so a missing object
    is one row and not one for each of its fields; a null is there and of any type. A field is ``extra`` if the
    object around it is declared and it is not; what is inside it is not listed. ``type`` tells objects, lists,
    strings, numbers and booleans apart. In a list the elements of a payload count together. Texts that are no
    JSON are one row of difference ``unreadable``; a null text is none. A null day is a day.

    Payloads of a day are counted by their shape, which combines ahead of the shuffle, and one of each shape is
    looked at. Names that hold a dot or end in ``[]`` are taken for a
    path.
    """
    # As in ``drift.path_counts``: the explodes keep a text and its shape from being computed again.
    texts = events.select(F.col(day).alias("_day"), F.explode(F.array(payload)).alias("_text")).where("_text IS NOT NULL")
    parsed = texts.select("*", F.try_parse_json("_text").alias("_v"))
    told = parsed.select("_day", "_text", F.explode(F.array(F.when(F.col("_v").isNotNull(), shape("_v")))).alias("_shape"))
    unclear = F.col("_shape").contains("VARIANT") | F.col("_shape").contains("`")
    kinds = told.groupBy("_day", "_shape", F.when(unclear, F.col("_text")).alias("_own")).agg(
        F.count("*").alias("_payloads"), F.min("_text").alias("_text")
    )
    brackets = F.length("_text") - F.length(F.translate("_text", "{[", ""))
    rows = kinds.select("_day", "_payloads", brackets.alias("_n"), F.try_parse_json("_text").alias("_v"))
    fields = rows.select(
        "_day", "_payloads", F.explode(F.array(F.when(F.col("_v").isNotNull(), found_fields("_v", F.col("_n"))))).alias("_fields")
    )
    nothing = F.lit(None).cast("string")
    broken = F.struct(
        F.lit(UNREADABLE).alias("field"), F.lit("unreadable").alias("difference"), nothing.alias("expected"), nothing.alias("found")
    )
    found = F.when(F.col("_fields").isNull(), F.array(broken)).otherwise(differences("_fields", expected))
    return (
        fields.select(F.col("_day").alias(day), "_payloads", F.explode(found).alias("_d"))
        .groupBy(day, "_d.field", "_d.difference", "_d.expected", "_d.found")
        .agg(F.sum("_payloads").alias("payloads"))
    )
