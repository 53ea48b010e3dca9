"""Payload fields that no event column is made from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: payload paths that become columns, or hold some that do ---
MAPPED_PATHS = (
    "weather",
    "weather.coord",
    "weather.coord.lat",
    "weather.coord.lon",
    "weather.weather",
    "weather.weather.main",
    "weather.weather.description",
    "weather.main",
    "weather.main.temp",
    "weather.main.feels_like",
    "weather.main.temp_min",
    "weather.main.temp_max",
    "weather.main.pressure",
    "weather.main.humidity",
    "weather.visibility",
    "weather.wind",
    "weather.wind.speed",
    "weather.wind.deg",
    "weather.clouds",
    "weather.clouds.all",
    "weather.dt",
    "air_pollution",
    "air_pollution.list",
    "air_pollution.list.main",
    "air_pollution.list.main.aqi",
    "air_pollution.list.components",
    "air_pollution.list.components.co",
    "air_pollution.list.components.no",
    "air_pollution.list.components.no2",
    "air_pollution.list.components.o3",
    "air_pollution.list.components.so2",
    "air_pollution.list.components.pm2_5",
    "air_pollution.list.components.pm10",
    "air_pollution.list.components.nh3",
)

UNREADABLE = "(unreadable)"


def opened(nodes: Column, element: str = "") -> Column:
    """The fields of all objects and the elements of all lists among (path, value) nodes; an element has
    the path of its list with ``element`` behind it. The path of a root is null or empty."""

    def fields(node):
        entries = F.map_entries(F.try_variant_get(node["value"], "$", "map<string,variant>"))
        return F.transform(
            entries, lambda e: F.struct(F.concat_ws(".", F.nullif(node["path"], F.lit("")), e["key"]).alias("path"), e["value"].alias("value"))
        )

    def of_element(path):
        return F.concat(path, F.lit(element)) if element else path

    def elements(node):
        items = F.try_variant_get(node["value"], "$", "array<variant>")
        return F.transform(items, lambda x: F.struct(of_element(node["path"]).alias("path"), x.alias("value")))

    return F.flatten(F.transform(nodes, lambda node: F.coalesce(fields(node), elements(node), F.array())))


def shape(value: str) -> Column:
    """Text that is the same for payloads with the same paths: the schema of a payload, with one name for
    all numbers, as their digits do not matter here."""
    return F.regexp_replace(F.schema_of_variant(value), r": (?:BIGINT|DECIMAL\(\d+,\d+\)|DOUBLE|FLOAT)(?=[,>])", ": NUMBER")


def path_counts(events: DataFrame, payload: str = "raw_payload_json") -> DataFrame:
    """(path, payloads): how many payloads carry each field, on every level and in every list element.

    Payloads are counted by shape, which combines ahead of the shuffle, and one payload of each shape is
    opened, level by level, as often as it has opening brackets, which is no less than it has levels.
    A schema merges the elements of a list. Where elements or values of different kinds meet, it names
    none of their fields, and where names are quoted they could look like types; such a payload is a shape
    by itself, text for text. A path counts once per payload.
    """
    # Each explode of one element keeps what stands above from being merged into what is computed once:
    # the text, which may be put together on the way, and its shape.
    texts = events.select(F.explode(F.array(payload)).alias("_text")).where("_text IS NOT NULL")
    parsed = texts.select("_text", F.try_parse_json("_text").alias("_v"))
    told = parsed.select("_text", F.explode(F.array(F.when(F.col("_v").isNotNull(), shape("_v")))).alias("_shape"))
    unclear = F.col("_shape").contains("VARIANT") | F.col("_shape").contains("`")
    # Unreadable texts are one shape; they have no paths to tell apart.
    kinds = told.groupBy("_shape", F.when(unclear, F.col("_text")).alias("_own")).agg(
        F.count("*").alias("_payloads"), F.min("_text").alias("_text")
    )
    brackets = F.length("_text") - F.length(F.translate("_text", "{[", ""))
    rows = kinds.select(F.try_parse_json("_text").alias("_v"), brackets.alias("_n"), "_payloads")
    root = F.array(F.struct(F.lit(None).cast("string").alias("path"), F.col("_v").alias("value")))

    def level(state, _):
        nodes = opened(state["nodes"])
        found = F.filter(F.transform(nodes, lambda n: n["path"]), lambda p: p.isNotNull())
        return F.struct(nodes.alias("nodes"), F.array_union(state["paths"], found).alias("paths"))

    start = F.struct(root.alias("nodes"), F.array().cast("array<string>").alias("paths"))
    paths = F.aggregate(F.sequence(F.lit(0), "_n"), start, level, lambda state: state["paths"])
    listed = F.when(F.col("_v").isNull(), F.array(F.lit(UNREADABLE))).otherwise(paths)
    return rows.select(F.explode(listed).alias("path"), "_payloads").groupBy("path").agg(F.sum("_payloads").alias("payloads"))


def unmapped_fields(
    events: DataFrame, payload: str = "raw_payload_json", mapped: tuple[str, ...] = MAPPED_PATHS
) -> DataFrame:
    """Paths outside the mapping with the number of payloads that carry them; a field below an
    unmapped one is listed too."""
    return path_counts(events, payload).filter(~F.col("path").isin(*mapped))
