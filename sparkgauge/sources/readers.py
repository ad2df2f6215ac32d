"""Reading rows, configuration and reference tables."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgauge.functions.sections import TEXT_MAP, TIME_MAP, merge_maps

# Fixed value: text that is a statement rather than the name of a table or view.
STATEMENT = re.compile(r"^\s*(SELECT|WITH|CALL)\b", re.IGNORECASE)


def read_source(spark: SparkSession, source: str | Mapping[str, Any] | Sequence[Mapping[str, Any]]) -> DataFrame:
    """Rows of a table, a view or a statement; objects become rows with one JSON text column.

    Objects are arguments of the call, so their number is small; tables stay distributed.
    """
    if isinstance(source, str):
        return spark.sql(source) if STATEMENT.match(source) else spark.table(source)
    objects = [source] if isinstance(source, Mapping) else list(source)
    return spark.createDataFrame([(json.dumps(o, default=str),) for o in objects], "value string")


def instrumented_from_json(rows: DataFrame, value: str = "value") -> DataFrame:
    """Telemetry rows from JSON objects; a section is an object or the JSON text of one."""

    def field(name: str) -> Column:
        return F.get_json_object(value, f"$['{name}']")

    def section(name: str, kind: str) -> Column:
        return F.coalesce(F.from_json(field(name), kind), F.create_map().cast(kind))

    return rows.select(
        field("TIMESTAMP").try_cast("bigint").alias("timestamp_ns"),
        F.coalesce(field("START_TIME").try_cast("bigint"), field("TIMESTAMP").try_cast("bigint")).alias("start_time"),
        field("END_TIME").try_cast("bigint").alias("end_time"),
        field("NAME").alias("name"),
        F.coalesce(field("_MESSAGE"), field("_message")).alias("message"),
        section("DIMENSIONS", TEXT_MAP).alias("dimensions"),
        section("ATTRIBUTES", TEXT_MAP).alias("attributes"),
        section("METRICS", "map<string,double>").alias("metrics"),
        section("EVENT_TIMESTAMPS", TIME_MAP).alias("event_timestamps"),
    )


def flat_from_json(rows: DataFrame, value: str = "value") -> DataFrame:
    """Flat rows from JSON objects: the message and all members as one text map."""
    members = F.from_json(value, TEXT_MAP)
    return rows.select(
        F.try_element_at(members, F.lit("_message")).alias("message"),
        F.map_filter(members, lambda k, v: (k != "_message") & v.isNotNull()).alias("flat"),
    )


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """Telemetry rows from newline-delimited JSON whose sections are JSON text."""
    return instrumented_from_json(spark.read.text(path))


def explode_json_inventory(rows: DataFrame, array: str, schema: str, millis: Sequence[str] = ()) -> DataFrame:
    """JSON array text to typed rows; the named columns are epoch milliseconds."""
    opened = rows.withColumn("_items", F.from_json(array, schema))
    out = opened.select(*[c for c in rows.columns if c != array], F.inline("_items"))
    return out.withColumns({c: F.timestamp_millis(F.col(c).cast("bigint")) for c in millis})


# --- configuration -------------------------------------------------------------------------


def typed_value(value: Column, kind: Column) -> tuple[Column, Column]:
    """(whole number, text) of a configured value by its declared type; the other one is null."""
    number = F.when(kind == "int", value.try_cast("bigint"))
    return number, F.when(kind == "int", F.when(number.isNull(), value)).otherwise(value)


def config_value(config: DataFrame, path: str, default: Any = None) -> Any:
    """Value at a dotted path, typed by its row, or the default. One row reaches the driver."""
    found = config.filter(F.col("path") == path).select("value", "type").first()
    if found is None or found["value"] is None:
        return default
    if found["type"] == "int":
        try:
            return int(found["value"])
        except ValueError:
            return found["value"]
    if found["type"] == "bool":
        return found["value"].lower() == "true"
    if found["type"] == "list":
        return json.loads(found["value"])
    return found["value"]


def config_subtree(config: DataFrame, prefix: str) -> DataFrame:
    """All values below a dotted path, with the rest of the path as key."""
    number, text = typed_value(F.col("value"), F.col("type"))
    return config.filter(F.col("path").startswith(prefix + ".")).select(
        F.expr(f"substring(path, {len(prefix) + 2})").alias("key"), number.alias("number_value"), text.alias("text_value")
    )


def upsert_by_key(current: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current rows with new values where the key matches, plus the new keys; the result is the next version.

    Both sides hold one row per key.
    """
    values = [c for c in current.columns if c not in keys]
    marked = new.select(*keys, F.lit(True).alias("_new"), *[F.col(c).alias(f"_{c}") for c in values])
    return current.join(marked, list(keys), "full_outer").select(
        *keys, *[F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in values]
    )


# --- semantic names ------------------------------------------------------------------------


def renames(table: DataFrame, old: str = "old", new: str = "new") -> DataFrame:
    """One row (old, new) per field name that changes; the smallest new name of several."""
    pairs = table.select(F.col(old).alias("old"), F.col(new).alias("new")).filter("old IS NOT NULL AND new IS NOT NULL AND old <> new")
    return pairs.groupBy("old").agg(F.min("new").alias("new"))


def read_renames(spark: SparkSession, path: str) -> DataFrame:
    """Mapping file with a header and two columns separated by a semicolon."""
    return renames(spark.read.csv(path, sep=";", header=True).toDF("old", "new"))


def rename_members(members: DataFrame, names: DataFrame, row: Sequence[str], key: str = "key") -> DataFrame:
    """The long form of a section, one row per member, with the names of its keys changed.

    A mapping of any size is joined by name, which adaptive execution broadcasts when it is
    small. A member that has the new name from the start wins over one renamed to it, and of
    several renamed to one name that with the smallest old name stays.
    """
    joined = members.join(names.select(F.col("old").alias(key), F.col("new").alias("_new")), key, "left")
    order = F.struct(F.col("_new").isNotNull(), F.col(key))
    rest = [x for x in members.columns if x not in (*row, key)]
    best = joined.groupBy(*row, F.coalesce("_new", key).alias("_name")).agg(F.min_by(F.struct(*rest), order).alias("_rest"))
    return best.select(*row, F.col("_name").alias(key), "_rest.*")


def rename_fields(section: Column, given: Mapping[str, str]) -> Column:
    """Rename the keys of a section by names that are parameters of the job; a member that already has the new name stays."""
    if not given:
        return section
    names = F.create_map(*[F.lit(x) for pair in given.items() for x in pair])
    kept = F.map_filter(section, lambda k, _: ~F.map_contains_key(names, k))
    moved = F.map_filter(section, lambda k, _: F.map_contains_key(names, k))
    return merge_maps(kept, F.transform_keys(moved, lambda k, _: F.element_at(names, k)))
