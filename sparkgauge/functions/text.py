"""Text, key and pattern expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def escape_value(value: Column) -> Column:
    """Escape backslash and double quote."""
    return F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def escape_list(values: Column) -> Column:
    """Escape every element and join with commas."""
    return F.array_join(F.transform(values, escape_value), ",")


def clean_key(key: Column) -> Column:
    """Lowercase letters, digits and underscores; white space becomes one underscore."""
    return F.lower(F.regexp_replace(F.regexp_replace(key, r"[^a-zA-Z0-9_\s]", ""), r"\s+", "_"))


# Patterns of personal or tenant data and what takes their place.
DENY_PATTERNS: dict[str, tuple[str, str]] = {
    "public_ipv4": (
        r"\b(?!(?:10|127)\.)(?!192\.168\.)(?!172\.(?:1[6-9]|2[0-9]|3[01])\.)(?!0\.0\.0\.0\b)"
        r"(?:[1-9]\d?|1\d{2}|2(?:[0-4]\d|5[0-5]))\.(?:\d{1,3}\.){2}\d{1,3}\b",
        "10.0.0.1",
    ),
    "tenant_id_prefix": (r"\w{3}\d{4}(\w|\d)", "test-tenant"),
}


def sanitize_text(text: Column, patterns: Mapping[str, tuple[str, str]] = DENY_PATTERNS) -> tuple[Column, Column]:
    """(clean text, number of replacements); each pattern works on what the earlier ones left."""
    hits = F.lit(0).cast("bigint")
    for pattern, replacement in patterns.values():
        hits = hits + F.regexp_count(text, F.lit(pattern)).cast("bigint")
        text = F.regexp_replace(text, pattern, replacement)
    return text, hits


def hash_email(email: Column, hashed: bool = True) -> Column:
    return F.sha2(email, 256) if hashed else email


def hash_user(name: Column) -> Column:
    return F.sha1(name)


def mask_ip(ip: Column) -> Column:
    """The first three characters of an address."""
    return F.substring(ip, 1, 3)


def extract_target_table(definition: Column) -> tuple[Column, Column]:
    """(target of a load statement, its bare name); null when there is none."""
    full = F.nullif(F.regexp_extract(definition, r"(?is)INTO\s+(\S+)", 1), F.lit(""))
    return full, F.split_part(full, F.lit("."), F.lit(-1))


def compress_columns(properties: Column) -> Column:
    """Columns of a schema change as a map: sub-operation -> sorted column names.

    The change lists its columns as an object by name or as a list of objects.
    """
    as_list = F.from_json(
        F.get_json_object(properties, "$.columns"), "array<struct<objectName:string,subOperationType:string>>"
    )
    as_map = F.from_json(F.get_json_object(properties, "$.columns"), "map<string,struct<subOperationType:string>>")
    from_map = F.transform(
        F.map_entries(as_map),
        lambda e: F.struct(e["key"].alias("objectName"), e["value"]["subOperationType"].alias("subOperationType")),
    )
    is_list = F.get_json_object(properties, "$.columns").startswith("[")
    pairs = F.transform(
        F.when(is_list, as_list).otherwise(from_map),
        lambda c: F.struct(
            F.coalesce(c["objectName"], F.lit("")).alias("name"),
            F.coalesce(c["subOperationType"], F.lit("unknown")).alias("op"),
        ),
    )
    ops = F.array_distinct(F.transform(pairs, lambda c: c["op"]))
    return F.map_from_entries(
        F.transform(
            F.array_sort(ops),
            lambda op: F.struct(
                op, F.array_sort(F.transform(F.filter(pairs, lambda c: c["op"] == op), lambda c: c["name"]))
            ),
        )
    )


def unquote_content(text: Column) -> Column:
    """Strip one pair of double quotes around text of two or more characters."""
    return F.regexp_replace(text, r'(?s)^["]?+(.+[^"])["]?$', "$1")


def json_or_null(text: Column) -> Column:
    """The text as a variant, null when it is not JSON."""
    return F.try_parse_json(text)


def normalize_tag(tag: Column, pattern: str) -> Column:
    """Replace the varying part of a tag, so that variants group together."""
    return F.regexp_replace(tag, pattern, "#")


def parse_prefix(name: Column, separator: str = "_") -> Column:
    """Text before the first separator; null when the name has none or nothing follows it."""
    sep = re.escape(separator)
    return F.nullif(F.regexp_extract(name, rf"(?s)^(.*?){sep}.+$", 1), F.lit(""))


def parse_call_arguments(text: Column, call: str) -> Column:
    """Quoted arguments of the list in ``call('a', 'b')``; null when the text is not such a call.

    ``call`` is a pattern for everything before the first quote.
    """
    listed = F.regexp_extract(text, rf"(?i){call}((?:'[^']*'(?:, ?)?)+)\)", 1)
    return F.when(listed != "", F.regexp_extract_all(listed, F.lit("'([^']*)'"), F.lit(1)))


def coerce_array(value: Column) -> Column:
    """JSON-array text, or a scalar, as an array of text."""
    parsed = F.from_json(value, "array<string>")
    return F.when(value.isNull(), None).when(F.trim(value).startswith("[") & parsed.isNotNull(), parsed).otherwise(F.array(value))


def message_template(template: str, dimensions: Mapping[str, Column]) -> Column:
    """Fill ``{dims:key}`` places of a fixed template from columns."""
    out: list[Column] = []
    at = 0
    for hit in re.finditer(r"\{dims:(\S*?)\}", template):
        out += [F.lit(template[at : hit.start()]), F.coalesce(dimensions[hit[1]].cast("string"), F.lit("undefined"))]
        at = hit.end()
    return F.concat(*out, F.lit(template[at:]))


def fill_template(template: Column, dimensions: Column) -> Column:
    """Fill ``{dims:key}`` places of a template column from a map column."""
    return F.aggregate(
        F.map_entries(dimensions),
        template,
        lambda text, e: F.replace(
            text, F.concat(F.lit("{dims:"), e["key"], F.lit("}")), F.coalesce(e["value"], F.lit("undefined"))
        ),
    )


def flatten_log_attributes(
    sections: Sequence[Column], scope: Column, own: Mapping[str, Column], scope_prefix: str = "event.scope."
) -> Column:
    """One map of a log record: own columns win, then scope members with a prefix, then the sections.

    Own columns get lowercase names; names that start with ``_`` are internal and left out.
    """
    from sparkgauge.functions.sections import merge_maps, text_section

    mine = text_section({k.lower(): v for k, v in own.items() if not k.startswith("_")})
    prefixed = F.transform_keys(scope, lambda k, _: F.concat(F.lit(scope_prefix), k))
    return merge_maps(mine, prefixed, *sections)


def user_kind(user: Column) -> Column:
    """A name with a dot is a person's, any other a service's."""
    return F.when(user.like("%.%"), F.lit("Human user")).otherwise(F.lit("Service user"))


def of_user_kinds(user: Column, kinds: Iterable[str]) -> Column:
    return user_kind(user).isin(*kinds) & user.isNotNull()
