"""JSON details, parameter merge and placeholder rendering as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_variant(col: Column) -> Column:
    """Parsed JSON; NULL where the text is not JSON."""
    return F.try_parse_json(col)


def detail(variant: Column, key: str, type_name: str = "string") -> Column:
    """Value of one key; NULL when the key is absent."""
    return F.variant_get(variant, f"$.{key}", type_name)


def has_detail(variant: Column, key: str) -> Column:
    """True when the key is there, even with a JSON null."""
    return F.variant_get(variant, f"$.{key}", "variant").isNotNull()


def _object_text(text: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit("{}"))


def merge_params(defaults: Column, override: Column) -> Column:
    """JSON object text of ``defaults`` with every key of ``override`` set on top. Blank means ``{}``."""
    old_map, new_map = (F.parse_json(_object_text(c)).cast("map<string,variant>") for c in (defaults, override))
    return F.to_json(F.map_zip_with(old_map, new_map, lambda _, old, new: F.coalesce(new, old)))


def params_map(params: Column) -> Column:
    """JSON object as a text map in its own key order; JSON null becomes the text ``null``, no JSON gives NULL."""
    parsed = F.from_json(_object_text(params), "map<string,string>")
    return F.transform_values(parsed, lambda _, value: F.coalesce(value, F.lit("null")))


def render(sql_col: Column, params: Column) -> Column:
    """Replace each ``{key}`` by its value, in key order; placeholders without a value stay as they are."""
    return F.aggregate(
        F.map_entries(params),
        sql_col,
        lambda text, entry: F.replace(text, F.concat(F.lit("{"), entry["key"], F.lit("}")), entry["value"]),
    )
