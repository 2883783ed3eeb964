"""UTM data out of journey JSON, attribute JSON and the order's own columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adtrail.functions.measures import as_column
from adtrail.functions.text import trimmed, valid_id

UTM_FIELDS = ["source", "medium", "campaign", "content", "term"]
# Which field names the ad object, most specific first.
ID_ORDER = ["content", "campaign", "medium"]
# The order's own UTM columns.
ORDER_COLUMNS = {f: f"customer_utm_{f}" for f in UTM_FIELDS}

JOURNEY_TYPE = (
    "struct<moments:array<struct<utmParameters:"
    "struct<source:string,medium:string,campaign:string,content:string,term:string>>>>"
)
ATTRIBUTES_TYPE = "array<struct<key:string,value:string>>"


def pick_id(fields: dict[str, Column], usable) -> tuple[Column, Column]:
    """First usable field in id order, and the name of that field."""
    chosen = F.coalesce(*[F.when(usable(fields[f]), fields[f]) for f in ID_ORDER])
    kind = F.coalesce(*[F.when(usable(fields[f]), F.lit(f)) for f in ID_ORDER])
    return chosen, kind


def _touch(fields: dict[str, Column], usable) -> Column:
    chosen, kind = pick_id(fields, usable)
    return F.struct(
        *[fields[f].alias(f) for f in UTM_FIELDS],
        chosen.alias("attribution_id"),
        kind.alias("attribution_type"),
    )


def _present(value: Column) -> Column:
    return F.coalesce(value != "", F.lit(False))


def _known(touch: Column) -> Column:
    return F.when(touch["attribution_id"].isNotNull(), touch)


def moments(journey) -> Column:
    return F.from_json(as_column(journey), JOURNEY_TYPE)["moments"]


def last_usable(parsed_moments: Column) -> Column:
    """Touch of the last moment that yields a valid id; null if there is none."""

    def candidate(moment: Column) -> Column:
        utm = moment["utmParameters"]
        return _touch({f: utm[f] for f in UTM_FIELDS}, valid_id)

    usable = F.filter(
        F.transform(parsed_moments, candidate), lambda t: t["attribution_id"].isNotNull()
    )
    return F.try_element_at(usable, F.lit(-1))


def journey_touch(journey) -> Column:
    return last_usable(moments(journey))


def pairs(attributes) -> Column:
    """[{key, value}] text as an array; null for blank or unreadable text."""
    return F.from_json(as_column(attributes), ATTRIBUTES_TYPE)


def attribute_value(parsed_pairs: Column, key: str, position: int) -> Column:
    """Value of the first (1) or last (-1) pair with this key."""
    found = F.filter(parsed_pairs, lambda pair: pair["key"] == key)
    return F.try_element_at(found, F.lit(position))["value"]


def attribute_fields(parsed_pairs: Column) -> dict[str, Column]:
    """UTM fields of the pairs; of repeated keys the last one counts."""
    return {f: attribute_value(parsed_pairs, f"utm_{f}", -1) for f in UTM_FIELDS}


def known_touch(fields: dict[str, Column]) -> Column:
    """Touch from fields, null where none of them names an id."""
    return _known(_touch(fields, _present))


def attributes_touch(attributes) -> Column:
    return known_touch(attribute_fields(pairs(attributes)))


def first_touch_found(from_journey: Column, from_attributes: Column, from_columns: Column) -> tuple[Column, Column]:
    """(touch, source label): journey first, then attributes, then direct columns."""
    label = (
        F.when(from_journey.isNotNull(), "customer_journey")
        .when(from_attributes.isNotNull(), "custom_attributes")
        .when(from_columns.isNotNull(), "direct_utm")
    )
    return F.coalesce(from_journey, from_attributes, from_columns), label


def journey_ad_id(journey) -> Column:
    """Content of the last moment whose content is a valid id."""
    contents = F.transform(moments(journey), lambda m: m["utmParameters"]["content"])
    return F.try_element_at(F.filter(contents, valid_id), F.lit(-1))


def attributes_ad_id(attributes) -> Column:
    """First utm_content pair's value."""
    return attribute_value(pairs(attributes), "utm_content", 1)
