"""A declared record schema compiled to expressions, which name the rules that a JSON record breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    DATASET_ID_PATTERN,
    GEOGRAPHY_LEVELS,
    METADATA_ADDRESSES,
    METADATA_BOOLEANS,
    METADATA_DATES,
    METADATA_LISTS,
    METADATA_OPTIONAL,
    METADATA_REQUIRED,
)

#: A scheme and the characters that an address may have, others as percent and two digits.
ADDRESS = r"^[A-Za-z][A-Za-z0-9+.-]*:(?:[A-Za-z0-9._~:/?#\[\]@!$&'()*+,;=-]|%[0-9A-Fa-f]{2})+\z"
FORMATS = {
    "date": lambda text: text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & F.try_to_date(text, "yyyy-MM-dd").isNotNull(),
    "uri": lambda text: text.rlike(ADDRESS),
}
#: Keywords that say nothing about values.
REMARKS = {"$schema", "$id", "title", "description", "default", "examples"}
NO_RECORD = "not a record"


def metadata_schema() -> dict:
    """The schema that a dataset's metadata record is declared with."""
    properties = {name: {"type": "string"} for name in (*METADATA_REQUIRED, *METADATA_OPTIONAL)}
    properties["dataset_id"]["pattern"] = DATASET_ID_PATTERN
    properties["geography_level"]["enum"] = list(GEOGRAPHY_LEVELS)
    for name in METADATA_DATES:
        properties[name]["format"] = "date"
    for name in METADATA_ADDRESSES:
        properties[name]["format"] = "uri"
    for name in METADATA_BOOLEANS:
        properties[name] = {"type": "boolean"}
    for name in METADATA_LISTS:
        properties[name] = {"type": "array", "items": {"type": "string"}, "minItems": 1}
    return {
        "type": "object", "required": list(METADATA_REQUIRED), "properties": properties, "additionalProperties": False,
    }


def _is_type(kind: Column, value: Column, name: str) -> Column:
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    as_double = F.try_variant_get(value, "$", "double")
    known = {
        "string": kind == "STRING",
        "boolean": kind == "BOOLEAN",
        "number": number,
        "integer": number & (as_double == F.floor(as_double)),  # 1.0 is one too
        "array": kind.startswith("ARRAY"),
        "object": kind.startswith("OBJECT"),
        "null": kind == "VOID",
    }
    return known[name]


class _Steps:
    """Columns that many rules read, by how many others come before them: each is computed once a record, where an
    expression that rules repeat would be computed for each of them."""

    def __init__(self) -> None:
        self.levels: list[dict[str, Column]] = []

    def keep(self, level: int, column: Column) -> Column:
        while len(self.levels) <= level:
            self.levels.append({})
        name = f"_step_{level}_{len(self.levels[level])}"
        self.levels[level][name] = column
        return F.col(name)

    def added_to(self, rows: DataFrame) -> DataFrame:
        for columns in self.levels:
            rows = rows.withColumns(columns) if columns else rows
        return rows

    def names(self) -> list[str]:
        return [name for columns in self.levels for name in columns]


def _broken(schema: dict, value: Column, path: str, keep=lambda level, column: column, level: int = 0) -> list[Column]:
    """Arrays of the rules that a value which is there breaks, as `path/keyword`.

    A rule about one type holds for values of other types. Keywords that are not known are an error, so that no rule
    is passed over. `keep` makes a column of what several rules read; inside a list there are no columns.
    """
    kind = keep(level, F.schema_of_variant(value))
    text = F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
    items = F.when(kind.startswith("ARRAY"), F.try_variant_get(value, "$", "array<variant>"))
    if {"required", "properties", "additionalProperties"} & schema.keys():
        members = F.when(kind.startswith("OBJECT"), F.try_variant_get(value, "$", "map<string,variant>"))
        members = keep(level + 1, members)
    if {"enum", "pattern", "format"} & schema.keys():
        text = keep(level + 1, text)
    if {"minItems", "items"} <= schema.keys():
        items = keep(level + 1, items)
    out = []

    def rule(keyword: str, holds: Column) -> None:
        """Broken only where the condition is false: it is null for values that the rule is not about."""
        out.append(F.array_compact(F.array(F.when(~holds, F.lit(f"{path}/{keyword}".lstrip("/"))))))

    for keyword, wanted in schema.items():
        if keyword in REMARKS:
            continue
        elif keyword == "type":
            names = [wanted] if isinstance(wanted, str) else wanted
            holds = F.lit(False)
            for name in names:
                holds = holds | F.coalesce(_is_type(kind, value, name), F.lit(False))
            rule(keyword, holds)
        elif keyword == "enum":
            if not all(isinstance(one, str) for one in wanted):
                raise ValueError("an enum of other values than texts")
            rule(keyword, F.coalesce(text.isin(*wanted), F.lit(False)))
        elif keyword == "pattern":
            # There, a dollar sign is the end of the text; here it would also stand before a last line break.
            rule(keyword, text.rlike(wanted[:-1] + r"\z" if wanted.endswith("$") and not wanted.endswith(r"\$") else wanted))
        elif keyword == "format":
            rule(keyword, FORMATS[wanted](text))
        elif keyword == "minItems":
            rule(keyword, F.when(items.isNotNull(), F.size(items) >= wanted))
        elif keyword == "items":
            each = F.transform(items, lambda item: F.array_distinct(F.concat(*_none(), *_broken(wanted, item, f"{path}/items"))))
            out.append(F.coalesce(F.flatten(each), _none()[0]))
        elif keyword == "required":
            absent = [F.when(~F.array_contains(F.map_keys(members), name), F.lit(f"{path}/{name}/required".lstrip("/"))) for name in wanted]
            out.append(F.array_compact(F.array(*absent)) if absent else _none()[0])
        elif keyword == "properties":
            for name, inner in wanted.items():
                member = keep(level + 2, F.try_element_at(members, F.lit(name)))
                found = F.concat(*_none(), *_broken(inner, member, f"{path}/{name}", keep, level + 3))
                out.append(F.when(member.isNotNull(), found).otherwise(_none()[0]))
        elif keyword == "additionalProperties" and wanted is False:
            more = F.array_except(F.map_keys(members), F.array(*[F.lit(n) for n in schema.get("properties", {})]).cast("array<string>"))
            told = F.transform(more, lambda name: F.ltrim(F.concat(F.lit(f"{path}/"), name, F.lit("/undeclared")), F.lit("/")))
            out.append(F.coalesce(told, _none()[0]))
        else:
            raise ValueError(f"schema keyword {keyword} is not known")
    return out


def _none() -> list[Column]:
    return [F.array().cast("array<string>")]


def check_schema(records: DataFrame, schema: dict | None = None, record: str = "record") -> DataFrame:
    """The records with `violations`, the rules each breaks in order, and `is_valid`.

    `schema` is a JSON Schema as a dict, by default that of metadata records, of the keywords type, enum (of texts),
    pattern, format (date, uri), minItems, items, required, properties and additionalProperties (false). A rule is named
    `field/keyword`, a field that is not declared `field/undeclared`. Null, and text that is not JSON or repeats a
    field, breaks the rule `not a record`. Records are parsed once; all rules are expressions over the parsed value.
    """
    schema = metadata_schema() if schema is None else schema
    steps = _Steps()
    value = steps.keep(0, F.try_parse_json(F.col(record)))
    found = F.array_sort(F.array_distinct(F.concat(*_none(), *_broken(schema, value, "", steps.keep, 1))))
    told = F.when(value.isNull(), F.array(F.lit(NO_RECORD))).otherwise(found)
    checked = steps.added_to(records).withColumn("violations", told).drop(*steps.names())
    return checked.withColumn("is_valid", F.size("violations") == 0)
