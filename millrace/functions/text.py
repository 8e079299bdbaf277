"""Expressions over JSON text and delimited strings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_path(column: Column | str, path: str) -> Column:
    """Value at a dotted path of a JSON text column, as a string; NULL if absent."""
    return F.get_json_object(column, f"$.{path}")


def domain_part(email: Column | str) -> Column:
    """The part after ``@``; NULL rather than an error when there is none."""
    return F.get(F.split(email, "@"), F.lit(1))


def whole_schema(df: DataFrame, column: str) -> T.StructType:
    """The schema of JSON text, from all rows of the column: a field that one row has is found.

    Each task merges the types of its rows, and these are merged in turn, so only one type leaves a task. Fields
    whose rows disagree, and those that are null everywhere, become STRING; text that is no JSON object adds nothing.
    """
    parsed = F.try_parse_json(F.col(column))
    objects = df.select(parsed.alias("v")).where(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))
    found = objects.agg(F.schema_of_variant_agg("v")).first()[0]
    if found in (None, "VOID", "OBJECT<>"):
        return T.StructType()
    ddl = re.sub(r"\bOBJECT<>|\b(VOID|VARIANT)\b", "STRING", found).replace("OBJECT<", "STRUCT<")
    return T.StructType.fromDDL(f"v {ddl}")["v"].dataType
