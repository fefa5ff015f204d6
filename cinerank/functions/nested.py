"""Tolerant parsing of stringified lists of objects (SCL1-SCL4, TOP1, LIM1).

The reference stores nested metadata as text that is sometimes JSON and
sometimes a Python literal (single quotes, ``None``); anything unparsable,
a lone object or null becomes an empty list, and only object elements are
kept.  A text is parsed once, to a VARIANT, and its fields are read by path.
Only texts that are no JSON go to Python, in Arrow batches, to be read as
Python reads its literals.
"""

from __future__ import annotations

import ast
import json
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def literal_as_json(text: str | None) -> str | None:
    """The JSON form of a text that Python's JSON reader or literal syntax accepts, else None."""
    if text is None:
        return None
    for read in (json.loads, ast.literal_eval):
        try:
            return json.dumps(read(text), default=str, skipkeys=True, allow_nan=False)
        except (ValueError, TypeError, SyntaxError, RecursionError, MemoryError):
            continue
    return None


@F.pandas_udf(StringType())
def _literals(texts: pd.Series) -> pd.Series:
    return texts.map(literal_as_json)


def object_list(text: Column) -> Column:
    """``array<variant>`` of the object elements; never null."""
    v = F.try_parse_json(text)
    other = _literals(F.when(v.isNull(), text))
    items = F.try_variant_get(F.coalesce(v, F.try_parse_json(other)), "$", "array<variant>")
    objs = F.filter(items, lambda x: F.schema_of_variant(x).startswith("OBJECT"))
    return F.coalesce(objs, F.array().cast("array<variant>"))


def _field(obj: Column, key: str) -> Column:
    return F.try_variant_get(obj, f"$.{key}", "string")


def names(objs: Column) -> Column:
    """``name`` of every object; a missing key gives '' and an explicit null stays null."""
    return F.transform(objs, lambda o: F.when(F.try_variant_get(o, "$.name", "variant").isNull(), F.lit("")).otherwise(_field(o, "name")))


def names_where(objs: Column, key: str, value: str) -> Column:
    """``name`` of the objects whose ``key`` equals ``value`` (crew → directors)."""
    return F.transform(F.filter(objs, lambda o: _field(o, key) == F.lit(value)), lambda o: _field(o, "name"))


def first_field(objs: Column, key: str) -> Column:
    """``key`` of the first object, null for an empty list (``get`` is null-safe under ANSI)."""
    return _field(F.get(objs, 0), key)


def tag_string(lists: list[Column], country: Column) -> Column:
    """Concatenate tag lists, drop empty/null tags, lowercase, strip spaces, join by ' '."""
    allt = F.concat(*lists, F.array(F.coalesce(country, F.lit(""))))
    kept = F.filter(allt, lambda t: t.isNotNull() & (t != F.lit("")))
    return F.array_join(F.transform(kept, lambda t: F.replace(F.lower(t), F.lit(" "), F.lit(""))), " ")
