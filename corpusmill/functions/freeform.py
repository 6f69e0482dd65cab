"""Free-form JSON values: VARIANT columns whose keys no schema names.

``merge_values`` stays in the JVM: objects are zipped as maps, so a key that is
absent (SQL null) differs from one that holds JSON null. ``rewrite_values`` walks
values of any shape and depth, which no built-in function does; it runs in Arrow
batches on the JSON text of these columns alone. Its function is shipped by value,
so executors need pandas and pyarrow but not this package.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def value_kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, VOID, ... (null if the value is absent)."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def as_map(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def depth_of(document) -> int:
    """Levels of objects in a configuration document."""
    return 1 + max(map(depth_of, document.values()), default=0) if isinstance(document, dict) else 0


def merge_values(over: Column, base: Column, depth: int) -> Column:
    """``over`` over ``base``, key by key down to ``depth`` levels of objects (those
    of the configuration side; nothing below them can meet). A key of ``over`` wins
    whatever it holds, JSON null included, unless both sides hold objects."""
    if depth == 0:
        return F.coalesce(over, base)
    both = (value_kind(over) == "OBJECT") & (value_kind(base) == "OBJECT")
    zipped = F.map_zip_with(as_map(over), as_map(base), lambda _, a, b: merge_values(a, b, depth - 1))
    return F.when(both, F.to_variant_object(zipped)).otherwise(F.coalesce(over, base))


def without_keys(value: Column, keys) -> Column:
    """An object without some of its own keys; null for other values."""
    return F.to_variant_object(F.map_filter(as_map(value), lambda k, _: ~k.isin(*keys)))


def has_variant(kind: T.DataType) -> bool:
    if isinstance(kind, T.VariantType):
        return True
    if isinstance(kind, T.ArrayType):
        return has_variant(kind.elementType)
    if isinstance(kind, T.MapType):
        return has_variant(kind.valueType)
    return isinstance(kind, T.StructType) and any(has_variant(f.dataType) for f in kind.fields)


def json_rewriter(drop=frozenset(), rules=()):
    """JSON text -> JSON text without the keys ``drop`` at any depth and with
    ``rules`` (pattern, flags, replacement of Python's ``re``) applied in order to
    every string value. Numbers keep their spelling."""
    drop = frozenset(drop)
    compiled = [(re.compile(pattern, flags), replacement) for pattern, flags, replacement in rules]

    class Number(str):
        """A number as it was written."""

    def write(x) -> str:
        if isinstance(x, Number):
            return str(x)
        if isinstance(x, str):
            for pattern, replacement in compiled:
                x = pattern.sub(replacement, x)
        elif isinstance(x, list):
            return "[" + ",".join(map(write, x)) + "]"
        elif isinstance(x, dict):
            return "{" + ",".join(f"{json.dumps(k)}:{write(v)}" for k, v in x.items() if k not in drop) + "}"
        return json.dumps(x, ensure_ascii=False)

    return lambda text: write(json.loads(text, parse_int=Number, parse_float=Number))


def rewrite_values(value: Column, drop=frozenset(), rules=()) -> Column:
    """A VARIANT walked by ``json_rewriter``; absent and JSON null stay."""
    rewrite = json_rewriter(drop, rules)

    def each(texts: pd.Series) -> pd.Series:
        return texts.map(rewrite, na_action="ignore")

    return F.parse_json(F.pandas_udf(each, "string")(F.to_json(value)))
