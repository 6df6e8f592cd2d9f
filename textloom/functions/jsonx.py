"""Nested JSON helpers (JSN-02, JSN-03)."""

import json
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LEAVES = "array<struct<key:string,value:double>>"


def _numeric_leaves(sep: str):
    @F.pandas_udf(_LEAVES)
    def leaves(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _walk(t, sep), na_action="ignore")
    return leaves


def _walk(text: str, sep: str) -> list[dict]:
    """Numeric leaves of one JSON object in document order; an explicit stack, so no depth is too deep to walk."""
    try:
        root = json.loads(text)
    except (ValueError, RecursionError):
        return []
    out, stack = [], [("", root)] if isinstance(root, dict) else []
    while stack:
        path, node = stack.pop()
        if isinstance(node, dict):
            stack.extend((f"{path}{sep}{k}" if path else k, v) for k, v in reversed(node.items()))
        elif isinstance(node, (bool, int, float)):
            out.append({"key": path, "value": _double(node)})
    return out


def _double(value: float) -> float:
    try:
        return float(value)
    except OverflowError:
        return math.copysign(math.inf, value)


def flatten_numbers(df: DataFrame, keys: list[str], json_col: str, sep: str = ".") -> DataFrame:
    """JSN-02: dotted paths of the numeric leaves of a JSON object (booleans count as 0/1).

    One parse per row and one pass; strings, arrays and nulls are skipped, and so is text that is no JSON object.
    Objects are followed as deep as Python's parser reads them (its recursion limit, about a thousand levels).
    """
    found = df.select(*keys, _numeric_leaves(sep)(F.col(json_col)).alias("_leaves"))
    return found.select(*keys, F.explode("_leaves").alias("_l")).select(*keys, "_l.key", "_l.value")


def get_with_default(json_col: Column, path: str, default: str) -> Column:
    """JSN-03: ``a.b.c`` lookup with a default when any level is missing."""
    return F.coalesce(F.get_json_object(json_col, "$." + path), F.lit(default))
