"""JSON inside text."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from millrace.functions.columns import col


def json_path(c: Column | str, path: str, default=None) -> Column:
    """Value at a JSON path as text; the default when it is missing or not valid JSON."""
    v = F.get_json_object(col(c), path)
    return v if default is None else F.coalesce(v, F.lit(default))


def first_object(text: str | None) -> str | None:
    """The first JSON object in a text, as it stands there; a brace that opens none is passed over."""
    decoder = json.JSONDecoder()
    for brace in re.finditer(r"\{", text or ""):
        try:
            _, end = decoder.raw_decode(text, brace.start())
        except (ValueError, RecursionError):
            continue
        return text[brace.start() : end]
    return None


@F.pandas_udf(T.StringType())
def balanced_json(s: pd.Series) -> pd.Series:
    """Column form of :func:`first_object`; JSON is no regular language."""
    return s.map(first_object)
