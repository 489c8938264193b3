"""Decoding of model replies."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEYS = ("title_ja", "summary_ja", "category")

REPLY = T.StructType(
    [
        T.StructField("ok", T.BooleanType()),
        *[T.StructField(f"has_{k}", T.BooleanType()) for k in _KEYS],
        *[T.StructField(k, T.StringType()) for k in _KEYS],
    ]
)
_BAD = (False, False, False, False, None, None, None)


def _as_text(value: object) -> str | None:
    if value is None:
        return None
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    # An escaped half of a surrogate pair is legal JSON but not legal in a string column.
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def decode_reply(text: str | None) -> tuple:
    """Strict JSON object, or a reply that is not ok.

    A key that is present with null keeps its null and counts as present. Anything that is not
    an object, or whose category is a list or an object, counts as unreadable.
    """
    try:
        reply = json.loads(text)
    except (ValueError, TypeError, RecursionError):
        return _BAD
    if not isinstance(reply, dict) or isinstance(reply.get("category"), (dict, list)):
        return _BAD
    return (True, *[k in reply for k in _KEYS], *[_as_text(reply.get(k)) for k in _KEYS])


@F.pandas_udf(REPLY)
def parse_reply(texts: pd.Series) -> pd.DataFrame:
    """Spark's own JSON functions take trailing text and single quotes and cannot tell a
    missing key from a null one, so the text is decoded in Python, a batch at a time."""
    return pd.DataFrame([decode_reply(t) for t in texts], columns=REPLY.names)
