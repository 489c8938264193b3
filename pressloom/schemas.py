"""Schemas of the tables that enter and leave the job."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()

#: One record inside a landed search response; any field may be null or missing.
RAW_ARTICLE = T.StructType(
    [
        T.StructField("source", T.StructType([T.StructField("name", _S)])),
        T.StructField("title", _S),
        T.StructField("description", _S),
        T.StructField("url", _S),
        T.StructField("urlToImage", _S),
        T.StructField("publishedAt", _S),
    ]
)

#: A landed search response. ``group_idx`` names the keyword group that was asked for;
#: ``_corrupt`` receives the text of a line that is not JSON.
RESPONSE = T.StructType(
    [
        T.StructField("group_idx", T.IntegerType()),
        T.StructField("status", _S),
        T.StructField("code", _S),
        T.StructField("message", _S),
        T.StructField("articles", T.ArrayType(RAW_ARTICLE)),
        T.StructField("_corrupt", _S),
    ]
)

#: A stored article: nine keys in this order.
ARTICLE = T.StructType(
    [
        T.StructField("title", _S),
        T.StructField("description", _S),
        T.StructField("url", _S),
        T.StructField("source", _S),
        T.StructField("published_at", _S),
        T.StructField("image_url", _S),
        T.StructField("title_ja", _S),
        T.StructField("summary_ja", _S),
        T.StructField("category", _S),
    ]
)

#: One attempt to get an article translated; outcome is ok, rate_limited or api_error.
ATTEMPT = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("outcome", _S),
        T.StructField("text", _S),
    ]
)
