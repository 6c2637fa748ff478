"""Explicit schemas of the pipeline's stages; an empty stage keeps its schema."""

from __future__ import annotations

from pyspark.sql import types as T


_KINDS = {"STRING": T.StringType, "BINARY": T.BinaryType, "INT": T.IntegerType, "BIGINT": T.LongType, "DOUBLE": T.DoubleType}


def struct(text: str) -> T.StructType:
    """Schema of ``name KIND, ...``; unlike ``fromDDL`` it needs no session."""
    return T.StructType([T.StructField(name, _KINDS[kind.upper()](), True) for name, kind in map(str.split, text.split(","))])


URL_LIST = struct("snapshot_id STRING, value STRING")
WARC_RECORD = struct("rec_type STRING, url STRING, content_type STRING, payload BINARY")
RAW_HTML = struct("url STRING, html STRING")
GOOD_HTML = struct("title STRING, url STRING, text STRING, html STRING")
PAIR = struct("url STRING, caption STRING, page_title STRING, page_url STRING, text STRING")
IMAGE = T.StructType([*PAIR.fields, *struct("jpg BINARY, status STRING, original_width INT, original_height INT").fields])
SAFE_IMAGE = T.StructType([*IMAGE.fields, T.StructField("punsafe", T.DoubleType())])
HASHED_IMAGE = T.StructType([*SAFE_IMAGE.fields, T.StructField("phash", T.StringType())])
SCORED_IMAGE = T.StructType([*HASHED_IMAGE.fields, T.StructField("similarity", T.DoubleType())])
