"""Rows to and from messages and search documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.functions.clock import iso_text, parse_mixed_timestamp
from tiffin.functions.ledger import quoted
from tiffin.schemas import DOCUMENT_FIELDS, RESPONSE_INDEX

KEEP_NULLS = {"ignoreNullFields": "false"}


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(quoted(c)) for c in df.columns])


def response_kv_encode(df: DataFrame) -> DataFrame:
    """Response messages keyed by request id; missing fields are left out of the JSON."""
    return df.select(F.col("UUID").alias("key"), F.to_json(_row(df)).alias("value"))


def request_kv_encode(df: DataFrame) -> DataFrame:
    """Request messages keyed by request id, blank if there is none."""
    return df.select(
        F.coalesce(F.col("UUID"), F.lit("")).alias("key"), F.to_json(_row(df)).alias("value")
    )


def iso_timestamps(df: DataFrame) -> DataFrame:
    """All time columns as ISO text, the rest untouched."""
    return df.select(
        *[
            iso_text(F.col(quoted(f.name))).alias(f.name)
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
            else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )


def search_bulk(df: DataFrame, index: str = RESPONSE_INDEX) -> DataFrame:
    """Bulk-index text: an action line and a document line per row, kept in one value.

    The document id is the request id, so that sending a row twice leaves one document.
    """
    document = iso_timestamps(df.drop("_id"))
    identity = F.coalesce(F.nullif(F.col("UUID"), F.lit("")), F.expr("uuid()"))
    action = F.to_json(
        F.struct(F.struct(F.lit(index).alias("_index"), identity.alias("_id")).alias("index"))
    )
    return document.select(
        F.concat_ws("\n", action, F.to_json(_row(document), KEEP_NULLS)).alias("value")
    )


def document_normalise(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Ingest rules: no `_id`, an ingest time unless there is one, lower-case payment."""
    now = F.current_timestamp() if now is None else now
    stamped = F.coalesce(F.col(quoted("@ingest_ts")), now) if "@ingest_ts" in df.columns else now
    changes = {"@ingest_ts": stamped}
    if "payment_method" in df.columns:
        changes["payment_method"] = F.lower("payment_method")
    return df.drop("_id").withColumns(changes)


def _to_field(df: DataFrame, name: str, kind: str) -> Column:
    column = F.col(quoted(name))
    is_text = isinstance(df.schema[name].dataType, T.StringType)
    if kind == "keyword":
        return column.cast("string")
    if kind == "double":
        return column.try_cast("double")
    if kind == "date":
        if is_text:
            return parse_mixed_timestamp(column)
        if isinstance(df.schema[name].dataType, T.IntegralType):
            return F.timestamp_millis(column)
        return column.cast("timestamp")
    target = {"long": "bigint", "integer": "int", "byte": "tinyint"}[kind]
    if is_text:
        # Text with a fraction is accepted and truncated, whole numbers keep all digits.
        return F.coalesce(column.try_cast(target), column.try_cast("double").try_cast(target))
    return column.try_cast(target)


def document_schema_cast(df: DataFrame) -> DataFrame:
    """The indexed view of a document: mapped fields only, each in its mapped type."""
    return df.select(
        *[
            _to_field(df, name, kind).alias(name)
            for name, kind in DOCUMENT_FIELDS.items()
            if name in df.columns
        ]
    )


def request_audit_log(df: DataFrame, now: Column | None = None) -> DataFrame:
    """One log row per request: the request itself, its state and the time."""
    return df.select(
        "UUID",
        _row(df).alias("request"),
        F.lit("submitted").alias("status"),
        (F.current_timestamp() if now is None else now).alias("ts"),
    )
