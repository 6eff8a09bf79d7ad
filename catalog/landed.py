"""JSON sources, with the JSON written by Spark from the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.registry import query, table
from martloom.sinks import error_rows
from martloom.sources import (
    decode_json,
    explode_pages,
    keep_raw_payload,
    split_malformed,
    stringify_nested,
)

AS_OF = dt.datetime(2024, 3, 15, 12, 0)
TURN_DDL = "conv_id bigint, turn bigint, role string, speaker struct<role: string, long: boolean>, text string"


def _turns(spark, d):
    """Conversation turns as JSON records."""
    turns = table(spark, d, "conversations").withColumn(
        "speaker", F.struct("role", (F.length("text") > 200).alias("long"))
    )
    return turns.select("conv_id", "turn", "role", F.to_json(F.struct("*")).alias("record"))


@query(
    "json_decode_events",
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, NULL::VARCHAR AS missing
    FROM events
    """,
)
def json_decode_events(spark, d):
    events = table(spark, d, "events").select("event_id", "props")
    return decode_json(events, "props", "k bigint, missing string", keep=False)


@query(
    "json_decode_nested",
    """
    SELECT conv_id, turn, role, role AS speaker_role, length(text) > 200 AS speaker_long,
           CAST(NULL AS BIGINT) AS role_as_number, md5(text) AS text_hash
    FROM conversations
    """,
)
def json_decode_nested(spark, d):
    records = _turns(spark, d).select("record")
    ddl = "conv_id bigint, turn bigint, role string, speaker struct<role: string, long: boolean>, text string"
    decoded = decode_json(records, "record", ddl, keep=True)
    number = decode_json(decoded.drop("role"), "record", "role bigint", keep=False)
    return number.select(
        "conv_id",
        "turn",
        F.col("speaker.role").alias("role"),
        F.col("speaker.role").alias("speaker_role"),
        F.col("speaker.long").alias("speaker_long"),
        F.col("role").alias("role_as_number"),
        F.md5("text").alias("text_hash"),
    )


@query(
    "json_stringify_nested",
    """
    SELECT conv_id, turn, role,
           '{"role":"' || role || '","long":' || CASE WHEN length(text) > 200 THEN 'true' ELSE 'false' END
             || '}' AS speaker, md5(text) AS text_hash
    FROM conversations
    """,
)
def json_stringify_nested(spark, d):
    records = _turns(spark, d).select("record")
    typed = decode_json(records, "record", TURN_DDL, keep=False)
    return stringify_nested(typed.withColumn("text", F.md5("text")).withColumnRenamed("text", "text_hash"))


@query(
    "json_object_as_text",
    """
    SELECT conv_id, turn, role AS role_inside, md5(text) AS text_hash FROM conversations
    """,
)
def json_object_as_text(spark, d):
    records = _turns(spark, d).select("record")
    flat = decode_json(records, "record", "conv_id bigint, turn bigint, speaker string, text string", keep=False)
    inside = decode_json(flat, "speaker", "role string", keep=False)
    return inside.select("conv_id", "turn", F.col("role").alias("role_inside"), F.md5("text").alias("text_hash"))


@query(
    "json_explode_pages",
    """
    SELECT conv_id, turn, role, md5(text) AS text_hash FROM conversations
    UNION ALL SELECT conv_id, -turn, 'echo', md5(role || ': ' || text) FROM conversations
    """,
)
def json_explode_pages(spark, d):
    """Every turn becomes a page of two records, which is unpacked again."""
    turn = table(spark, d, "conversations")
    record = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    echo = F.to_json(
        F.struct(
            "conv_id",
            (-F.col("turn")).alias("turn"),
            F.lit("echo").alias("role"),
            F.concat("role", F.lit(": "), "text").alias("text"),
        )
    )
    page = F.concat(F.lit('{"dados":['), record, F.lit(","), echo, F.lit("]}"))
    turns = decode_json(explode_pages(turn.select(page.alias("value"))), "raw_payload", TURN_DDL, False)
    return turns.select("conv_id", "turn", "role", F.md5("text").alias("text_hash"))


@query(
    "raw_payload",
    "SELECT * FROM orders",
)
def raw_payload(spark, d):
    kept = keep_raw_payload(table(spark, d, "orders")).select("raw_payload")
    ddl = ", ".join(f"{name} {kind}" for name, kind in table(spark, d, "orders").dtypes)
    return decode_json(kept, "raw_payload", ddl, keep=False)


@query(
    "quarantine",
    """
    SELECT CAST(event_id AS VARCHAR) AS key, '/events' AS endpoint,
           CASE WHEN event_type = 'error' THEN 'malformed_json' ELSE 'missing_k' END AS tipo_erro,
           CASE WHEN event_type = 'error' THEN rtrim(props, '}') ELSE replace(props, '"k"', '"j"') END AS erro,
           DATE '2024-03-15' AS executed_on, 'events' AS pipeline, 'batch-1' AS batch_id,
           '1.0' AS pipeline_version
    FROM events WHERE event_type IN ('error', 'signup')
    """,
)
def quarantine_events(spark, d):
    rejected = split_malformed(_spoiled(spark, d), "props", "k bigint", ["k"])[1]
    errors = error_rows(rejected, "event_id", "endpoint", "props", "events", "batch-1", "1.0", AS_OF)
    return errors.withColumn("executed_on", F.to_date("data_execucao")).drop("data_execucao")


@query(
    "quarantine_passed",
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
    WHERE event_type NOT IN ('error', 'signup')
    """,
)
def quarantine_passed(spark, d):
    good = split_malformed(_spoiled(spark, d), "props", "k bigint", ["k"])[0]
    return decode_json(good.select("event_id", "props"), "props", "k bigint", keep=False)


def _spoiled(spark, d):
    """Events whose payload is cut off (errors) or lacks its key (sign-ups)."""
    props = (
        F.when(F.col("event_type") == "error", F.rtrim("props", F.lit("}")))
        .when(F.col("event_type") == "signup", F.replace("props", F.lit('"k"'), F.lit('"j"')))
        .otherwise(F.col("props"))
    )
    return table(spark, d, "events").select(
        "event_id", F.lit("/events").alias("endpoint"), props.alias("props")
    )
