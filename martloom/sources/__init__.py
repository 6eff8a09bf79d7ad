"""Landed JSON pages, JSON decoding, table scans."""

from martloom.sources.landed import (
    decode_json,
    explode_pages,
    judge,
    keep_raw_payload,
    read_landed_pages,
    read_table,
    split_malformed,
    stringify_nested,
)

__all__ = [
    "decode_json",
    "explode_pages",
    "judge",
    "keep_raw_payload",
    "read_landed_pages",
    "read_table",
    "split_malformed",
    "stringify_nested",
]
