"""Scans, sinks, model persistence and the test-data adapters."""

from tessera.sources.readers import (
    parse_photo_lines,
    read_boxes,
    read_credit,
    read_licenses,
    read_lines,
    read_movies,
    read_photos,
    read_ratings,
    read_table,
    read_user_input,
)
from tessera.sources.sinks import write_csv, write_report, write_tsv, write_user_ratings

__all__ = [
    "parse_photo_lines",
    "read_boxes",
    "read_credit",
    "read_licenses",
    "read_lines",
    "read_movies",
    "read_photos",
    "read_ratings",
    "read_table",
    "read_user_input",
    "write_csv",
    "write_report",
    "write_tsv",
    "write_user_ratings",
]
