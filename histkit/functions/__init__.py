"""Column expressions: casts, JSON documents, hashes."""

from .casts import cast_to, date_as_timestamp, effective_time, type_name
from .documents import as_document, canonical_json, field_value, json_get, member_path, read_members
from .hashing import row_hash, surrogate_key

__all__ = [
    "as_document",
    "canonical_json",
    "cast_to",
    "date_as_timestamp",
    "effective_time",
    "field_value",
    "json_get",
    "member_path",
    "read_members",
    "row_hash",
    "surrogate_key",
    "type_name",
]
