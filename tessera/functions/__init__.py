"""Column expressions (JVM-side, codegen-friendly). Each returns a ``Column``."""

from tessera.functions.codes import shift_codes
from tessera.functions.geo import centre_distance, in_box
from tessera.functions.hashing import hash_bucket, hash_key
from tessera.functions.text import (
    decode_tags,
    has_tags,
    param_label,
    photo_label,
    split_genres,
    url_form_decode,
)

__all__ = [
    "centre_distance",
    "decode_tags",
    "has_tags",
    "hash_bucket",
    "hash_key",
    "in_box",
    "param_label",
    "photo_label",
    "shift_codes",
    "split_genres",
    "url_form_decode",
]
