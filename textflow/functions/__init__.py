from textflow.functions.keyed import keyed_bucket, keyed_bucket_sql
from textflow.functions.payload import (
    TRUE_FLAGS,
    decode_kafka_frame,
    decode_payload,
    flag_column,
    pack_json,
    parse_flag,
)
from textflow.functions.text import default_stop_words, remove_stop_words, tokenize

__all__ = [
    "TRUE_FLAGS",
    "decode_kafka_frame",
    "decode_payload",
    "default_stop_words",
    "flag_column",
    "keyed_bucket",
    "keyed_bucket_sql",
    "pack_json",
    "parse_flag",
    "remove_stop_words",
    "tokenize",
]
