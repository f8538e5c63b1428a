"""JSON packing/parsing and flag parsing as Column expressions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.schemas import KAFKA_PAYLOAD

# The strings the reference accepts as "true" for its flags.
TRUE_FLAGS = ("true", "1", "yes", "y", "t")


def parse_flag(value) -> bool:
    """Plain-Python flag parsing for configuration values."""
    if isinstance(value, bool):
        return value
    return str(value).strip().lower() in TRUE_FLAGS


def flag_column(col: Column | str) -> Column:
    """Column form of :func:`parse_flag`; null stays null."""
    c = F.col(col) if isinstance(col, str) else col
    s = F.lower(F.trim(c.cast("string")))
    return F.when(c.isNull(), F.lit(None)).otherwise(s.isin(list(TRUE_FLAGS)))


def jsonable(df: DataFrame) -> list[Column]:
    """Columns ready for ``to_json``: ML vectors become plain arrays."""
    out = []
    for field in df.schema.fields:
        if isinstance(field.dataType, VectorUDT):
            out.append(vector_to_array(F.col(field.name)).alias(field.name))
        else:
            out.append(F.col(field.name))
    return out


def pack_json(df: DataFrame, alias: str = "value") -> DataFrame:
    """One ``value`` string column holding each row as a JSON object."""
    return df.select(F.to_json(F.struct(*jsonable(df))).alias(alias))


def decode_payload(value: Column | str, schema: T.StructType = KAFKA_PAYLOAD) -> Column:
    """Text of a message: the ``text`` field of a JSON object when present and
    non-null, else the raw string (malformed JSON included); null stays null."""
    c = F.col(value) if isinstance(value, str) else value
    raw = c.cast("string")
    parsed = F.from_json(raw, schema)
    return F.coalesce(parsed.getField("text"), raw)


def decode_kafka_frame(df: DataFrame, keep_label: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Kafka rows (``value`` binary, ``timestamp``) to ``text, kafka_ts``
    (and ``label`` from the JSON when asked, and the frame's own columns named
    in ``keep``); each message is parsed once."""
    raw = F.col("value").cast("string")
    schema = KAFKA_PAYLOAD
    if keep_label:
        schema = T.StructType(KAFKA_PAYLOAD.fields + [T.StructField("label", T.IntegerType(), True)])
    parsed = df.select(*[F.col(c) for c in keep], raw.alias("raw"), F.from_json(raw, schema).alias("m"),
                       F.col("timestamp").alias("kafka_ts"))
    cols = [*keep, F.coalesce(F.col("m.text"), F.col("raw")).alias("text"), "kafka_ts"]
    if keep_label:
        cols.append(F.col("m.label").alias("label"))
    return parsed.select(*cols)
