"""Stream kline messages: one JSON object ``{"k": {...}}`` per candle update."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kandela.functions.scalars import canonical_symbol, from_epoch_ms, to_number
from kandela.schemas import PRICES

# Message keys of the five numbers.
_NUMBER_KEYS = {"open": "o", "high": "h", "low": "l", "close": "c", "volume": "v"}


def decode_messages(raw: DataFrame, column: str = "value", interval: str = "1m") -> DataFrame:
    """Raw message text to typed columns plus the raw text; unreadable fields are NULL.

    ``k`` is read as a map because its keys t and T differ only in case. The interval comes from
    the message key ``i``, or from the subscribed ``interval`` when the message has none.
    """
    k = F.col("k")
    return (
        raw.select(F.col(column).alias("raw"), F.from_json(column, "k map<string,string>")["k"].alias("k"))
        .select(
            canonical_symbol(k["s"]).alias("symbol"),
            F.coalesce(k["i"], F.lit(interval)).alias("interval"),
            from_epoch_ms(k["t"].try_cast("long")).alias("open_time"),
            *[to_number(k[key]).alias(name) for name, key in _NUMBER_KEYS.items()],
            from_epoch_ms(k["T"].try_cast("long")).alias("close_time"),
            k["x"].try_cast("boolean").alias("closed"),
            "raw",
        )
    )


def _complete():
    ok = F.lit(True)
    for name in ["symbol", "open_time", *PRICES, "close_time", "closed"]:
        ok = ok & F.col(name).isNotNull()
    return ok


def accepted(decoded: DataFrame) -> DataFrame:
    """Messages with every field readable."""
    return decoded.where(_complete()).drop("raw")


def quarantined(decoded: DataFrame) -> DataFrame:
    """Raw text of messages that miss a key or hold an unreadable value."""
    return decoded.where(~_complete()).select("raw")


def encode_messages(candles: DataFrame) -> DataFrame:
    """Candles (with ``closed``) as message text in column ``value``; symbols go out in lower case."""
    return candles.select(F.to_json(F.struct(F.create_map(
        F.lit("s"), F.lower("symbol"),
        F.lit("i"), F.col("interval"),
        F.lit("t"), F.unix_millis("open_time").cast("string"),
        F.lit("T"), F.unix_millis("close_time").cast("string"),
        *[x for name, key in _NUMBER_KEYS.items() for x in (F.lit(key), F.col(name).cast("string"))],
        F.lit("x"), F.col("closed").cast("string"),
    ).alias("k"))).alias("value"))
