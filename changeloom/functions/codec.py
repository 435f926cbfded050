"""Binary codecs written as built-in expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_DECIMAL_BYTES = 16


def decimal_from_bytes(raw: Column, scale: int = 4) -> Column:
    """Signed big-endian bytes as ``DECIMAL(38, scale)``.

    The bytes are sign-extended to 16, read as a signed high and an unsigned low
    half, and put together in decimal arithmetic.  Null for more than 16 bytes
    or a number of more than 38 digits; empty bytes are zero.
    """
    digits = F.hex(raw)
    fill = F.when(F.substring(digits, 1, 1) >= F.lit("8"), F.lit("F")).otherwise(F.lit("0"))
    wide = F.lpad(digits, 2 * MAX_DECIMAL_BYTES, fill)
    high = F.conv(F.substring(wide, 1, 16), 16, -10).cast("decimal(19,0)")
    low = F.conv(F.substring(wide, 17, 16), 16, 10).cast("decimal(20,0)")
    shifted = F.try_multiply(high, F.lit(Decimal(2**64)))
    number = F.try_add(shifted, low)
    if scale:
        number = F.try_multiply(number, F.lit(Decimal(1).scaleb(-scale)))
    number = number.try_cast(f"decimal(38,{scale})")
    return F.when(F.octet_length(raw) <= MAX_DECIMAL_BYTES, number)


def decimal_from_base64(text: Column, scale: int = 4) -> Column:
    """Base64 text of such bytes; null when the text is not strict base64."""
    return decimal_from_bytes(F.try_to_binary(text, F.lit("base64")), scale)


def decode_decimal(value: Column, kind: T.DataType, scale: int = 4) -> Column:
    """Decode a decimal by the type it arrived in.

    Numbers stay as they are, bytes are decoded, text is decoded and falls back
    to the text itself.  Text columns therefore stay text.
    """
    if isinstance(kind, T.BinaryType):
        return decimal_from_bytes(value, scale)
    if isinstance(kind, T.StringType):
        return F.coalesce(decimal_from_base64(value, scale).cast("string"), value)
    return value


def wire_is_framed(value: Column) -> Column:
    """True for a zero byte followed by at least a four-byte schema id."""
    return (F.octet_length(value) >= 5) & (F.hex(F.substring(value, 1, 1)) == "00")


def wire_schema_id(value: Column) -> Column:
    """Big-endian schema id in bytes 2 to 5."""
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long")


def wire_body(value: Column) -> Column:
    """Everything after the five header bytes."""
    return F.substring(value, F.lit(6), F.octet_length(value))
