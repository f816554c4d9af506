"""Scalar column functions. All are built-in expressions; nothing leaves the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(column: str | Column, separator: str) -> Column:
    """Split by a literal separator, dropping empty parts at the end (but "" has one part, "")."""
    text, pattern = _col(column), re.escape(separator)
    if len(separator) == 1:
        kept = F.rtrim(text, F.lit(separator))
    else:
        kept = F.regexp_replace(text, rf"(?:{pattern})+\z", "")
    nothing = F.array().cast("array<string>")
    return F.when((kept != "") | (text == ""), F.split(kept, pattern)).when(text.isNotNull(), nothing)


def _char_codes(text: Column) -> Column:
    """UTF-16 code units of a string."""
    chars = F.split(text, "")
    above = lambda ch: F.ascii(ch) - 0x10000
    pair = lambda ch: F.array(0xD800 + F.shiftright(above(ch), 10), 0xDC00 + above(ch).bitwiseAND(0x3FF))
    in_pairs = F.flatten(F.transform(chars, lambda ch: F.when(above(ch) >= 0, pair(ch)).otherwise(F.array(F.ascii(ch)))))
    return F.when(text.rlike(r"[\x{10000}-\x{10FFFF}]"), in_pairs).otherwise(F.transform(chars, F.ascii))


def _fold(text: Column, factor: int, modulus: int) -> Column:
    codes = F.when(text == "", F.array().cast("array<int>")).otherwise(_char_codes(text))
    return F.aggregate(codes, F.lit(0).cast("bigint"), lambda acc, code: F.pmod(acc * factor + code, F.lit(modulus)))


def _to_int32(value: Column) -> Column:
    """Reads a number modulo 2^32 as a signed 32-bit integer."""
    return (F.pmod(value + (1 << 31), F.lit(1 << 32)) - (1 << 31)).cast("int")


def string_hash(column: str | Column, factor: int = 13) -> Column:
    """The JVM's 32-bit string hash times a factor, wrapping around."""
    return _to_int32(_fold(_col(column), 31, 1 << 32) * factor)


def polynomial_hash(column: str | Column, seed: int, modulus: int) -> Column:
    """Characters folded with a seed, modulo a power of two."""
    return _fold(_col(column), seed, modulus)


def prefixed(column: str | Column, prefix: str = "Name:") -> Column:
    return F.concat(F.lit(prefix), _col(column))


def fully_matches(column: str | Column, pattern: str) -> Column:
    return _col(column).rlike(rf"\A(?:{pattern})\z")


def integer_percent(part: Column, whole: Column) -> Column:
    """Whole percent, rounded down."""
    return F.floor(part * 100 / whole).cast("bigint")


def seconds_to_millis(column: str | Column) -> Column:
    return F.unix_millis(F.timestamp_seconds(_col(column)))


def utc_text(column: str | Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(_col(column), pattern)


def register(spark: SparkSession) -> None:
    """SQL names: prefix_name(text) and string_hash(text, factor), as SQL-defined functions."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION prefix_name(s STRING) RETURNS STRING RETURN concat('Name:', s)")
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION string_hash(s STRING, factor INT) RETURNS INT RETURN
        cast((pmod(
            aggregate(flatten(transform(if(s = '', array(), split(s, '')), c -> if(ascii(c) < 65536, array(ascii(c)),
                          array(55296 + shiftright(ascii(c) - 65536, 10), 56320 + ((ascii(c) - 65536) & 1023))))), 0L,
                      (a, c) -> pmod(a * 31 + c, 4294967296L)) * factor + 2147483648L,
            4294967296L) - 2147483648L) AS INT)
        """
    )
