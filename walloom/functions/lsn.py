"""Log sequence numbers: one non-negative long, `hi/lo` in hexadecimal, or a segment and an offset."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lsn_to_text(lsn: Column) -> Column:
    low = lsn.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.concat(F.hex(F.shiftrightunsigned(lsn, 32)), F.lit("/"), F.hex(low))


def text_to_lsn(text: Column) -> Column:
    """Null for text of another form."""
    part = lambda k: F.conv(F.split(text, "/")[k], 16, 10).cast("bigint")
    return F.when(text.rlike("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"), F.shiftleft(part(0), 32) + part(1))


def lsn_segment(lsn: Column) -> Column:
    return F.shiftrightunsigned(lsn, 32)


def lsn_offset(lsn: Column) -> Column:
    return lsn.bitwiseAND(F.lit(0xFFFFFFFF))


def lsn_of(position: int | str) -> int:
    """A start position given as a number or as text."""
    if isinstance(position, int):
        return position
    high, low = position.split("/")
    return (int(high, 16) << 32) + int(low, 16)
