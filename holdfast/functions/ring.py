"""Rules of the 16-bit identifier ring. Identifiers are four upper-case hex digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = 65_536
HALF = SPACE // 2
DIGITS = 4


def to_hex(number: Column) -> Column:
    return F.lpad(F.hex(number), DIGITS, "0")


def to_int(identifier: Column) -> Column:
    return F.conv(identifier, 16, 10).cast("int")


def key_of(name: Column) -> Column:
    """Key of a name: hex digits 1, 2, 3 and 6 of its SHA-1."""
    digest = F.sha1(name.cast("binary"))
    return F.upper(F.concat(F.substring(digest, 1, 3), F.substring(digest, 6, 1)))


def left_distance(a: Column, b: Column) -> Column:
    """Counter-clockwise steps from ``a`` to ``b``; none if equal."""
    return F.pmod(a - b, F.lit(SPACE))


def right_distance(a: Column, b: Column) -> Column:
    """Clockwise steps from ``a`` to ``b``; the whole ring if equal."""
    return F.when(a == b, F.lit(SPACE)).otherwise(F.pmod(b - a, F.lit(SPACE)))


def distance(a: Column, b: Column) -> Column:
    """Steps along the shorter way."""
    apart = F.abs(a - b)
    return F.least(apart, SPACE - apart)


def direction(a: Column, b: Column) -> Column:
    """Way of the shorter distance; half a ring apart counts as crossing zero."""
    forward = (a < b) == (F.abs(a - b) < HALF)
    return F.when(forward, "CLOCKWISE").otherwise("COUNTER_CLOCKWISE")


def preference(key: Column, peer: Column) -> Column:
    """Smallest for the peer that owns ``key``: nearest first, then the clockwise one."""
    return F.struct(
        distance(key, peer).alias("dist"), F.pmod(peer - key, F.lit(SPACE)).alias("turn"), peer.alias("peer")
    )


def nearer(key: Column, a: Column, b: Column) -> Column:
    return F.least(preference(key, a), preference(key, b))["peer"]


def first_difference(a: Column, b: Column) -> Column:
    """Index from 0 of the first differing digit; 0 for equal identifiers."""
    found = F.when(F.substring(a, 1, 1) != F.substring(b, 1, 1), 0)
    for i in range(1, DIGITS):
        found = found.when(F.substring(a, i + 1, 1) != F.substring(b, i + 1, 1), i)
    return found.otherwise(0)
