"""Column expressions (all JVM-side, codegen-friendly; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash8(c) -> Column:
    """First 8 hex digits of md5: a short stable vertex id for a string."""
    return F.substring(F.md5(col_(c).cast("string")), 1, 8)


def hash_int(*parts) -> Column:
    """Unsigned 32-bit integer from the first 8 hex digits of md5('p1|p2|…').

    DuckDB computes the same value as ``('0x'||substr(md5(s),1,8))::BIGINT``,
    so every random choice built on it is reproducible in the oracle.
    """
    s = F.concat_ws("|", *[col_(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def hash_uniform(*parts) -> Column:
    """Uniform in (0, 1) from ``hash_int``: (h + 0.5) / 2^32."""
    return (hash_int(*parts).cast("double") + F.lit(0.5)) / F.lit(TWO_32)


def box_muller(u1: Column, u2: Column) -> Column:
    """Standard normal from two uniforms in (0, 1)."""
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)


def chi_square(both, with_b, with_a, total) -> Column:
    """Chi-square with Yates' correction of the 2x2 table

            | B    not B
      A     | a    b
      not A | c    d

    from its cell a (``both``), the margins a + b (``with_a``) and a + c
    (``with_b``) and the ``total``: n (|ad - bc| - n/2)^2 over the product of
    the four margins.  NULL when a margin is 0 (so ANSI mode never raises).
    """
    a, row, column, n = (col_(x).cast("double") for x in (both, with_a, with_b, total))
    b, c = row - a, column - a
    d = n - (a + b + c)
    margins = F.nullif(row * (c + d) * column * (b + d), F.lit(0.0))
    return n * F.pow(F.abs(a * d - b * c) - n / 2, F.lit(2.0)) / margins


def signed_square(x: Column) -> Column:
    return F.signum(x) * x * x


def signed_sqrt(x: Column) -> Column:
    return F.signum(x) * F.sqrt(F.abs(x))


def ring_pairs(ring: Column) -> Column:
    """Array of (x1, y1, x2, y2) structs, one per polygon edge (closing edge included)."""
    nxt = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.arrays_zip(ring.alias("a"), nxt.alias("b"))


def polygon_area(ring: Column) -> Column:
    """Absolute shoelace area of a simple polygon ring array<struct<x,y>>."""
    s = F.aggregate(
        ring_pairs(ring), F.lit(0.0),
        lambda acc, e: acc + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])
    return F.abs(s) / F.lit(2.0)


def crossed(x: Column, y: Column, edges: Column, start) -> Column:
    """``start`` turned by each edge (a, b) that a ray from (x, y) to the right
    crosses.  Points on the lower/left edges count as inside, points on
    upper/right edges as outside (half-open rule), so a shared edge belongs
    to exactly one of two adjacent polygons."""
    def step(acc, e):
        x1, y1, x2, y2 = e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]
        crosses = (y1 > y) != (y2 > y)
        xint = x1 + (y - y1) * (x2 - x1) / F.nullif(y2 - y1, F.lit(0.0))
        return F.when(crosses & (x < xint), ~acc).otherwise(acc)
    return F.aggregate(edges, start, step)


def point_in_polygon(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd ray casting on one ring."""
    return crossed(x, y, ring_pairs(ring), F.lit(False))


def dot(a: Column, b: Column) -> Column:
    """Dot product of two equal-length numeric arrays."""
    return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
