"""Joins: dimensions, null-safe keys, day-over-day, IP range lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators.intervals import build_index, lookup


def with_dimension(df: DataFrame, dim: DataFrame, on: str | list[str] | Column, how: str = "left") -> DataFrame:
    """Fact-to-dimension join; fans out on duplicate dimension keys.

    The planner picks the join by bytes (``autoBroadcastJoinThreshold``, and AQE
    by the sizes it meets); a shuffled join's hot keys are split by AQE.
    """
    return df.join(dim, on, how)


def null_safe_on(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on ``keys`` with null equal to null, each key once in the result.

    ``using`` never matches a null key, so an outer join would give it a row
    from each side; ``<=>`` is still an equi-join (hash or sort-merge).
    """
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    out = left.join(renamed, cond, how)
    rest = [c for c in left.columns if c not in keys] + [c for c in right.columns if c not in keys]
    merged = [F.coalesce(k, f"_r_{k}").alias(k) if how == "full_outer" else F.col(k) for k in keys]
    return out.select(*merged, *rest)


def prev_day_join(cur: DataFrame, prev: DataFrame, day: str, how: str = "left") -> DataFrame:
    """Attach the previous day's row to each day.

    ``datediff(cur.day, prev.day) = 1`` has no equi key and plans as a nested
    loop; shifting the previous side's day by one turns it into an equi-join
    on ``day`` (hash/sort-merge), same result.
    """
    shifted = prev.withColumn(day, F.date_add(F.col(day), 1))
    return cur.join(shifted, day, how)


def ipv4_to_long(ip) -> Column:
    """Dotted IPv4 text -> 32-bit number; malformed text -> null."""
    ip = F.col(ip) if isinstance(ip, str) else ip
    parts = F.split(ip, r"\.")
    octs = [F.get(parts, i).try_cast("long") for i in range(4)]
    valid = (F.size(parts) == 4) & F.forall(
        parts, lambda p: p.rlike(r"^\d{1,3}$") & (p.try_cast("int") <= 255)
    )
    number = octs[0] * 16777216 + octs[1] * 65536 + octs[2] * 256 + octs[3]
    return F.when(valid, number)


def ip_binary(ip) -> Column:
    """IPv6 or IPv4 text -> 16 bytes in network order, IPv4 as ``::ffff:a.b.c.d``; malformed
    text -> null.  Bytes compare as addresses do."""
    ip = F.lower(F.col(ip) if isinstance(ip, str) else ip)
    v4 = ipv4_to_long(ip)
    tail = ipv4_to_long(F.regexp_extract(ip, r":(\d+\.\d+\.\d+\.\d+)$", 1))
    words = F.concat(F.hex(F.shiftright(tail, 16)), F.lit(":"), F.hex(tail.bitwiseAND(F.lit(0xFFFF))))
    text = F.when(tail.isNotNull(), F.concat(F.regexp_extract(ip, r"^(.*:)[\d.]+$", 1), F.lower(words))).otherwise(ip)
    halves = F.split(text, "::")
    none = F.array().cast("array<string>")

    def groups(half: Column) -> Column:
        return F.when(half == "", none).otherwise(F.split(half, ":"))

    left, right = groups(F.get(halves, 0)), F.coalesce(groups(F.get(halves, 1)), none)
    count = F.size(left) + F.size(right)
    zeros = F.array_repeat(F.lit("0"), F.greatest(8 - count, F.lit(0)))
    every = F.concat(left, zeros, right)
    whole = F.when(F.size(halves) == 2, count <= 7).otherwise((F.size(halves) == 1) & (count == 8))
    valid = whole & F.forall(F.concat(left, right), lambda g: g.rlike("^[0-9a-f]{1,4}$"))
    v6 = F.unhex(F.array_join(F.transform(every, lambda g: F.lpad(g, 4, "0")), ""))
    return F.when(v4.isNotNull(), F.unhex(F.concat(F.lit("00000000000000000000ffff"), F.lpad(F.hex(v4), 8, "0")))).when(valid, v6)


def ip_width(start: str, end: str) -> Column:
    """How far apart two addresses are, as a value that orders ranges by width; 64-bit halves
    of 16-byte addresses are subtracted with a borrow."""

    def half(c: str, at: int) -> Column:
        return F.conv(F.hex(F.substring(c, at, 8)), 16, 10).cast("decimal(20,0)")

    low = half(end, 9) - half(start, 9)
    borrow = F.when(low < 0, 1).otherwise(0)
    return F.struct((half(end, 1) - half(start, 1) - borrow).alias("high"), (low + borrow * F.lit(str(2**64)).cast("decimal(20,0)")).alias("low"))


def ip_region_join(df: DataFrame, ip: str, ranges: DataFrame) -> DataFrame:
    """Left join of addresses to ``ranges`` (start_ip, end_ip, region) -> ``region``.

    Addresses are numbers (``ipv4_to_long``) or 16 bytes (``ip_binary``), as the ranges'
    bounds are.  Ranges may overlap: the narrowest that holds the address wins (then the
    lowest start, then the region text).  They are cut into disjoint pieces first, and
    an address finds its piece by binary search (``intervals``), so no row is copied and a
    range over everything costs no more than another.
    """
    binary = isinstance(ranges.schema["start_ip"].dataType, T.BinaryType)
    width = ip_width("start_ip", "end_ip") if binary else F.col("end_ip") - F.col("start_ip")
    return lookup(df, ip, build_index(ranges, "start_ip", "end_ip", "region", width), "region")
