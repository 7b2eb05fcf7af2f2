"""Deterministic hash-derived randomness and hash-based membership.

All randomness in the library is a pure function of row ids and a seed, so
results repeat across runs, partitionings and executor retries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO32 = float(2 ** 32)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def md5_u32(text: Column) -> Column:
    """First 32 bits of md5(text) as a non-negative bigint in [0, 2^32)."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def key_text(*parts) -> Column:
    """'a|b|c' text of the parts (integers / strings only, so text is stable)."""
    return F.concat_ws("|", *[_c(p).cast("string") for p in parts])


def md5_uniform(*parts) -> Column:
    """Uniform double in [0, 1) from md5 of the parts joined by '|'."""
    return md5_u32(key_text(*parts)) / F.lit(TWO32)


def xx_u32(*parts, seed: int = 42) -> Column:
    """Fast 32-bit order key from xxhash64 (not SQL-portable; for R operators)."""
    return F.pmod(F.xxhash64(F.lit(seed), *[_c(p) for p in parts]), F.lit(TWO32).cast("bigint"))


def le_hex64(x) -> Column:
    """Little-endian int64 bytes of x as hex text (what numpy int64 .tobytes() gives)."""
    x = _c(x).cast("bigint")
    return F.concat(*[
        F.lpad(F.lower(F.hex(F.shiftright(x, 8 * i).bitwiseAND(F.lit(255)))), 2, "0")
        for i in range(8)
    ])


def crc32_le(x) -> Column:
    """zlib.crc32 of the little-endian int64 bytes of x."""
    return F.crc32(F.unhex(le_hex64(x)))


def md5_last_byte_le(x) -> Column:
    """Last byte of md5 over the little-endian int64 bytes of x (0..255)."""
    return F.conv(F.substring(F.md5(F.unhex(le_hex64(x))), 31, 2), 16, 10).cast("int")


def rnd(c, k: int) -> Column:
    """round(c, k) with -0.0 folded into 0.0 (same rule in the SQL twins)."""
    return F.round(_c(c), k) + F.lit(0.0)
