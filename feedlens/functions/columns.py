"""Column expressions shared by the operators.

All of them are built-in Spark functions, so they run inside whole-stage
codegen. Randomness is never ``rand()``: draws come from an md5 hash of
(salt, key...), which makes every sample repeatable and checkable against an
independent SQL engine.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens.functions.resampling import poisson_bounds

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den as double; NULL when den is 0 (an inf or nan in the source
    database, which the statistics then have to skip anyway)."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def day_of(ts: ColumnOrName) -> Column:
    return F.to_date(_col(ts))


def monday(d: ColumnOrName) -> Column:
    """Monday of the ISO week of a date or timestamp, as a date."""
    return F.date_trunc("week", _col(d)).cast("date")


def add_weeks(d: ColumnOrName, n: int) -> Column:
    return F.date_add(_col(d), 7 * n)


def fifteen_minute_start(ts: ColumnOrName) -> Column:
    """Start of the 15-minute bucket holding ts (buckets align to :00/:15/:30/:45)."""
    return F.window(_col(ts), "15 minutes").start


def hh_mm(ts: ColumnOrName) -> Column:
    return F.date_format(_col(ts), "HH:mm")


def hash_halves(salt: str, *keys: ColumnOrName) -> tuple[Column, Column]:
    """64-bit hash of salt and keys as two unsigned 32-bit halves (the first 16
    hex digits of md5)."""
    text = F.md5(F.concat_ws(":", F.lit(salt), *[_col(k).cast("string") for k in keys]))
    return tuple(F.conv(F.substring(text, at, 8), 16, 10).cast("bigint") for at in (1, 9))


# Fixed values of the 32-bit draw: the golden-ratio increment of a Weyl
# sequence and the multiplier of a xor-shift-multiply finalizer. The
# multiplier is below 2^27, so every product stays below 2^63 and no 64-bit
# overflow can occur (in Spark's ANSI mode or in any SQL engine).
M32 = 0xFFFFFFFF
GOLDEN32 = 0x9E3779B1
MIX32 = 0x45D9F3B


def mix32(x: ColumnOrName) -> Column:
    """Bijective avalanche mix of a value in [0, 2^32)."""
    def step(v: Column) -> Column:
        return (v.bitwiseXOR(F.shiftright(v, 16)) * MIX32).bitwiseAND(M32)
    y = step(step(_col(x)))
    return y.bitwiseXOR(F.shiftright(y, 16))


def _keyed_mix(hi: Column, z: Column) -> Column:
    return mix32((mix32(z.bitwiseAND(M32)) + hi).bitwiseAND(M32))


def draw32(hi: ColumnOrName, lo: ColumnOrName, rep: ColumnOrName) -> Column:
    """Uniform 32-bit draw number ``rep`` from a per-unit 64-bit key (two
    halves): the rep-th output of a SplitMix-style generator seeded with the
    low half, mixed once more with the high half. Two units share their draws
    only if all 64 bits agree. The key is hashed once per unit, so exploding
    units x repetitions costs a few integer operations per row."""
    return _keyed_mix(_col(hi), _col(lo) + _col(rep).cast("bigint") * GOLDEN32)


def salt_offset(salt: str) -> int:
    """A salt as a 32-bit offset of the mixed key."""
    return (zlib.crc32(salt.encode()) * GOLDEN32) & M32


def uniform_bucket(salt: str, key: ColumnOrName, buckets: int) -> Column:
    """Bucket in [0, buckets) of an integer key: a mix of its two 32-bit halves
    with the salt, a few integer operations and no text."""
    k = _col(key).cast("bigint")
    hi, lo = F.shiftright(k, 32).bitwiseAND(M32), k.bitwiseAND(M32)
    return (_keyed_mix(hi, lo + salt_offset(salt)) % buckets).cast("int")


def poisson1_weight(h: ColumnOrName) -> Column:
    """Poisson(1) draw from a uniform 32-bit hash through the inverse CDF."""
    h, bounds = _col(h), poisson_bounds(1)
    expr = F.when(h < bounds[0], F.lit(0))
    for k, bound in enumerate(bounds[1:], start=1):
        expr = expr.when(h < bound, F.lit(k))
    return expr.otherwise(F.lit(len(bounds)))


# Fixed values of XXH64 (its five primes).
XXH_PRIMES = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
#: The seed that Spark's ``xxhash64`` starts from.
SPARK_SEED = 42


def _seed_zero() -> int:
    """The long that ``xxhash64`` turns into 0. Each column's hash is the seed of the
    next one's, so a column of this value in front starts the following one from 0.

    Every step of the hash of 8 bytes can be undone: shifts, products with odd
    numbers and rotations modulo 2^64. A hash of 0 is 0 before the final shifts and
    products; the steps before those are taken backwards here.
    """
    p1, p2, _, p4, p5 = XXH_PRIMES
    m64 = 2**64 - 1

    def rotate(x: int, by: int) -> int:
        return ((x << by) | (x >> (64 - by))) & m64

    mixed = rotate((0 - p4) * pow(p1, -1, 2**64) & m64, 64 - 27) ^ ((SPARK_SEED + p5 + 8) & m64)
    value = rotate(mixed * pow(p1, -1, 2**64) & m64, 64 - 31) * pow(p2, -1, 2**64) & m64
    return value - 2**64 if value >> 63 else value


def xxh64(key: ColumnOrName, width: int = 8) -> Column:
    """XXH64 with seed 0 of an integer's ``width`` little-endian bytes (8, or 4 for
    keys that are stored in 32 bits), as a signed long: one built-in expression."""
    if width not in (4, 8):
        raise ValueError(f"integer keys have 4 or 8 bytes, not {width}")
    return F.xxhash64(F.lit(_seed_zero()).cast("bigint"), _col(key).cast("bigint" if width == 8 else "int"))


def unsigned_mod(x: ColumnOrName, modulus: int) -> Column:
    """A long read as an unsigned number, modulo ``modulus``."""
    x = _col(x)
    return (F.shiftrightunsigned(x, 1) % modulus * 2 + x.bitwiseAND(F.lit(1).cast("bigint"))) % modulus


def xxh64_bucket(key: ColumnOrName, buckets: int, width: int = 8) -> Column:
    """The bucket that a column store's ``xxHash64(key) % buckets`` gives the same key."""
    return unsigned_mod(xxh64(key, width), buckets).cast("int")


def fixed2(x: ColumnOrName) -> Column:
    """Text of x with two decimals, rounded half away from zero on the decimal
    value (a plain ``format_string('%.2f')`` rounds differently from C)."""
    return F.round(_col(x).cast("decimal(38,6)"), 2).cast("string")


def percent2(x: ColumnOrName) -> Column:
    """Text of a share as a percentage with two decimals, e.g. 0.0125 -> 1.25%."""
    return F.concat(fixed2(_col(x) * 100.0), F.lit("%"))
