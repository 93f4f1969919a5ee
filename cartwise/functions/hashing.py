"""Repeatable random numbers: functions of the row, never of its partition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# L'Ecuyer's combined multiplicative generator (1988).
MODULUS = (2147483563, 2147483399)
MULTIPLIER = (40014, 40692)
# A two-multiplication integer hash with shifts 15, 12, 15.
MIX_MULTIPLIER = (0x2C1B3C6D, 0x297A2D39)
MASK_32 = 0xFFFFFFFF


def _digest(keys: tuple[Column | str, ...], seed: str) -> Column:
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(seed)))


def _number(digest: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("long")


def uniform(*keys: Column | str, seed: str = "42") -> Column:
    """Uniform double in [0, 1) from the first 52 bits of an MD5 over the keys."""
    return _number(_digest(keys, seed), 1, 13).cast("double") / F.lit(float(2**52))


def stream(*keys: Column | str, seed: str = "42") -> Column:
    """Start of a sequence of numbers for a row: one MD5, whatever its length."""
    digest = _digest(keys, seed)
    return F.struct(
        (_number(digest, 1, 8) % (MODULUS[0] - 1) + 1).alias("a"),
        (_number(digest, 9, 8) % (MODULUS[1] - 1) + 1).alias("b"),
    )


def powers(limit: int) -> tuple[list[int], list[int]]:
    """The first ``limit`` steps of both generators."""
    return tuple(
        [pow(base, i + 1, modulus) for i in range(limit)]
        for base, modulus in zip(MULTIPLIER, MODULUS)
    )


def step(start: Column, index: Column, limit: int) -> Column:
    """Uniform double in (0, 1): number ``index`` (from 0, below ``limit``) of a stream."""
    first, second = (
        F.get(F.expr(f"array({', '.join(f'{x}L' for x in values)})"), index)
        for values in powers(limit)
    )
    left = start["a"] * first % MODULUS[0]
    right = start["b"] * second % MODULUS[1]
    return (F.pmod(left - right, F.lit(MODULUS[0] - 1)) + F.lit(0.5)) / F.lit(
        float(MODULUS[0] - 1)
    )


def mix32(name: str) -> str:
    """SQL for a 32-bit hash of a non-negative BIGINT column.

    Plain integer arithmetic, for counters hashed by the hundred million. Only the low 32 bits of
    a product count, so masking its factor first keeps counters beyond 2^32 from overflowing; each
    further 2^32 of them get the same numbers in another order.
    """
    first, second = MIX_MULTIPLIER
    x = f"((({name} ^ shiftright({name}, 15)) & {MASK_32}L) * {first}L & {MASK_32}L)"
    x = f"(({x} ^ shiftright({x}, 12)) * {second}L & {MASK_32}L)"
    return f"({x} ^ shiftright({x}, 15))"
