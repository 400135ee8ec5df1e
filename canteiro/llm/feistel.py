"""Keyed permutations of whole numbers by Feistel networks, as column code."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from canteiro.llm.common import whole_part

ROUNDS = 6
# steps of a cycle walk that are listed in the plan; a rare longer walk lists its steps when a row needs them
SHORT_WALK = 12

# (round, side 0 or 1, half) -> whole number
RoundHash = Callable[[Column, Column, Column], Column]


def seeded(seed: int) -> RoundHash:
    """Round function for shuffles: fast and keyed, not secret."""
    return lambda number, side, half: F.xxhash64(F.lit(seed).cast("long"), number, side, half)


def secret(key: str) -> RoundHash:
    """Round function for pseudonyms: 60 bits of a SHA-256 digest over key, round and half."""

    def of(number: Column, side: Column, half: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), number.cast("string"), side.cast("string"), half.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

    return of


def permuted_pair(left: Column, right: Column, a: int, b: int, of: RoundHash, rounds: int = ROUNDS) -> Column:
    """Struct (l, r) of the permuted pair; left < a and right < b before and after."""

    def turn(state: Column, number: Column) -> Column:
        moved = F.pmod(state["l"] + F.pmod(of(number, F.lit(0), state["r"]), F.lit(a).cast("long")), F.lit(a).cast("long"))
        return F.transform(
            F.array(moved),
            lambda l: F.struct(
                l.alias("l"),
                F.pmod(state["r"] + F.pmod(of(number, F.lit(1), l), F.lit(b).cast("long")), F.lit(b).cast("long")).alias("r"),
            ),
        )[0]

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.array(*[F.lit(k) for k in range(rounds)]), start, turn)


def permuted(number: Column, total: int, of: RoundHash, rounds: int = ROUNDS) -> Column:
    """The place of a number (0 to total - 1) after the permutation.

    The network works on pairs with ``a * b >= total``. A result outside is permuted again until it falls inside
    (cycle walking). Less than ``a`` numbers lie outside, and a walk meets none of them twice, so it ends.
    """
    if total <= 1:
        return number.cast("long")
    a = math.isqrt(total - 1) + 1
    b = -(-total // a)
    outside = a * b - total

    def network(at: Column) -> Column:
        pair = permuted_pair(whole_part(at, b), F.pmod(at, F.lit(b)), a, b, of, rounds)
        return F.transform(F.array(pair), lambda s: s["l"] * F.lit(b) + s["r"])[0]

    def walk(start: Column, steps: int) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(steps)), start, lambda at, _: F.when(at < total, at).otherwise(network(at))
        )

    first = network(number.cast("long"))
    if outside == 0:
        return first
    short = walk(first, min(outside, SHORT_WALK))
    if outside <= SHORT_WALK:
        return short
    return F.transform(F.array(short), lambda at: F.when(at < total, at).otherwise(walk(at, outside)))[0]
