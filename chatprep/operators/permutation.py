"""A keyed pseudo-random permutation of the whole numbers below n, as column arithmetic.

The numbers below ``width * height`` (a nearly square rectangle that holds n and little more) are its cells.
A round moves every cell along one side by an amount that depends on its other coordinate and the
round's key, so each round is a bijection of the rectangle and the rounds can be undone one by one. A number that
leaves the range is moved again until it is back in it (cycle walking), which keeps the whole a bijection of the
range. The rectangle has fewer than n / height cells over (about a 4,096th of that for large n), so few rows
walk, and none takes more steps than there are cells over.

Every row is permuted by itself: no sort and no shuffle, whatever n is. Values stay below 2**62 for n up to 2**60.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the same numbers stand in the SQL of the checks --------------------------------
PRIME = 2147483647
FACTOR = 48271
STEPS = (1013904223, 374761393, 668265263)
ROUNDS = 6
CHOICES = 4096
# --------------------------------------------------------------------------------------------------


def _div(x: Column, y) -> Column:
    return F.call_function("div", x, F.lit(y))


def mix(x: Column, key: Column) -> Column:
    """A number below 2**31 from a number and a key below 2**31."""
    def step(y: Column, c: Column) -> Column:
        z = (y * F.lit(FACTOR) + c + key) % F.lit(PRIME)
        return z.bitwiseXOR(F.shiftright(z, 15))

    return F.aggregate(F.array(*[F.lit(c).cast("long") for c in STEPS]), x, step)


def round_keys(seed: int, epoch: Column) -> Column:
    """The keys of all rounds, an array that depends on the seed and the epoch."""
    zero = F.lit(0).cast("long")
    base = mix(mix(F.lit(seed % PRIME).cast("long"), zero) + epoch.cast("long"), zero)
    return F.transform(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), lambda i: mix(base + i.cast("long"), zero))


def rectangle(n: int) -> tuple[int, int]:
    """(width, height) of a nearly square rectangle of at least n cells: of the heights from the root of n to an
    eighth more (at most CHOICES of them), the first that leaves the fewest cells over."""
    root = isqrt(max(n - 1, 0)) + 1
    heights = range(root, root + min(root // 8 + 1, CHOICES))
    height = min(heights, key=lambda h: -n % h)
    return -(-n // height) or 1, height


def _rounds(x: Column, keys: Column, n: int, back: bool) -> Column:
    width, height = rectangle(n)
    numbered = F.transform(keys, lambda k, i: F.struct(k.alias("k"), (i % 2 == 0).alias("across")))

    def turn(x: Column, r: Column) -> Column:
        left, right = _div(x, height), x % F.lit(height)
        sign = F.lit(-1 if back else 1)
        across = F.pmod(left + sign * mix(right, r["k"]), F.lit(width)) * F.lit(height) + right
        along = left * F.lit(height) + F.pmod(right + sign * mix(left, r["k"]), F.lit(height))
        return F.when(r["across"], across).otherwise(along)

    return F.aggregate(F.reverse(numbered) if back else numbered, x, turn)


def permuted(x: Column, keys: Column, n: int, back: bool = False) -> Column:
    """The place of number ``x`` below n, or with ``back`` the number at place ``x``. ``x`` and ``keys`` should
    be columns of the frame (they are used several times)."""
    width, height = rectangle(n)
    spare = width * height - n

    def walk(y: Column, _: Column) -> Column:
        return F.when(y < n, y).otherwise(_rounds(y, keys, n, back))

    first = _rounds(x.cast("long"), keys, n, back)
    if not spare:
        return first
    steps = F.sequence(F.lit(1), F.lit(spare))
    return F.transform(F.array(first), lambda y: F.when(y < n, y).otherwise(F.aggregate(steps, y, walk)))[0]
