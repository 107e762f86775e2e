"""Row hashes of a sketch as column expressions."""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: default modulus of the hash family. It is 3 * 2707, so items that agree
# modulo it collide in every row; pass p = 2**31 - 1 for a prime modulus.
DEFAULT_MODULUS = 8121
MAX_MODULUS = 2**31 - 1


@dataclass(frozen=True)
class HashFamily:
    """One bucket hash and one sign hash per sketch row.

    bucket_r(x) = ((a_r x + b_r) mod p) mod width
    sign_r(x)   = -1 where ((sa_r x + sb_r) mod p) is even, else +1
    """

    width: int
    a: tuple[int, ...]
    b: tuple[int, ...]
    sign_a: tuple[int, ...]
    sign_b: tuple[int, ...]
    p: int = DEFAULT_MODULUS

    def __post_init__(self) -> None:
        depth = len(self.a)
        if depth < 1 or self.width < 1:
            raise ValueError("a sketch needs at least one row and one column")
        if not depth == len(self.b) == len(self.sign_a) == len(self.sign_b):
            raise ValueError("every row needs all four coefficients")
        if self.width > self.p:
            raise ValueError("columns beyond the modulus would never be used")
        if not 1 < self.p <= MAX_MODULUS:
            raise ValueError(f"modulus must lie in 2..{MAX_MODULUS}")
        if any(not 1 <= v < self.p for v in (*self.a, *self.sign_a)):
            raise ValueError("multipliers must lie in 1..p-1")
        if any(not 0 <= v < self.p for v in (*self.b, *self.sign_b)):
            raise ValueError("offsets must lie in 0..p-1")

    @classmethod
    def seeded(cls, depth: int, width: int, seed: int, p: int = DEFAULT_MODULUS) -> HashFamily:
        """Random coefficients that are the same for the same seed."""
        rng = random.Random(seed)
        multipliers = [tuple(rng.randrange(1, p) for _ in range(depth)) for _ in range(2)]
        offsets = [tuple(rng.randrange(p) for _ in range(depth)) for _ in range(2)]
        return cls(width, multipliers[0], offsets[0], multipliers[1], offsets[1], p)

    @property
    def depth(self) -> int:
        return len(self.a)

    @property
    def cells(self) -> int:
        return self.depth * self.width

    def _linear(self, item: Column, a: int, b: int) -> Column:
        # Reducing the item first keeps a * x + b below 2**62 and never negative.
        x = F.pmod(item.cast("bigint"), F.lit(self.p).cast("bigint"))
        return (F.lit(a).cast("bigint") * x + F.lit(b).cast("bigint")) % F.lit(self.p).cast("bigint")

    def bucket(self, item: Column, r: int) -> Column:
        return (self._linear(item, self.a[r], self.b[r]) % F.lit(self.width).cast("bigint")).cast("int")

    def sign(self, item: Column, r: int) -> Column:
        odd = self._linear(item, self.sign_a[r], self.sign_b[r]) % F.lit(2).cast("bigint")
        return F.when(odd == 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")

    def probes(self, item: Column) -> Column:
        """Array with one (r, c, sign) struct per sketch row."""
        return F.array(
            *[
                F.struct(F.lit(r).alias("r"), self.bucket(item, r).alias("c"), self.sign(item, r).alias("sign"))
                for r in range(self.depth)
            ]
        )
