"""A Bloom filter of keys, of a fixed size, that spares rows without a partner the way through a shuffle.

It never says no to a key that it holds. It has ``BITS`` bits whatever the number of keys: with very
many it says yes to most rows, which then are shuffled as they would be without it.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Two MB in every task, and as many rows of one number on their way to the driver.
BITS = 1 << 24
HASHES = 3


class Bloom:
    """The keys of a table, for rows of others to ask after."""

    def __init__(self, df: DataFrame, key: str):
        places = df.select(F.explode(F.array(*self.places(key))).alias("p"))
        words = places.groupBy(F.expr("p div 64").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, int(p % 64))")).alias("bits"))
        found = words.toArrow()  # BITS / 64 rows at most
        self.bits = np.zeros(BITS // 64, np.int64)
        self.bits[found.column("at").to_numpy()] = found.column("bits").to_numpy()

    @staticmethod
    def places(key: str) -> list[Column]:
        """Where the bits of a key are."""
        return [F.pmod(F.xxhash64(F.lit(i), F.col(key)), F.lit(BITS)).alias(f"_place{i}") for i in range(HASHES)]

    def holds(self, columns: list[pa.Array]) -> np.ndarray:
        """Whether the keys with these places may be among those of the table."""
        yes = np.ones(len(columns[0]), dtype=bool)
        for c in columns:
            p = c.to_numpy(zero_copy_only=False)
            yes &= (self.bits[p >> 6] >> (p & 63)) & 1 == 1
        return yes

    def may_hold(self, key: str) -> Column:
        """The same for a key column, by name."""

        @F.arrow_udf("boolean")
        def held(*columns: pa.Array) -> pa.Array:
            return pa.array(self.holds(list(columns)))

        return held(*self.places(key))
