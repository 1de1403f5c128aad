"""Digests of row sets that do not depend on the order in which tasks see the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators.shaping import bind

# Nine pieces of 28 bits; their sums fit a long for 2^35 rows of a key, beyond that Spark raises an overflow.
PIECES, DIGITS = 9, 7


def digest_per(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, digest, n): one digest of all rows of a key, repeated rows counted.

    Each row's values, with their lengths, give a SHA-256; its pieces are summed, so a hot key is
    reduced in every task before the shuffle and no row list is ever built. Nulls differ from empty texts.
    """
    def framed(name: str):
        value = F.col(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    row = F.sha2(F.concat(*[framed(c) for c in columns]), 256)
    hashed = bind(df.select(*keys, *[c for c in columns if c not in keys]), _row=row)
    pieces = [F.sum(F.conv(F.substring("_row", i * DIGITS + 1, DIGITS), 16, 10).cast("bigint")).alias(f"_s{i}")
              for i in range(PIECES)]
    sums = hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *pieces)
    whole = F.sha2(F.concat_ws(",", "n", *[f"_s{i}" for i in range(PIECES)]), 256)
    return sums.select(*keys, whole.alias("digest"), "n")
