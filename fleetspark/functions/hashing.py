"""Stable rollout bucket ``int(sha256(id), 16) % 100`` as a native expression.

The 256-bit digest is folded in eight 32-bit chunks with Horner's rule modulo
100 (2^32 mod 100 = 96), so no big-integer arithmetic or Python UDF is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetspark.functions.util import col_of

_TWO32_MOD_100 = 96


def hash_bucket(c, modulus: int = 100) -> Column:
    """Bucket in [0, modulus) equal to Python's ``int(sha256(s).hexdigest(),16) % modulus``."""
    if modulus != 100:
        step = pow(2, 32, modulus)
    else:
        step = _TWO32_MOD_100
    h = F.sha2(col_of(c).cast("string"), 256)
    acc = F.lit(0).cast("long")
    for i in range(8):
        chunk = F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long")
        acc = (acc * step + chunk) % modulus
    return acc.cast("int")


def percentage_match(c, percentage) -> Column:
    """R2 core: >=100 all, <=0 none, else bucket < percentage."""
    p = percentage if isinstance(percentage, Column) else F.lit(percentage)
    return (F.when(p >= 100, True).when(p <= 0, False)
            .otherwise(hash_bucket(c) < p))
