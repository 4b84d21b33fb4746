"""Image normalisation (S8): small images pass, large ones are encoded again with less quality, then less size.

The codec is a function, since none is part of this package: (content, quality, scale) -> JPEG bytes.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The size that passes, qualities in order, the factor of a further step.
PASS_BYTES, QUALITIES, SHRINK = 4 * 1024 * 1024, (85, 75, 65, 55), 0.75


def shrink(content: bytes, name: str, encode: Callable[[bytes, int, float], bytes], most: int = PASS_BYTES) -> bytes:
    heic = name.lower().endswith(".heic")
    if len(content) <= most and not heic:
        return content
    scale = 1.0
    while True:
        for quality in QUALITIES if scale == 1.0 else QUALITIES[-1:]:
            out = encode(content, quality, scale)
            if len(out) <= most or scale < 0.05:
                return out
        scale *= SHRINK


def normalised(content: Column, name: Column, encode: Callable[[bytes, int, float], bytes], most: int = PASS_BYTES) -> Column:
    @F.pandas_udf("binary")
    def run(contents: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([None if c is None else shrink(c, n or "", encode, most) for c, n in zip(contents, names, strict=True)])

    return run(content, name)
