"""Deterministic keys, buckets and uids."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the personalisation of the uid digest.
PERSON = b"acft"


def hash_order(seed: str, key: Column) -> Column:
    """Hexadecimal digest whose order is that of the unsigned 64-bit hash of seed and key: a random but repeatable order."""
    return F.sha1(F.concat(F.lit(seed), key.cast("string")))


def unsigned64(key: Column) -> Column:
    """First eight bytes of the SHA-1, as decimal(20,0)."""
    return F.conv(F.substring(F.sha1(key), 1, 16), 16, 10).cast("decimal(20,0)")


def bucket(key: Column, buckets: int = 10_000) -> Column:
    """Bucket of the first 15 hexadecimal digits, which fit a signed long."""
    return F.pmod(F.conv(F.substring(F.sha1(key), 1, 15), 16, 10).cast("long"), F.lit(buckets))


def in_share(key: Column, share: float, buckets: int = 10_000) -> Column:
    """Whether the key falls into the share; a smaller share is part of a larger one. 0 or less takes none, 1 or more all."""
    if share <= 0:
        return F.lit(False)
    return F.lit(True) if share >= 1 else bucket(key, buckets) < int(share * buckets)


def md5_seed(key: Column) -> Column:
    """First eight bytes of the MD5, little endian, as hexadecimal digits."""
    m = F.md5(key)
    return F.concat(*[F.substring(m, 2 * i + 1, 2) for i in reversed(range(8))])


def base_uid_key(source: Column, index: Column, start: Column, end: Column) -> Column:
    """The string whose digest is a chunk's uid."""
    return F.concat_ws("|", source, F.format_string("%06d", index), F.format_string("%.3f", start), F.format_string("%.3f", end))


def aug_uid_key(base_uid: Column, stage: Column, copy: Column) -> Column:
    return F.concat_ws("|", base_uid, stage, F.format_string("copy%03d", copy))


@F.pandas_udf(T.StringType())
def blake_uid(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """20 hexadecimal digits of BLAKE2b, which Spark has not (Arrow batches)."""
    for s in keys:
        yield s.map(lambda k: None if k is None else hashlib.blake2b(k.encode(), digest_size=10, person=PERSON).hexdigest())
