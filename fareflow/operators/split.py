"""Train/test split that is a filter on a hash of the row, not a random draw.

The side of a row depends only on its key and the seed, so it is the same under
any partitioning, in every job and after a lost executor; equal rows share a side.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow import schemas as S

BUCKETS = 100


def hash_bucket(keys: Sequence[str] = S.CLEANED_COLUMNS, seed: int = 42) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(BUCKETS))


def hash_split(
    df: DataFrame, train_percent: int = 80, bucket: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(train, test); `bucket` is any expression over `df` with values 0 to 99."""
    if not 0 <= train_percent <= BUCKETS:
        raise ValueError(f"train_percent must lie in 0..{BUCKETS}")
    bucket = hash_bucket() if bucket is None else bucket
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)
