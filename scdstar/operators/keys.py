"""Surrogate keys: assignment on insert, and the latest version of a natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

KEY_BUCKETS = 1 << 20
#: Column with the bucket of a natural key, in rows that are dealt by it.
KEY_BUCKET = "_bucket"
_HEX_DIGITS = 5  # 16 ** 5 == KEY_BUCKETS


def key_bucket_sql(key: Sequence[str]) -> str:
    """SQL for the bucket of a natural key, 0 .. KEY_BUCKETS-1, computed from its content alone."""
    text = ", ".join(f"CAST({c} AS STRING)" for c in key)
    return f"CAST(conv(substring(md5(concat_ws('|', {text})), 1, {_HEX_DIGITS}), 16, 10) AS BIGINT)"


def key_bucket(key: Sequence[str]) -> Column:
    """Bucket of a natural key."""
    return F.expr(key_bucket_sql(key))


def deal(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """Rows with the bucket of their key, shuffled by it into ``buckets`` partitions, unless they are
    already. The column's metadata tell the number of partitions. It is computed again after the shuffle
    rather than sent along."""
    if KEY_BUCKET in df.columns:
        if dealt_into(df) == buckets:
            return df
        df = df.drop(KEY_BUCKET)
    bucket = key_bucket(key)
    return df.repartition(buckets, bucket).select(
        "*", bucket.alias(KEY_BUCKET, metadata={"buckets": buckets})
    )


def dealt_into(df: DataFrame) -> int | None:
    """The number of partitions that rows, or the files they come from, are dealt into by key bucket."""
    return df.schema[KEY_BUCKET].metadata.get("buckets") if KEY_BUCKET in df.columns else None


def assign_keys(
    df: DataFrame, sk: str, key: Sequence[str], base: Column, buckets: int | None = None
) -> DataFrame:
    """Add surrogate keys greater than ``base`` to rows with distinct natural keys.

    Rows are hashed into buckets; the n-th row of bucket b (in natural-key order)
    gets ``base + (n - 1) * KEY_BUCKETS + b + 1``. Keys are unique and never
    reused, with small gaps as in any database sequence. They depend only on the
    rows, so a recomputed task assigns the same ones. The cost is one shuffle
    into even buckets: no counting pass, no global sort, no single-task window.
    With ``buckets`` rows keep that deal, in as many partitions, and the column ``_bucket``.
    """
    rank = F.row_number().over(Window.partitionBy(KEY_BUCKET).orderBy(*key)).cast("long")
    dealt = deal(df, key, buckets) if buckets else df.withColumn(KEY_BUCKET, key_bucket(key))
    keyed = dealt.withColumn(sk, base + (rank - 1) * F.lit(KEY_BUCKETS) + F.col(KEY_BUCKET) + 1)
    return keyed if buckets else keyed.drop(KEY_BUCKET)


def highest_key(versions: DataFrame | None, sk: str) -> Column:
    """The highest key given out so far, 0 if none, as a scalar subquery."""
    if versions is None:
        return F.lit(0).cast("long")
    return versions.agg(F.coalesce(F.max(sk), F.lit(0)).cast("long").alias(sk)).scalar()


def max_key(df: DataFrame, column: str) -> DataFrame:
    """One row: the highest id, or 1 for an empty table."""
    return df.agg(F.coalesce(F.max(column), F.lit(1)).cast("long").alias("max_id"))


def latest_keys(versions: DataFrame, natural: str, sk: str) -> DataFrame:
    """One row per natural key with the surrogate key of its latest version.

    Keys grow with every batch, so the latest version has the greatest one. This
    reads two columns and combines map-side, whatever the number of versions.
    """
    return versions.groupBy(natural).agg(F.max(sk).alias(sk))


def latest_versions(versions: DataFrame, key: Sequence[str], sk: str) -> DataFrame:
    """The whole latest version of each natural key."""
    columns = [F.col(c) for c in versions.columns if c not in key]
    newest = F.max_by(F.struct(*columns), F.struct("start_date", sk)).alias("_v")
    return versions.groupBy(*key).agg(newest).select(*key, "_v.*").select(*versions.columns)
