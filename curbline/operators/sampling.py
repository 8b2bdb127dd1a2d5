"""Sampling operators. Nothing else in the library samples unless asked to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_SHARE, SEED = 0.8, 42


def bernoulli(df: DataFrame, fraction: float, seed: int = SEED, key_columns=None) -> DataFrame:
    """Keep each row with the given probability, by a hash of its values, so that the
    same rows are kept whatever the partitioning or a recomputed stage.

    Rows that are equal in all columns are kept or left together. With ``key_columns``
    only these are hashed, by an md5 that other engines compute alike.
    """
    if fraction >= 1.0:
        return df
    if key_columns is None:
        digest = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns])
        return df.where(F.pmod(digest, F.lit(1 << 32)) < F.lit(round(fraction * (1 << 32))))
    cut = min(round(fraction * (1 << 32)), (1 << 32) - 1)
    return df.where(_digest(key_columns, seed, 8) < F.lit(f"{cut:08x}"))


def _digest(key_columns, seed: int, digits: int) -> Column:
    """The first hex digits of an md5 of the columns as text. NULL counts as an empty text."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_columns]
    return F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *shown)), 1, digits)


def split_slot(key_columns, seed: int = SEED) -> Column:
    """A slot from 0 to 65535 by the values of a row: the first hex digits of an md5,
    which other engines compute alike. NULL counts as an empty text."""
    return F.conv(_digest(key_columns, seed, 4), 16, 10).cast("int")


def on_test_side(key_columns, seed: int = SEED) -> Column:
    """Whether ``split_slot`` lies at or above ``TRAIN_SHARE``. Hex digits of one length sort
    as their numbers do, so no row's digits are made a number."""
    return _digest(key_columns, seed, 4) >= F.lit(f"{round(TRAIN_SHARE * 65536):04x}")


def hash_split(df: DataFrame, key_columns, share: float = TRAIN_SHARE, seed: int = SEED):
    """Two disjoint frames by a hash of the row's columns.

    Unlike ``randomSplit`` a row's side depends on its values only, so the split
    survives a changed partitioning or a recomputed stage.
    """
    cut = F.lit(round(share * 65536))
    slot = split_slot(key_columns, seed)
    return df.where(slot < cut), df.where(slot >= cut)


def bottom_k(df: DataFrame, order: Column, k: int, rows: int | None = None) -> DataFrame:
    """The ``k`` rows of smallest ``order`` (an md5 in hex, or text that is spread like
    one), in that order.

    Where there are many rows, those above a threshold that ``rows`` (counted, if not
    given) makes about four times k lie below are left out first, so that a task sorts
    and ships few rows, not k. If fewer than k are below, all rows are taken.
    """
    rows = df.count() if rows is None else rows
    if rows > 16 * k:
        cut = f"{min(round((4 * k + 64) / rows * (1 << 32)), (1 << 32) - 1):08x}"
        below = df.where(order < F.lit(cut))
        if below.limit(k).count() >= k:
            df = below
    return df.orderBy(order).limit(k)


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Rows dealt out over that many tasks, for iterative fits on few large files."""
    return df if partitions is None else df.repartition(partitions)
