"""Train / test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.functions.keys import hash_bucket, long_hash
from vigilog.session import written

SEED = 42
TRAIN_PERCENT = 80

KEY_BITS = 60
STEP_BITS = 10


def random_split(frame: DataFrame, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """A seeded 80/20 split. It depends on how the rows lie in partitions; ``hash_split`` does not."""
    train, test = frame.randomSplit([TRAIN_PERCENT / 100, 1 - TRAIN_PERCENT / 100], seed=seed)
    return train, test


def split_name(key: str, percent: int = TRAIN_PERCENT) -> Column:
    """``train`` or ``test``, decided by the row key alone."""
    return F.when(hash_bucket(key) < percent, "train").otherwise("test")


def hash_split(frame: DataFrame, key: str, percent: int = TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    """A split that is the same for every layout, retry and re-read: two filters, no sort, no shuffle."""
    side = split_name(key, percent)
    return frame.filter(side == "train"), frame.filter(side == "test")


def _cut(rows: DataFrame, key: str, wanted: int) -> tuple[int, int]:
    """A cut of a whole-number key and the rows below it: ``wanted`` rows, or as many fewer as tie at the cut.

    Every round counts the rows by the next bits of the key, inside the bucket that the last one ended in.
    """
    low, below = 0, 0
    for bits in range(KEY_BITS - STEP_BITS, -1, -STEP_BITS):
        above = F.shiftright(key, bits + STEP_BITS) == low >> (bits + STEP_BITS)
        counts = rows.filter(above).groupBy(F.shiftright(key, bits).alias("bucket")).agg(F.count("*").alias("n"))
        for bucket, n in sorted(tuple(r) for r in counts.collect()):  # at most 2 ** STEP_BITS rows
            low = bucket << bits
            if below + n >= wanted:
                if below + n == wanted:
                    return (bucket + 1) << bits, wanted
                break
            below += n
    return low, below


def first_rows(rows: DataFrame, keys: Sequence[str], wanted: int) -> Column:
    """A condition that holds for exactly ``wanted`` rows, the smallest by the keys, which are whole numbers from 0.

    Ties of one key are decided by the next; the last one must be different in every row. No row is sorted.
    """
    chosen, tied = F.lit(False), F.lit(True)
    for key in keys:
        if wanted <= 0:
            break
        cut, below = _cut(rows.filter(tied), key, wanted)
        chosen = chosen | (tied & (F.col(key) < cut))
        tied = tied & (F.col(key) == cut)
        wanted -= below
    return chosen


def exact_split(frame: DataFrame, key: str | None = None, percent: int = TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    """Training and test rows in exact numbers: the test side is the share of the rows, rounded up.

    The test rows are those with the smallest hashes of ``key``, or of the whole row, so the split of rows with different keys
    is the same for every layout. Ties are decided by a hash of the row and then by its place in the table that is
    written here, which both sides read.
    """
    mask = (1 << KEY_BITS) - 1
    row_hash = F.xxhash64(*frame.columns).bitwiseAND(mask)
    hashes = {
        "split_hash": long_hash(key) if key else row_hash,
        "split_row": row_hash,
        "split_place": F.monotonically_increasing_id(),
    }
    table = written(frame.withColumns(hashes), "split")
    rows = table.count()
    test = first_rows(table, list(hashes), -(-rows * (100 - percent) // 100))
    return table.filter(~test).drop(*hashes), table.filter(test).drop(*hashes)
