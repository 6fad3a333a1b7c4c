"""Keys that stand on more than one row, found without a shuffle of every key.

First every task turns its keys into sorted 32-bit remainders, one array for each
of 65,536 slices of the hash space, so that a key costs four bytes in the
exchange however wide it is and however many rows hold it in that task. Where a
remainder is in two tasks' arrays, or was met twice by one task, its key is a
candidate. Then only the rows of candidates are grouped, by the keys themselves,
so the result is exact: two keys with the same 48 bits cost a little work.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.session import scratch_path

#: Bits of the hash that choose the slice, and bits that are kept within it.
SLICE_BITS, REMAINDER_BITS = 16, 32
#: Keys that a task sorts at once.
BATCH = 4_000_000


def fingerprint(df: DataFrame, column: str) -> Column:
    """The upper 48 bits of the key's hash; null for a null key. Numbers that compare as equal hash alike."""
    key = F.col(f"`{column}`")
    if df.schema[column].dataType.typeName() in ("double", "float"):
        key = F.when(key == 0, F.lit(0.0)).otherwise(key)  # -0.0
    return F.when(key.isNotNull(), F.shiftrightunsigned(F.xxhash64(key), 64 - SLICE_BITS - REMAINDER_BITS))


def candidates(prints: DataFrame) -> DataFrame:
    """Of a frame of one column of 48-bit numbers those that are there more than once, as ``print``; nulls don't count.

    A slice's arrays meet in one task, which holds few slices at a time: four bytes for each different key of the
    table, divided by 65,536 (60 MB at a trillion keys). A key on a third of all
    rows is one number of each task.
    """
    batch, low = BATCH, REMAINDER_BITS

    def shrink(parts: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def packed(chunks):
            values, counts = np.unique(np.concatenate(chunks), return_counts=True)
            slices, starts = np.unique(values >> low, return_index=True)
            rests, ends = values.astype("<u4"), [*starts[1:], len(values)]
            return pa.RecordBatch.from_arrays([
                pa.array(slices.astype("int32")),
                pa.array([rests[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                pa.array([rests[a:b][counts[a:b] > 1].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            ], ["slice", "once", "twice"])

        held, rows = [], 0
        for part in parts:
            values = part.column(0).drop_null().to_numpy(zero_copy_only=False)
            if len(values):
                held.append(values)
                rows += len(values)
            if rows >= batch:
                yield packed(held)
                held, rows = [], 0
        if held:
            yield packed(held)

    def repeated(parts: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def prints(part, name):
            packed = part.column(name).cast(pa.large_binary())
            ends = np.frombuffer(packed.buffers()[1], "<i8")[packed.offset : packed.offset + len(packed) + 1]
            size = (int(ends[-1]) - int(ends[0])) // 4
            rests = np.frombuffer(packed.buffers()[2], "<u4", size, int(ends[0])) if size else np.empty(0, "<u4")
            return np.repeat(part.column("slice").to_numpy().astype("int64") << low, np.diff(ends) // 4) | rests

        def found(once, twice):
            values, counts = np.unique(once, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate([values[counts > 1], twice])))], ["print"])

        once, twice, held = [], [], 0
        for part in parts:
            if not part.num_rows:
                continue
            once.append(prints(part, "once"))
            twice.append(prints(part, "twice"))
            held += len(once[-1])
            if held >= batch:
                # Rows come by slice: all before the last one are whole.
                cut = int(part.column("slice")[part.num_rows - 1].as_py()) << low
                a, b = np.concatenate(once), np.concatenate(twice)
                yield found(a[a < cut], b[b < cut])
                once, twice = [a[a >= cut]], [b[b >= cut]]
                held = len(once[0])
        if once:
            yield found(np.concatenate(once), np.concatenate(twice))

    shrunk = prints.mapInArrow(shrink, "slice int, once binary, twice binary")
    return shrunk.repartition("slice").sortWithinPartitions("slice").mapInArrow(repeated, "print bigint")


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Every key on more than one row with its number of rows: ``(key, rows)``; null keys are left out.

    ``key`` has the column's type. The candidates are written under the shared
    folder first, so that Spark knows their size when it plans the join: few are
    broadcast, many are joined by a shuffle.
    """
    marked = df.select(F.col(f"`{column}`").alias("key"), fingerprint(df, column).alias("print"))
    path = scratch_path(df.sparkSession, "keys")
    candidates(marked.select("print")).write.parquet(path)
    found = df.sparkSession.read.schema("print bigint").parquet(path)
    counted = marked.join(found, "print", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    return counted.where("rows > 1")
