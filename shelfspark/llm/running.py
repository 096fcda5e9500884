"""Running sums and running xors by key that no hot key puts into one task.

Rows are dealt by ranges of (key, order), so a key of any size spreads over ranges. Each
range is read once, sorted, in Arrow batches; what a key has in earlier ranges is added
afterwards from one small row a range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved


def _scan(key: str, sums: list[str], xors: list[str]):
    """Adds ``<column>_run``, inclusive, within one range; marks the range's first and last row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, last, carry, held = TaskContext.get().partitionId(), False, None, {}, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(key)
            new = np.ones(n, bool)
            new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[0] = not seen or keys[0].as_py() != last
            start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            first = int(np.argmax(new)) if new.any() else n  # rows before it go on with the last batch's key
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            for c, add in [*((c, np.add) for c in sums), *((c, np.bitwise_xor) for c in xors)]:
                value = columns[c].to_numpy(zero_copy_only=False)
                total = add.accumulate(value)
                before = total - value if add is np.add else total ^ value
                run = total - before[start] if add is np.add else total ^ before[start]
                run[:first] = add(run[:first], carry.get(c, np.int64(0)))
                carry[c] = run[-1]
                columns[c + "_run"] = pa.array(run)
            columns["__p"] = pa.array(np.full(n, part, np.int32))
            mark = np.zeros(n, np.int32)
            mark[0] = 0 if seen else 1
            columns["__mark"] = pa.array(mark)
            seen, last = True, keys[-1].as_py()
            if held is not None:
                yield pa.RecordBatch.from_pydict(held)
            held = columns
        if held is not None:
            mark = held["__mark"].to_numpy().copy()
            mark[-1] += 2
            yield pa.RecordBatch.from_pydict(held | {"__mark": pa.array(mark)})

    return scan


def running(df: DataFrame, key: str, order: list[Column], sums: list[str], xors: list[str] = (), name: str = "running") -> DataFrame:
    """df with ``<column>_run`` for each long column named: its running sum or xor, inclusive, by key in this order.

    key is a column without nulls; sums and xors are long columns without nulls. The result is a saved table.
    """
    columns, every = df.columns, [*sums, *xors]
    ranges = [F.col(key), *order]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    schema += "".join(f", `{c}_run` bigint" for c in every) + ", `__p` int, `__mark` int"
    dealt = df.repartitionByRange(*ranges).sortWithinPartitions(*ranges)
    table = saved(dealt.mapInArrow(_scan(key, list(sums), list(xors)), schema), name)
    # At most two rows a range come to the driver.
    edges = table.where("__mark > 0").select("__p", "__mark", F.col(key).alias("k"), *[f"{c}_run" for c in every]).collect()
    first = {r["__p"]: r["k"] for r in edges if r["__mark"] & 1}
    ends = {r["__p"]: r for r in edges if r["__mark"] & 2}
    carry, offsets = None, []
    for p in sorted(first):
        end, goes_on = ends[p], carry is not None and carry[0] == first[p]
        if goes_on:
            offsets.append((p, first[p], *carry[1]))
        totals = [end[f"{c}_run"] for c in every]
        if goes_on and end["k"] == first[p]:
            totals = [a + b if c in sums else a ^ b for c, a, b in zip(every, totals, carry[1], strict=True)]
        carry = (end["k"], totals)
    if not offsets:
        return table.drop("__p", "__mark")
    kind = df.schema[key].dataType.simpleString()
    fields = "`__q` int, `__k` " + kind + "".join(f", `__o{i}` bigint" for i in range(len(every)))
    small = F.broadcast(df.sparkSession.createDataFrame(offsets, fields))
    joined = table.join(small, (F.col("__p") == F.col("__q")) & (F.col(key) == F.col("__k")), "left")
    runs = []
    for i, c in enumerate(every):
        run, more = F.col(f"{c}_run"), F.coalesce(F.col(f"__o{i}"), F.lit(0).cast("long"))
        runs.append((run + more if c in sums else run.bitwiseXOR(more)).alias(f"{c}_run"))
    return joined.select(*columns, *runs)
