"""Full outer equi-join of two joins that adaptive execution can split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def outer_chain(tables: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """`a.join(b, on, "full").join(c, on, "full")` and so on, for any number of tables.

    Spark splits the tasks of a hot key in a left and in an anti-join, but not in a full outer
    join. So the result is put together: each table's rows that no earlier table matches, left
    joined with the tables after it. Every join has the same keys, so a table is shuffled once
    for its chain; the anti-joins read key columns only. Rows with null keys match nothing.

    Left joins need the rows of one key of the table on the right in one task: with a snapshot's
    row per customer these are few. A hot key may be on the left, and null keys may be anywhere.
    """
    keys = list(on)
    parts = []
    for i, table in enumerate(tables):
        rows = table
        for earlier in tables[:i]:
            rows = rows.join(earlier.select(keys), keys, "left_anti")
        for later in tables[i + 1 :]:
            rows = rows.join(later, keys, "left")
        parts.append(rows)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole
