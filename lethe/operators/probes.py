"""One probe set for several sets of reached values of the same type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.operators.sizing import VALUE, Measured

_ENTRY_BYTES = 24


def probe(members: list[tuple[int, int, Measured]]) -> Measured:
    """(_value, _by): what reaches a value, of rules whose values have one type."""
    tagged = [
        m.frame.select(
            VALUE,
            F.struct(
                F.lit(group).alias("of"),
                F.col("chunk_no").cast("int").alias("chunk_no"),
                F.lit(number).alias("no"),
            ).alias("_by"),
        )
        for number, group, m in members
    ]
    if len(tagged) == 1:
        frame = tagged[0].select(VALUE, F.array("_by").alias("_by"))
    else:
        union = reduce(DataFrame.unionByName, tagged)
        frame = union.groupBy(VALUE).agg(F.collect_list("_by").alias("_by"))
    rows = sum(m.rows for _, _, m in members)
    size = sum(m.bytes + _ENTRY_BYTES * m.rows for _, _, m in members)
    filled = [m for _, _, m in members if m.rows]
    known = all(m.low is not None and m.high is not None for m in filled)
    low = min((m.low for m in filled), default=None) if known else None
    high = max((m.high for m in filled), default=None) if known else None
    return Measured(frame, rows, size, low, high)
