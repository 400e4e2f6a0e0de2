"""One row per group out of its rows in order, read as a stream.

A digest of a whole conversation is sequential by nature, so one task reads the group's rows;
it holds a running state and one Arrow batch, never the group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


class State(Protocol):
    def add(self, row: dict) -> None: ...

    def result(self) -> dict: ...


def per_group(df: DataFrame, group: str, order: list[Column | str], start: Callable[[], State], fields: str) -> DataFrame:
    """``group`` and ``fields`` of each group; ``start`` makes the state that its rows are added to.

    Null is a group of its own. ``start`` must be picklable.
    """
    schema = T.StructType([df.schema[group], *T._parse_datatype_string(fields).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, out = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row[group] != current:
                    if state is not None:
                        out.append({group: current, **state.result()})
                    current, state = row[group], start()
                state.add(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if state is not None:
            yield pa.RecordBatch.from_pylist([{group: current, **state.result()}], schema=arrow)

    return df.repartition(F.col(group)).sortWithinPartitions(group, *order).mapInArrow(run, schema)
