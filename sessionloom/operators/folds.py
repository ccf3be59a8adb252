"""Ordered folds: what no window function expresses, in one sorted pass that holds one group's state and no rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def ordered_fold(df: DataFrame, key: str, order: list[str], columns: list[str], start: Callable[[], Any], step: Callable[[Any, tuple], tuple], added: str, dealt: bool = False) -> DataFrame:
    """df with new columns (``added``, a schema) that ``step(state, values of columns)`` gives for each row of a key in order; ``dealt``: df's partitions hold whole keys already."""
    new = StructType.fromDDL(added)
    out = StructType(df.schema.fields + new.fields)
    names = [f.name for f in new.fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in new.fields]
        current, state = object(), None
        for batch in batches:
            made = []
            for own, *values in zip(batch.column(key).to_pylist(), *(batch.column(c).to_pylist() for c in columns), strict=True):
                if own != current:
                    current, state = own, start()
                made.append(step(state, tuple(values)))
            fresh = [pa.array(x, k) for x, k in zip(zip(*made, strict=True), kinds, strict=True)] if made else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([*batch.columns, *fresh], names=[*batch.schema.names, *names])

    return (df if dealt else df.repartition(key)).sortWithinPartitions(key, *order).mapInArrow(work, out)
