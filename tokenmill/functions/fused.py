"""``mapInArrow`` steps that follow each other run in one pass of a Python worker.

Between two such steps Spark turns every Arrow batch into rows and back, value by
value; of arrays that takes longer than most steps do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def map_batches(df: DataFrame, step: Step, schema: str) -> DataFrame:
    """``df.mapInArrow(step, schema)``; a frame made here hands its batches over inside the task.

    Only the frame itself does: of a ``select`` or ``filter`` of it the rows go through the JVM.
    """
    source, before = vars(df).get("_made_by", (df, None))
    both = step if before is None else _after(before, step)
    out = source.mapInArrow(both, schema)
    out._made_by = (source, both)
    return out


def _after(before: Step, step: Step) -> Step:
    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(before(batches))
    return both
