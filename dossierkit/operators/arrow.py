"""Records out of one text per row, read by a small function in Arrow batches."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

from dossierkit.functions.sqltext import col

# Tasks get the helpers of this module with their function: executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Records that are handed on at a time.
BATCH_ROWS = 2048

_TYPES = {
    "string": (StringType(), pa.string()),
    "texts": (ArrayType(StringType()), pa.list_(pa.string())),
    "int": (IntegerType(), pa.int32()),
    "double": (DoubleType(), pa.float64()),
    "boolean": (BooleanType(), pa.bool_()),
}


def records_of(
    df: DataFrame,
    column: str,
    value: str,
    fields: Sequence[tuple[str, str]],
    read: Callable[[str], Iterator[tuple]],
) -> DataFrame:
    """For each row the records that ``read`` takes from a text, beside the columns other than ``column``.

    ``value`` is SQL of the text; null is read as ''. ``fields`` are names and kinds (``string``,
    ``texts``, ``int``, ``double``, ``boolean``). No shuffle; a row without records goes.
    """
    kept = [c for c in df.columns if c != column]
    kinds = [_TYPES[kind][1] for _, kind in fields]
    titles = [*kept, *[name for name, _ in fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            records: list[tuple] = []

            def made() -> pa.RecordBatch:
                take = pa.array(rows, pa.int64())
                same = [batch.column(i).take(take) for i in range(batch.num_columns - 1)]
                return pa.RecordBatch.from_arrays([*same, *[pa.array(v, k) for v, k in zip(zip(*records), kinds)]], titles)

            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                for record in read(text.as_py()):
                    rows.append(i)
                    records.append(record)
                    if len(rows) >= BATCH_ROWS:
                        yield made()
                        rows, records = [], []
            if rows:
                yield made()

    # Names with dots would be read as fields of structs.
    numbered = [col(c).alias(f"_{i}") for i, c in enumerate(kept)]
    same = [StructField(c, df.schema[c].dataType) for c in kept]
    made = [StructField(name, _TYPES[kind][0]) for name, kind in fields]
    return df.select(*numbered, F.expr(f"coalesce({value}, '')").alias("_text")).mapInArrow(run, StructType([*same, *made]))
