"""What several corpus operators share: words, safe column handling, iteration over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: what separates words, as a Java character class.
SPACE = r"[\x20\x09-\x0D]"
#: Texts handed to Python in one step of a task, in bytes: bounds a worker's memory whatever the batch holds.
STEP_BYTES = 8 << 20


def words(text: Column) -> Column:
    """The words of a text as an array; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    Column expressions are substituted where they are used. Inside a lambda that would compute them
    again for each element; a lambda variable over a one-element array is computed once.
    """
    return F.transform(F.array(value), body)[0]


def once(df: DataFrame, name: str = "_once") -> DataFrame:
    """Add a column that keeps the optimizer from computing the columns of ``df`` again in a filter above.

    A filter is pushed down by substituting the expressions it refers to, which repeats costly ones for every
    reference. It is not pushed through a projection that numbers rows if the condition refers to the number.
    Use ``F.col(name) >= 0`` in the condition; it is always true.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def bytes_of(text: str = "text") -> Column:
    """A text as UTF-8 bytes; Arrow hands bytes to Python without decoding. Null becomes empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def steps(batches: Iterator[pa.RecordBatch], weigh: str) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the binary column ``weigh`` of each part has about STEP_BYTES, but one row at least."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(weigh))
        total = column.nbytes
        if total <= STEP_BYTES or batch.num_rows == 1:
            yield batch
            continue
        size = max(1, batch.num_rows * STEP_BYTES // total)
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)
