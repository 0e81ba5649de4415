"""Number columns: squares, bins, rounding."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def square(column: Column) -> Column:
    """Product form: keeps the column's type, where `F.pow` always gives a double."""
    return column * column


def typed_square_udf(return_type: T.DataType):
    """Squares in a Python UDF whose result is NULL unless it has the declared type.

    Shown for parity only: `square` does the same work without leaving the JVM. Cells
    go over in Arrow batches; the rule that a square of another kind of number (whole or
    not) than the declared one is NULL is written out here.
    """
    whole, target = isinstance(return_type, T.IntegralType), to_arrow_type(return_type)

    @F.arrow_udf(return_type)
    def squared(cells: pa.Array) -> pa.Array:
        if pa.types.is_integer(cells.type) == whole:
            return pc.multiply(cells, cells).cast(target, safe=False)
        return pa.nulls(len(cells), target)

    return squared


def bins(column: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed bin (edge, next edge] the value lies in, else NULL."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per bin is needed")
    label = F.lit(None).cast("string")
    for low, high, name in reversed(list(zip(edges, edges[1:], labels))):
        label = F.when((column > low) & (column <= high), F.lit(name)).otherwise(label)
    return label


def round_half_even(column: Column, digits: int = 0) -> Column:
    """Rounds ties to the even neighbour: 2.5 to 2, 3.5 to 4."""
    return F.bround(column, digits)
