"""Backward as-of join: each row with the latest row of another table at or before it.

Both tables go into one tagged union, dealt out by the keys; a running last value carries the
right rows forward to the left ones. Each row crosses the network once, the work is linear
whatever the number of right rows of a key, and hot keys are sliced (`ordered.py`).
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.operators.ordered import HOT_ROWS, slice_hot, with_running

_KEY, _AT, _TIE, _SIDE, _VALUES = "__as_of_key{}", "__as_of_at", "__as_of_tie", "__as_of_side", "__as_of_values"


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_order: tuple[str, str],
    right_order: tuple[str, str],
    values: list[str],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """`left` with the `values` of the last row of `right` of the same keys at or before it.

    An order is a time stamp and a number that breaks its ties (a missing number comes first);
    where both are equal the right row counts. Rows without a key or a time find nothing, and
    right rows without them are found by none. Left rows all stay.
    """
    names = [_KEY.format(i) for i in range(len(keys))]
    key_columns = {n: F.coalesce(F.col(k).cast("string"), F.lit("")) for n, k in zip(names, keys, strict=True)}

    def tagged(df: DataFrame, order: tuple[str, str], side: int) -> DataFrame:
        return df.withColumns({
            _AT: F.col(order[0]).cast("timestamp"), _TIE: F.coalesce(F.col(order[1]).cast("long"), F.lit(-(1 << 63))), _SIDE: F.lit(side), **key_columns,
        })

    known = F.lit(True)
    for column in (*keys, right_order[0]):
        known = known & F.col(column).isNotNull()
    # Right values travel as one struct, so that a null value hides an earlier one.
    offered = tagged(right.filter(known), right_order, 0).select(*names, _AT, _TIE, _SIDE, F.struct(*values).alias(_VALUES))
    rows = tagged(left, left_order, 1).unionByName(offered, allowMissingColumns=True)
    sliced = slice_hot(rows, names, [_AT, _TIE, _SIDE], hot_rows)
    found = with_running(sliced, names, [_AT, _TIE, _SIDE], last={"__as_of_found": F.col(_VALUES)}).done()
    fits = F.lit(True)
    for column in (*keys, left_order[0]):
        fits = fits & F.col(column).isNotNull()
    taken = [F.when(fits, F.col(f"__as_of_found.{v}")).alias(v) for v in values]
    return found.filter(F.col(_SIDE) == 1).select(*left.columns, *taken)
