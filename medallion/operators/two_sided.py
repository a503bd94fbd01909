"""Two-party fact expansion (U1, U2): one input row becomes one row per side.

The reference writes this as ``home_rows UNION ALL away_rows``, which scans
the fact table twice.  Here both sides are built as structs with the *same*
field names and types and ``inline(array(side1, side2))`` emits them from a
single scan, inside the same codegen stage as the projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_sided(df: DataFrame, sides: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Expand each row into ``len(sides)`` rows.

    ``sides`` is a list of mappings ``output name -> Column``; every mapping
    must have the same keys in the same order.  Field types may differ where
    Spark can widen them to a common type (``array`` coerces its struct
    elements, e.g. int and bigint to bigint); otherwise cast them first.
    """
    if not sides:
        raise ValueError("two_sided needs at least one side")
    names = list(sides[0].keys())
    for s in sides[1:]:
        if list(s.keys()) != names:
            raise ValueError(f"all sides must name the same fields in order: {names} vs {list(s)}")
    structs = [F.struct(*[s[n].alias(n) for n in names]) for s in sides]
    return df.select(F.inline(F.array(*structs)))

