"""Left-deep equi joins on (country, year)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from panelforge.contracts import KEYS


def left_join_all(anchor: DataFrame, others: Sequence[DataFrame],
                  keys: Sequence[str] = KEYS) -> DataFrame:
    """``anchor LEFT JOIN o1 USING keys LEFT JOIN o2 ...`` in the given order.

    Anchor rows always survive, right-only keys are lost, null keys never match
    and duplicate right keys multiply rows, as with SQL.  No hint is given:
    AQE turns a join into a broadcast only once the runtime size of a side is
    below ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and otherwise
    keeps a sort-merge join whose skewed partitions it splits.
    """
    out = anchor
    for other in others:
        out = out.join(other, list(keys), "left")
    return out
