"""Join helpers with an explicit size check before broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 2_000_000


def bounded_broadcast(small: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``small`` only when it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows.  Above the bound the plain
    frame is returned: the join then shuffles both sides, and AQE may still
    turn it into a broadcast at run time or split skewed partitions.
    """
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small
