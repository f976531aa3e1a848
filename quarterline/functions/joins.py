"""Join helpers: a broadcast hint only for sides of a known size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast side is shipped whole to every executor; keep it to dimension-sized data.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, known_rows: int | None = None) -> DataFrame:
    """Join with ``small`` broadcast only when the caller knows a row bound ``<= max_rows``.

    ``known_rows`` is a bound the caller already has (e.g. the 672-name contract space). Without
    one there is no hint and no job: AQE measures the small side in bytes when it has run and
    broadcasts it under the session's own limit, else it stays a shuffle join.
    """
    if known_rows is not None and known_rows <= max_rows:
        return big.join(F.broadcast(small), on=on, how=how)
    return big.join(small, on=on, how=how)
