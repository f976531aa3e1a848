"""Order keys that keep "value of the last row" aggregates on the hash path.

``max_by(x, struct(ts, seq))`` keeps a struct in its aggregation buffer. That is not a
fixed-width type, so Spark plans a SortAggregate and every map task sorts its whole input
before combining. ``time_seq_key`` packs ``(ts, seq)`` into one DECIMAL(38,0) with the same
order: the buffer stays fixed-width and the candle aggregate is a HashAggregate.

Exact for every TIMESTAMP and BIGINT: epoch microseconds shifted by ``TS_SHIFT`` lie in
[0, 3.2e17) and the shifted sequence number in [0, 2^64] < 10^20, so
``shifted_micros * 10^20 + shifted_seq`` < 3.2e37 fits in 38 digits.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the packing (see the module docstring).
TS_SHIFT = 63_000_000_000_000_000      # > |epoch micros of 0001-01-01|
SEQ_SHIFT = 2 ** 63 + 1                # maps BIGINT to [1, 2^64]; 0 is kept for a NULL seq
SEQ_BASE = 10 ** 20                    # > 2^64

_DEC = "decimal(38,0)"


def _dec(v: int) -> Column:
    return F.lit(Decimal(v)).cast(_DEC)


def time_seq_key(ts, seq) -> Column:
    """(ts, seq) -> DECIMAL(38,0), ordered like ``struct(ts, seq)`` (a NULL seq sorts first).

    NULL when ``ts`` is NULL, so ``max_by`` skips the row, as it would skip a NULL struct.
    """
    t = F.col(ts) if isinstance(ts, str) else ts
    s = F.col(seq) if isinstance(seq, str) else seq
    micros = F.unix_micros(t).cast(_DEC) + _dec(TS_SHIFT)
    shifted = F.coalesce(s.cast("long").cast(_DEC) + _dec(SEQ_SHIFT), _dec(0))
    return micros * _dec(SEQ_BASE) + shifted
