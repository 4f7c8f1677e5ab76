"""Fixed-point number formatting with Python's rounding (exact binary value,
ties to even), as the reference's ``'%.1f' % x`` does. Java's formatter
(``format_string``) rounds the shortest decimal form half-up instead, so
0.15 (stored as 0.1499...) would print 0.2 rather than 0.1.

Used only on aggregated report rows (one per brand/model), never on data.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(c, digits: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c

    @F.pandas_udf("string")
    def _fmt(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None or pd.isna(v) else f"%.{digits}f" % v)

    return _fmt(c.cast("double"))
