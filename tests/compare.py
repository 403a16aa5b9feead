"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import numpy as np
import pandas as pd


def rows(df: pd.DataFrame) -> list[str]:
    def value(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
            return None
        if isinstance(v, (bool, np.bool_)):
            return bool(v)
        if isinstance(v, (int, float, np.integer, np.floating)) or type(v).__name__ == "Decimal":
            return round(float(v), 5) + 0.0
        return str(v)

    df = df[sorted(df.columns)]
    return sorted(str(tuple(value(v) for v in r)) for r in df.itertuples(index=False, name=None))
