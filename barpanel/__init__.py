"""barpanel: Spark-native analytics for panels of daily (or intraday) price bars.

Every operator takes and returns a ``pyspark.sql.DataFrame`` and keeps the
work inside Catalyst / Tungsten: window functions for the ordered per-series
analytics, grouped aggregates for the reports, Spark ML for the models.
"""

from barpanel.constants import FEATURE_COLS, OHLC, OHLCV  # noqa: F401
from barpanel.session import get_session  # noqa: F401

__all__ = ["FEATURE_COLS", "OHLC", "OHLCV", "get_session"]
