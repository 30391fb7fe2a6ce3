"""Fixed values that must equal the reference behaviour for equal results."""

# --- fixed values (reference semantics) -------------------------------------
# Canonical feature order; flattening windows depends on it.
FEATURE_COLS = [
    "open", "high", "low", "close", "volume",
    "log_return",
    "sma_10", "sma_20", "sma_50",
    "sma_10_ratio", "sma_20_ratio", "sma_50_ratio",
    "rsi_14",
    "macd", "macd_signal", "macd_hist",
    "volatility_20",
    "volume_norm",
]
OHLC = ["open", "high", "low", "close"]
OHLCV = ["open", "high", "low", "close", "volume"]
SMA_WINDOWS = [10, 20, 50]
RSI_COM = 13            # EWM centre of mass for the 14-day RSI
MACD_FAST_SPAN = 12
MACD_SLOW_SPAN = 26
MACD_SIGNAL_SPAN = 9
VOL_WINDOW = 20         # volatility: sample std of 20 log-returns
VOLUME_WINDOW = 20      # volume_norm: volume / 20-row mean
TRADING_DAYS = 252      # annualisation factor (sqrt(252))
VAL_PCT = 15            # val share, integer percent (int(n * 0.15))
TEST_PCT = 15           # test share, integer percent
DEFAULT_WINDOW = 30     # sequence length
MAX_NULL_RATE = 0.05    # validate: a column with a null rate above this fails
PROBA_THRESHOLD = 0.5   # networks: label = P(up) >= 0.5
IMPROVE_EPS = 1e-4      # early stopping: improvement means val < best - 1e-4
SPLITS = ["train", "val", "test"]
# ---------------------------------------------------------------------------
