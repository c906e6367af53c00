"""Default parameters of the rates jobs."""

import datetime as dt

# Names that result tables and callers rely on.
DEFAULT_TENORS = (
    "Y000p5",
    "Y001p0",
    "Y002p0",
    "Y003p0",
    "Y004p0",
    "Y005p0",
    "Y007p0",
    "Y010p0",
    "Y012p0",
    "Y015p0",
    "Y020p0",
    "Y025p0",
    "Y030p0",
)
DEFAULT_WINDOWS = (20, 40, 60, 90)
DEFAULT_START = dt.date(2007, 1, 1)
RATE_TABLES = ("zero_rates", "par_rates", "spotfx")
RATE_FOLDERS = {"zero_rates": "zero_coupon", "par_rates": "par", "spotfx": "spot_fx_rates"}
WINDOW_CORR_TABLE = "window_corr"
WINDOW_CORR_KEY = ("date", "observable", "source1", "source2", "window_size", "corr_type")
