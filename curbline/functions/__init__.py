from .amounts import exact_avg, exact_rest, exact_sum, exact_total, exact_units, ratio
from .clock import interval_us, minute_boundaries, slice_start
from .keys import surrogate_key, trip_key

__all__ = [
    "exact_avg", "exact_rest", "exact_sum", "exact_total", "exact_units", "interval_us", "minute_boundaries", "ratio",
    "slice_start", "surrogate_key", "trip_key",
]
