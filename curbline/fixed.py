"""Fixed values of the trip platform; every function takes them as defaults."""

from datetime import timedelta

# Codes a payment may have.
PAYMENT_TYPES = [1, 2, 3, 4, 5, 6]
# Miles above which a trip is rejected.
MAX_DISTANCE = 200.0

# Speed layer: windows of the dropoff time, and fares this many times their window's average are anomalies.
DEMAND_WINDOW = timedelta(minutes=5)
HOP_SIZE = timedelta(minutes=30)
HOP_SLIDE = timedelta(minutes=5)
ANOMALY_FACTOR = 3.0
WATERMARK = timedelta(seconds=30)
ALLOWED_LATENESS = timedelta(minutes=2)
FILE_ROLLOVER = timedelta(minutes=5)

# Disorder of a replay.
LATE_FRACTION = 0.02
SHORTEST_DELAY = timedelta(seconds=5)
LONGEST_DELAY = timedelta(seconds=90)

# Reconciliation: relative difference per window and zone, how far back, worst rows shown.
DRIFT_TOLERANCE = 0.01
DRIFT_LOOKBACK = timedelta(days=1)
DRIFT_ROWS = 50
DRIFT_SAMPLE = 10

# Checks.
SOURCE_WARN_AFTER = timedelta(hours=26)
SOURCE_ERROR_AFTER = timedelta(hours=48)
FACT_FRESHNESS = timedelta(hours=26)
LIVE_FRESHNESS = timedelta(minutes=15)
MAX_TRIP_MINUTES = 300
MAX_INVALID_PERCENT = 0.1
AVERAGE_FARE = (5, 60)
VOLUME_RUNS = 7
VOLUME_CHANGE_PERCENT = 20.0
