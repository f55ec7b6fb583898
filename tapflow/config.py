"""Constants of the tap model.

Everything under "Fixed values" must equal the behaviour being reproduced;
the remaining names are tuning knobs of this engine.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (reproduced as-is; changing them changes results)
# ---------------------------------------------------------------------------

# Stops, north to south: (stop_id, latitude, longitude).
STOPS = [
    ("H-A", -6.1375, 106.8135),
    ("H-B", -6.1482, 106.8178),
    ("H-C", -6.1589, 106.8221),
    ("H-D", -6.1696, 106.8264),
    ("H-E", -6.1750, 106.8272),
    ("H-F", -6.1804, 106.8280),
    ("H-G", -6.1934, 106.8230),
    ("H-H", -6.2012, 106.8230),
    ("H-I", -6.2134, 106.8198),
    ("H-J", -6.2256, 106.8162),
]

# Validation patterns and accepted event types.
TRANSACTION_ID_PATTERN = "^[0-9a-fA-F-]{36}$"
CARD_ID_PATTERN = "^[A-Za-z0-9]+$"
BUS_ID_PATTERN = "^BUS-[0-9]+$"
EVENT_TYPES = ("tap_in", "tap_out")

# Reject reason of a payload that cannot be decoded.
UNKNOWN_REASON = "unknown_parse_error"

# Crowding: a vehicle is crowded when strictly more than this many are aboard.
CROWD_THRESHOLD = 15
# Flag message: timestamp, bus, segment, count, threshold.
CROWD_MESSAGE_FORMAT = "[CROWD FLAG] %s ALERT: Bus %s @ %s — %d penumpang aktif (threshold: %d)"
SEGMENT_SEPARATOR = " -> "

# Event-time allowances.
WATERMARK_DELAY = "5 minutes"
PAIRING_TIMEOUT_SECONDS = 2 * 60 * 60
CROWD_IDLE_SECONDS = 60 * 60

# First visits of a vehicle and day shown by the head report.
TIMETABLE_HEAD_STOPS = 21

# Rider rules checked on trips.
MAX_TRIP_MINUTES = 50
MIN_TRANSFER_MINUTES = 5

# Publishing: topic name and partition count keyed by bus_id.
TOPIC_NAME = "bus-cardreader-event"
TOPIC_PARTITIONS = 7

# ---------------------------------------------------------------------------
# Engine knobs
# ---------------------------------------------------------------------------

# Ordered per-key scans (operators/scan.py): a key with at least
# DEFAULT_HOT_KEY_ROWS rows is split into time slices at
# its sampled quantiles, found on a 1-in-N row-hash sample.
DEFAULT_SCAN_BUCKET_SECONDS = 60 * 60
DEFAULT_HOT_KEY_ROWS = 2_000_000
DEFAULT_HOT_KEY_SAMPLE_EVERY = 1000
# Pairing on a stream: buckets of cards, each with one state.  A call holds a
# bucket's rows of a micro-batch and its waiting tap_ins; a checkpoint keeps the number.
DEFAULT_PAIRING_BUCKETS = 512
# Tumbling window for the per-interval crowd flags.
DEFAULT_FLAG_WINDOW = "1 hour"
