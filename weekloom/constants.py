"""Default parameter values. Every operator takes them as arguments."""

# Event dates of the default two-year calendar.
DEFAULT_EVENTS = (
    "2024-03-25",
    "2024-08-15",
    "2024-10-12",
    "2024-11-01",
    "2024-12-25",
    "2025-03-14",
    "2025-08-15",
    "2025-10-02",
    "2025-10-20",
    "2025-12-25",
)

# Segment, base daily level, weekend factor, payday factor.
DEFAULT_SEGMENT_LEVELS = (
    ("Branch", 260000.0, 0.80, 1.25),
    ("Mall", 320000.0, 1.35, 1.15),
    ("Transit_Hub", 420000.0, 1.05, 1.10),
    ("Residential", 150000.0, 1.10, 1.45),
    ("Highway", 110000.0, 1.20, 1.05),
    ("Hospital", 130000.0, 1.00, 1.10),
    ("Rural", 60000.0, 0.95, 1.60),
)

# Calendar rules.
EVENT_DAYS_BEFORE = 3
EVENT_DAYS_AFTER = 1
PAYDAY_LAST_EARLY_DAY = 3
PAYDAY_FIRST_LATE_DAY = 28
EVENT_FACTOR = 1.35
TREND_GROWTH = 0.10
SEASON_DIVISOR = 52
DAYS_PER_WEEK = 7

# Tier names, lowest mean first.
TIERS = ("Low", "Medium", "High")

# Replenishment policy per tier.
TIER_POLICY = (
    ("Low", "weekly plus payday top-up"),
    ("Medium", "every 2-3 days"),
    ("High", "daily monitoring"),
)

# Model settings.
CLASSIFIER_SEED = 7
CLUSTER_SEED = 11
MAX_ITER = 100
FOREST_TREES = 150
FOREST_DEPTH = 8
BOOST_ROUNDS = 60
BOOST_DEPTH = 5
THRESHOLD_ERROR = 0.001
