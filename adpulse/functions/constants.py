"""Fixed values.

These must equal the reference's values for results to match: the domain of
generated impressions, the geo that is filtered out, the sketch precision, the
dashboard's chart order, ceiling and history sizes, the metric target names
and the ingest report step. They are listed plainly and in their natural order.
"""

# Fixed values (domain of an impression)
GEOS = ("NY", "CA", "FL", "CO", "HI", "unknown")
UNKNOWN_GEO = "unknown"
NUM_PUBLISHERS = 5
NUM_ADVERTISERS = 3
NUM_WEBSITES = 10000

# Fixed values (aggregation)
HLL_LG_K = 12  # 2^12 registers, about 1.6 % standard error

# Fixed values (dashboard)
CHART_GEO_ORDER = ("CO", "CA", "FL", "HI", "NY")
CHART_CEILING = 40
CHART_WINDOW_SIZE = 30
CHART_HISTORY = 60
INGEST_REPORT_STEP = 100

# Fixed values (metric targets of the envelope)
TARGET_GEO_IMPS = "geoImpsCounts"
TARGET_GEO_AVG_BIDS = "geoAvgBids"
TARGET_PUB_GEO_COUNT = "pubGeoCount"
TARGET_STORED_COUNT = "mongoCount"
TARGET_RAW_COUNT = "rawCount"
TARGET_FILE_LOGS = "logs"

# The impression message: all seven fields are required.
IMPRESSION_FIELDS = ("timestamp", "publisher", "advertiser", "website", "geo", "bid", "cookie")

# For tables whose bids have at most 8 decimals: sums as this type, and shares
# rounded to so many decimals before they are truncated, do not depend on the
# order in which partitions are merged.
EXACT_BID_TYPE = "decimal(24,8)"
EXACT_SHARE_DIGITS = 6

# Windows scaled for the sparse test tables (1 s -> 1 h, 10 s -> 10 h, same 1:10).
TEST_FINE_WINDOW = "1 hour"
TEST_COARSE_WINDOW = "10 hours"
