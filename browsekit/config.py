"""Run parameters of the browse-reminder jobs.

Everything a job needs to know that is not data lives here, so the same
code runs the fixtures (fixed run time) and a production schedule (run
time passed in by the scheduler).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta

# ---------------------------------------------------------------------------
# These must equal the reference behaviour for equal results.
# ---------------------------------------------------------------------------
SEND_THRESHOLD = 0.5            # send-model probability at or above -> send
SIZE_THRESHOLD = 0.7            # share of a colour's SKUs in stock for leads
FRACTION_SEND = 0.45            # share of below-threshold users sampled in
INVENTORY_MIN = 1               # stock level that counts as "in stock"
RESEND_BLOCK_HOURS = 8          # no second mail within this many hours
DEPLOYMENT_THRESHOLD = 0.9      # rollout share of the sha224 hash space
MAX_SEQUENCE_LENGTH = 10        # items per sequence chunk
SEQUENCE_STEP = 10              # step between chunk ends
MIN_SHOE_UNITS = 3              # loyal shopper: strictly more shoe rows
SESSION_SAMPLE_MIN = 4          # sessions per user before sampling a share
SESSION_SAMPLE_FRACTION = 0.25  # share of sessions sampled into test
FILL_LIFETIME_ORDERS = 0        # users without orders
FILL_DAYS_SINCE_LAST_ORDER = 100
CATEGORIES_TO_SEND = ("moccasins", "pumps", "womens_pumps", "mens-sneakers")
SEND_WINDOW = timedelta(days=5, hours=2)   # send features look back this far
WINDOW_LAG = timedelta(hours=2)            # every window ends this long before the run
RECENCY_GATE = timedelta(hours=9)          # last view at or after last_run - 9 h
SEQUENCE_LOOKBACK = timedelta(hours=9)     # sequences start at last_run - 9 h
SEND_FEATURES = (
    "time_since_browse", "cgid_count", "pdp_count", "count",
    "lifetime_orders", "days_since_last_order",
)
# ---------------------------------------------------------------------------

# Fixture parameters (FIXTURES.md): the driver tables carry no real click
# stream, so the hosts and run times below are the ones the derived views use.
HOSTS = ("shop.example", "www.shop.example")
RUN = datetime(2024, 1, 30, 12, 0, 0)
LAST_RUN = datetime(2024, 1, 30, 11, 0, 0)
TRAIN_START = datetime(2024, 1, 2, 0, 0, 0)
TRAIN_START_SHORT = datetime(2024, 1, 29, 0, 0, 0)
INVENTORY_EVENT_TYPE = "inventory.publish"
SAMPLE_SEED = "browse"
FEATURE_NAME = "reminders"      # name of this job in the run log
EVENT_NAME = "reminder"         # event the outbox asks the mailer to send

# Logistic send model stand-in: (feature, mean, scale, weight), plus bias.
# The trained model is not part of the reference; these are our parameters.
SEND_PARAMS = (
    ("time_since_browse", 150000.0, 120000.0, -0.8),
    ("cgid_count", 2.0, 2.0, 0.3),
    ("pdp_count", 4.0, 3.0, 0.5),
    ("count", 6.0, 4.0, 0.2),
    ("lifetime_orders", 10.0, 6.0, 0.4),
    ("days_since_last_order", 1500.0, 800.0, -0.3),
)
SEND_BIAS = 0.1

# Affinity smoothing: P(i|j) = (c_ji + a*pop_i) / (c_j + a)
AFFINITY_ALPHA = 1.0

# Category page -> stand-in product (the table the reference reads).
CATEGORY_PAGE_PRODUCTS = (
    ("moccasins", "0000001_01"),
    ("pumps", "0000002_02"),
    ("sandals", "0000003_01"),
)


def ms(ts: datetime) -> int:
    """Epoch milliseconds of a naive UTC datetime."""
    return int((ts - datetime(1970, 1, 1)) / timedelta(milliseconds=1))


@dataclass(frozen=True)
class RunWindow:
    """The time bounds one hourly run works with, as epoch milliseconds.

    Bounds are computed on the driver once so they reach Spark as literals
    (constant folded, pushed into the scan).
    """

    run: datetime = RUN
    last_run: datetime = LAST_RUN
    hosts: tuple[str, ...] = field(default=HOSTS)

    @property
    def send_lo(self) -> int:
        return ms(self.run - SEND_WINDOW)

    @property
    def send_hi(self) -> int:
        return ms(self.run - WINDOW_LAG)

    @property
    def recency_lo(self) -> int:
        return ms(self.last_run - RECENCY_GATE)

    @property
    def seq_lo(self) -> int:
        return ms(self.last_run - SEQUENCE_LOOKBACK)

    @property
    def seq_hi(self) -> int:
        return ms(self.run - WINDOW_LAG)

    @property
    def run_ms(self) -> int:
        return ms(self.run)

    @property
    def run_text(self) -> str:
        return self.run.strftime("%Y-%m-%d %H:%M:%S")

    @property
    def resend_lo(self) -> datetime:
        return self.run - timedelta(hours=RESEND_BLOCK_HOURS)
