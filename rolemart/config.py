"""Per-game settings and the date window of a run."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

# Identifiers and amounts found in the game logs; results depend on them.
TOKEN_PACKS = (
    ("gold_100001", 660),
    ("gold_100002", 320),
    ("gold_100003", 120),
    ("gold_100004", 60),
    ("gold_100005", 32),
    ("gold_100006", 4),
)
CURRENCY = "JPY"
WEB_PAY_SOURCE = "web"
TOKEN_ITEM_ID = "2"
EXCLUDED_REASON = "638"
LEDGER_START = "2024-05-01"
TRACKED_ITEMS = ("13000", "14000")
TRAILING_DAYS = 15
CHECK_DAYS = 30
LEVEL_BUCKET = 5
BULK_DRAW = 10
#: Events whose date lies further before their partition day are no late arrivals but wrong clocks.
MAX_LATE_DAYS = 62


@dataclass(frozen=True)
class Game:
    """What differs between two games that share the models."""

    name: str
    currency: str = CURRENCY
    web_pay_source: str = WEB_PAY_SOURCE
    token_item_id: str = TOKEN_ITEM_ID
    excluded_reason: str = EXCLUDED_REASON
    ledger_start: str = LEDGER_START
    tracked_items: tuple[str, str] = TRACKED_ITEMS
    token_packs: tuple[tuple[str, int], ...] = field(default=TOKEN_PACKS)

    @property
    def raw_schema(self) -> str:
        return f"{self.name}_r"

    @property
    def mart_schema(self) -> str:
        return f"{self.name}_w"


@dataclass(frozen=True)
class RunWindow:
    """Inclusive day range of a run, as the ``yyyy-MM-dd`` text used for partitions."""

    start_date: str
    end_date: str

    def __post_init__(self) -> None:
        if date.fromisoformat(self.start_date) > date.fromisoformat(self.end_date):
            raise ValueError(f"start {self.start_date} is after end {self.end_date}")

    @property
    def start_month(self) -> str:
        return self.start_date[:8] + "01"

    @property
    def end_month(self) -> str:
        return self.end_date[:8] + "01"

    def whole_months(self) -> RunWindow:
        """The same window widened to full calendar months."""
        nxt = (date.fromisoformat(self.end_month) + timedelta(days=31)).replace(day=1)
        return RunWindow(self.start_month, (nxt - timedelta(days=1)).isoformat())

    @classmethod
    def trailing(cls, end_date: str, days: int = TRAILING_DAYS) -> RunWindow:
        """``days`` days before ``end_date`` up to and including it."""
        return cls((date.fromisoformat(end_date) - timedelta(days=days)).isoformat(), end_date)
