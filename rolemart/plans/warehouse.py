"""Stored tables of one game: read raw logs, compute a model for a date window, write it as declared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rolemart.config import TRAILING_DAYS, Game, RunWindow
from rolemart.plans import actives, distribution, holdings, kpi, ledger, snapshots, upstream
from rolemart.plans.state import Checkpoints
from rolemart.session import settle
from rolemart.sources.logs import in_window
from rolemart.sources.lookups import currency_rates, read_dimension
from rolemart.sources.raw import QUARANTINE, RAW_LOGS, accepted_shapes, fault_counts, read_shapes, set_apart_shapes
from rolemart.sources.sinks import file_system, last_partition, overwrite_range, partition_span, read_table, write_table
from rolemart.sources.tables import TABLES, conform


#: Models that keep merged state: the table or log they are merged from, and how.
STATES = {
    "dws_user_info": ("dws_user_daily", upstream.USERS),
    "ads_hero": ("dws_hero_snapshot", holdings.HEROES),
    "ads_flag": ("dws_flag_snapshot", holdings.FLAGS),
    "ads_artifact": ("dws_artifact_snapshot", holdings.ARTIFACTS),
    "ads_hero_upgrade": ("herosnap_log", holdings.FIRST_SEEN),
    "ads_retention_daily": ("dws_user_daily", upstream.ACTIVE_DAYS),
    "dws_token_monthly": ("token_log", None),  # closed months, from two logs; see the ledger
}

#: Models that take over stored rows and so replace more days than those of the window they are computed for.
CONTINUED = ("ads_retention_daily",)


class Warehouse:
    """``<root>/<game>_r`` holds the raw logs, ``<root>/<game>_w`` the tables built from them."""

    def __init__(
        self, spark: SparkSession, root: str, game: Game, *, carry_history: bool = False, latest_items_only: bool = False,
        late_days: bool = False,
    ) -> None:
        """``carry_history`` continues the running number of new users across runs of the daily KPIs;
        ``latest_items_only`` stores one item balance per user instead of one per snapshot day;
        ``late_days`` recomputes the daily KPIs of earlier days whose events arrive in the window, which are left
        out otherwise."""
        self.spark, self.game = spark, game
        self.carry_history, self.latest_items_only, self.late_days = carry_history, latest_items_only, late_days
        self._raw, self._mart = f"{root}/{game.raw_schema}", f"{root}/{game.mart_schema}"

    def path(self, model: str) -> str:
        return f"{self._mart}/{TABLES[model].name}"

    def log(self, name: str, window: RunWindow | None = None) -> DataFrame:
        """A raw log in its declared columns, without the rows that do not parse; of a window, only its partitions are
        looked at. What is not a log, such as rates, comes as it is stored."""
        if name in RAW_LOGS:
            return accepted_shapes(self.spark, self._shapes(name, window), RAW_LOGS[name])
        return self.spark.read.parquet(f"{self._raw}/{name}")

    def _shapes(self, name: str, window: RunWindow | None) -> list[DataFrame]:
        return read_shapes(self.spark, f"{self._raw}/{name}", window)

    def test_accounts(self) -> DataFrame:
        """The uploaded list ``test_accounts.csv``, or the table of that name where there is none."""
        path = f"{self._raw}/test_accounts.csv"
        fs, uploaded = file_system(self.spark, path)
        return read_dimension(self.spark, path, "test_accounts") if fs.exists(uploaded) else self.log("test_accounts")

    def set_apart(self, name: str, window: RunWindow) -> DataFrame:
        """Store the rows of a log's window that do not parse, and return their number per day and fault. A rerun
        replaces its days, so rows that were mended leave the quarantine."""
        rows = set_apart_shapes(self.spark, self._shapes(name, window), RAW_LOGS[name])
        path = f"{self._mart}/{QUARANTINE.name}/{name}"
        overwrite_range(rows, QUARANTINE, path, window)
        return fault_counts(in_window(read_table(self.spark, QUARANTINE, path, may_be_absent=True), window))

    def table(self, model: str, *, may_be_absent: bool = False) -> DataFrame:
        """A built table. Only a model's own history may be absent, on its first run; an absent upstream table is an error."""
        return read_table(self.spark, TABLES[model], self.path(model), may_be_absent=may_be_absent)

    def compute(self, model: str, window: RunWindow) -> DataFrame:
        """The model's rows for the window, in the declared columns, not yet written."""
        return self._rows(model, window, self.written(model, window))

    def _rows(self, model: str, window: RunWindow, written: RunWindow) -> DataFrame:
        return conform(MODELS[model](self, window if model in CONTINUED else written), TABLES[model])

    def refresh(self, model: str, window: RunWindow) -> DataFrame:
        """Compute the model, write it and return the stored table."""
        written = self.written(model, window)  # asked once, so that what is computed and what is replaced agree
        for name, (source, _) in STATES.items():
            if source == model:  # before the rows change: a checkpoint over them must not outlive them
                self.state(name).forget(written.start_date)
        write_table(self._rows(model, window, written), TABLES[model], self.path(model), written)
        return self.table(model)

    def state(self, name: str) -> Checkpoints:
        """Checkpoints of a model that is merged over all days."""
        return Checkpoints(self.spark, f"{self._mart}_state/{name}", STATES[name][1])

    def written(self, model: str, window: RunWindow) -> RunWindow:
        """The partitions a run replaces. A monthly report covers whole months from the earliest event month on that the
        window's rows touch, so an event that arrives late reaches the month it belongs to."""
        if TABLES[model].partition == "part_month":
            return upstream.event_span(self.table("dws_user_daily"), window.whole_months()).whole_months()
        if model == "dws_user_daily_derive":  # running totals and first days of all later rows follow from the window's
            last = last_partition(self.spark, self.path("dws_user_daily"), "part_date")
            return RunWindow(window.start_date, max(window.end_date, last or window.end_date))
        if model in CONTINUED and TABLES[model].incremental:
            spans = [partition_span(self.spark, self.path(m), "part_date") for m in (model, "dws_user_daily")]
            days = [window.start_date, window.end_date, *(day for span in spans if span for day in span)]
            return RunWindow(min(days), max(days))
        if model == "ads_kpi_daily" and self.late_days:
            return upstream.event_span(self.table("dws_user_daily"), window)
        return window


def _snapshot(build, *logs: str) -> Callable[[Warehouse, RunWindow], DataFrame]:
    return lambda wh, w: build(*[wh.log(name, w) for name in ("base_log", *logs)])


def _user_daily(wh: Warehouse, w: RunWindow) -> DataFrame:
    return upstream.user_daily(
        wh.log("base_log", w), wh.log("payment_log", w), wh.test_accounts()
    )


def _merged(name: str, rows: DataFrame, wh: Warehouse, w: RunWindow) -> DataFrame:
    return wh.state(name).advance(rows, w)


def _derive(wh: Warehouse, w: RunWindow) -> DataFrame:
    daily = wh.table("dws_user_daily")
    return upstream.user_daily_derive(in_window(daily, w), wh.state("dws_user_info").before(daily, w.start_date))


def _hero_upgrade(wh: Warehouse, w: RunWindow) -> DataFrame:
    log = wh.log("herosnap_log")
    seen_first = _merged("ads_hero_upgrade", log, wh, w)
    return holdings.hero_upgrade(
        wh.log("upgraderare_log"), log, wh.table("dws_user_daily"), wh.table("dws_user_info"), w.end_date, seen_first=seen_first
    )


def _token_monthly(wh: Warehouse, w: RunWindow) -> DataFrame:
    return ledger.token_monthly_continued(
        wh.log("payment_log"), wh.log("token_log"), currency_rates(wh.log("currency_rate"), wh.game.currency),
        wh.game, w, wh.state("dws_token_monthly"),
    )


def _retention(wh: Warehouse, w: RunWindow) -> DataFrame:
    words = _merged("ads_retention_daily", wh.table("dws_user_daily"), wh, w)
    stored = wh.table("ads_retention_daily", may_be_absent=True)
    # settled, since the write replaces the partitions it is read from
    return settle(upstream.retention_continued(stored, words, wh.table("dws_user_info"), w))


def _kpi_daily(wh: Warehouse, w: RunWindow) -> DataFrame:
    history = wh.table("ads_kpi_daily", may_be_absent=True) if wh.carry_history else None
    return kpi.kpi_daily(
        wh.table("dws_user_daily"), wh.table("dws_user_daily_derive"), wh.table("dws_user_info"),
        w, history, by_event_day=wh.late_days,
    )


def _recent(w: RunWindow) -> RunWindow:
    return RunWindow.trailing(w.end_date, TRAILING_DAYS)


MODELS: dict[str, Callable[[Warehouse, RunWindow], DataFrame]] = {
    "dws_user_daily": _user_daily,
    "dws_user_info": lambda wh, w: upstream.user_info_of(_merged("dws_user_info", wh.table("dws_user_daily"), wh, w)),
    "dws_user_daily_derive": _derive,
    "dws_user_hourly": lambda wh, w: upstream.user_hourly(
        wh.log("base_log", w), wh.log("payment_log", w)
    ),
    "dws_core_snapshot": lambda wh, w: upstream.core_snapshot(wh.log("core_log", w), wh.game),
    "dws_item_snapshot": _snapshot(snapshots.item_snapshot, "item_log"),
    "dws_summon_snapshot": _snapshot(snapshots.summon_snapshot, "summon_log"),
    "dws_hero_snapshot": _snapshot(snapshots.hero_snapshot, "upgraderare_log", "upgradehero_log"),
    "dws_flag_snapshot": _snapshot(snapshots.flag_snapshot, "herosnap_log"),
    "dws_artifact_snapshot": _snapshot(snapshots.artifact_snapshot, "herosnap_log"),
    "dws_token_monthly": _token_monthly,
    "ads_kpi_daily": _kpi_daily,
    "ads_kpi_daily_hf": lambda wh, w: kpi.kpi_daily_intraday(
        wh.table("dws_user_hourly"), wh.table("dws_user_daily_derive"), wh.table("dws_user_info"), _recent(w)
    ),
    "ads_kpi_monthly": lambda wh, w: kpi.kpi_monthly(
        wh.table("dws_user_daily"), wh.table("dws_user_info"), w, wh.table("ads_kpi_monthly", may_be_absent=True)
    ),
    "ads_level_daily": lambda wh, w: distribution.level_daily(wh.table("dws_user_daily"), wh.table("dws_user_info"), w),
    "ads_viplevel_daily": lambda wh, w: distribution.viplevel_daily(
        wh.table("dws_user_daily"), wh.table("dws_user_info"), w
    ),
    "ads_core_daily": lambda wh, w: distribution.core_daily(wh.table("dws_core_snapshot"), wh.table("dws_user_info"), w),
    "ads_item": lambda wh, w: distribution.item_daily(wh.table("dws_item_snapshot"), wh.table("dws_user_info"), w),
    "ads_item_end": lambda wh, w: holdings.item_end(wh.table("dws_item_snapshot"), wh.game, wh.latest_items_only),
    "ads_summon": lambda wh, w: distribution.summon_daily(wh.table("dws_summon_snapshot"), wh.table("dws_user_info"), w),
    "ads_hero": lambda wh, w: _merged("ads_hero", wh.table("dws_hero_snapshot"), wh, w),
    "ads_flag": lambda wh, w: _merged("ads_flag", wh.table("dws_flag_snapshot"), wh, w),
    "ads_artifact": lambda wh, w: _merged("ads_artifact", wh.table("dws_artifact_snapshot"), wh, w),
    "ads_hero_upgrade": _hero_upgrade,
    "ads_active_daily": lambda wh, w: upstream.active_daily(in_window(wh.table("dws_user_daily"), w)),
    "dws_user_number": lambda wh, w: actives.number_users(
        in_window(wh.table("dws_user_daily"), w), wh.table("dws_user_number", may_be_absent=True)
    ),
    "dws_active_bitmap": lambda wh, w: actives.day_bitmaps(in_window(wh.table("dws_user_daily"), w), wh.table("dws_user_number")),
    "ads_core_addreason": lambda wh, w: upstream.core_by_reason(
        in_window(wh.table("dws_core_snapshot"), w), wh.table("dws_user_info"), "coregain_detail", "core_add"
    ),
    "ads_core_costreason": lambda wh, w: upstream.core_by_reason(
        in_window(wh.table("dws_core_snapshot"), w), wh.table("dws_user_info"), "corecost_detail", "core_cost"
    ),
    "ads_retention_daily": _retention,
    "ads_user_retention": lambda wh, w: upstream.user_retention(wh.table("dws_user_daily"), wh.table("dws_user_info")),
    "ads_kpi_hourly_hi": lambda wh, w: upstream.kpi_hourly(
        in_window(wh.table("dws_user_hourly"), w), wh.table("dws_user_info")
    ),
    "ads_kpi_hourly_hf": lambda wh, w: upstream.kpi_hourly_full(wh.table("dws_user_hourly"), wh.table("dws_user_info")),
}
