"""Raw game logs mapped onto the driver's tables (Spark side of the rules in FIXTURES.md)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from rolemart.config import Game, RunWindow
from rolemart.plans import kpi, snapshots, upstream
from rolemart.sources.lookups import currency_rates, token_price_list

GAME = Game("sample", ledger_start="1995-01-01")
LEDGER_AS_OF = "2001-08-31"
DAYS = RunWindow("2024-01-01", "2024-01-31")
LAST_DAY = "2024-01-30"
CHECK_DAY = "2024-01-31"
CHECK_MOMENT = "2024-01-30 15:30:00"
MONTHS = RunWindow("1995-01-01", "2001-08-31")


# Column types of the driver's tables in use; declared, so that no job has to look them up.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


#: The number column of each raw log in which some rows of odd days have no number.
FAULTY = {
    "base_log": "level", "payment_log": "money", "item_log": "item_remain", "core_log": "free_num",
    "summon_log": "currency_num", "herosnap_log": "flag_level", "upgraderare_log": "costchip", "upgradehero_log": "tolv",
    "token_log": "item_num",
}


class Logs:
    """Logs, lookups and user-level summaries of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, table: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[table]).parquet(f"{self.sf_dir}/{table}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        """Columns all event logs share."""
        number = F.get_json_object("props", "$.k").cast("int")
        return self.read("events").select(
            "event_id",
            F.col("user_id").cast("string").alias("role_id"),
            F.col("ts").alias("event_time"),
            F.to_date("ts").alias("date"),
            F.to_date("ts").cast("string").alias("part_date"),
            F.col("event_type").alias("event_name"),
            F.expr("cast(user_id % 25 as string)").alias("zone_id"),
            F.expr("case when user_id % 6 <> 0 then concat('ch', user_id % 6) end").alias("channel"),
            F.expr("case when user_id % 2 = 0 then 'ios' else 'android' end").alias("os"),
            number.alias("k"),
            "value",
            F.floor("value").cast("bigint").alias("whole"),
        )

    @cached_property
    def late_events(self) -> DataFrame:
        """The same events, some of which reach the partition of the next day."""
        arrived = F.when(F.col("k") == 97, F.date_add("date", 1)).otherwise(F.col("date"))
        return self.events.withColumn("part_date", arrived.cast("string"))

    def _base(self, events: DataFrame) -> DataFrame:
        return events.select(
            "role_id", "event_time", "date", "part_date", "event_name", "zone_id", "channel", "os",
            F.expr("cast(k + 1 as bigint)").alias("level"),
            F.expr("cast(k div 10 as bigint)").alias("vip_level"),
            F.col("whole").alias("online_time"),
        )

    @cached_property
    def base_log(self) -> DataFrame:
        return self._base(self.events)

    @cached_property
    def base_log_late(self) -> DataFrame:
        return self._base(self.late_events)

    @cached_property
    def payment_log(self) -> DataFrame:
        return self._payments(self.events)

    @cached_property
    def payment_log_late(self) -> DataFrame:
        return self._payments(self.late_events)

    def _payments(self, events: DataFrame) -> DataFrame:
        money = F.col("value").cast("decimal(32,4)")
        home = (money * F.lit("0.05").cast("decimal(3,2)")).cast("decimal(32,4)")
        return events.where(F.col("event_name") == "purchase").select(
            "role_id", "event_time", "date", "part_date", "event_name",
            F.expr("concat('gold_10000', 1 + k % 6)").alias("payment_itemid"),
            F.expr("case when k % 3 = 0 then 'web' else 'app' end").alias("pay_source"),
            F.lit("JPY").alias("currency"),
            money.alias("money"),
            home.alias("money_rmb"),
            F.when(F.expr("k % 3 = 0"), home).alias("web_rmb"),
            F.lit("0.05").cast("decimal(12,6)").alias("exchange_rate"),
            F.expr("cast(k + 1 as bigint)").alias("level"),
        )

    @cached_property
    def item_log(self) -> DataFrame:
        added = F.col("event_name") == "click"
        return self.late_events.where(F.col("event_name").isin("click", "view")).select(
            "role_id", "event_time", "date", "part_date",
            F.when(added, "AddItem").otherwise("CostItem").alias("event_name"),
            F.expr("case when k = 1 then '135' else cast(12990 + 15 * k as string) end").alias("item_id"),
            F.when(added, F.col("whole")).alias("item_add"),
            F.when(~added, F.col("whole")).alias("item_cost"),
            F.when(F.expr("k % 7 <> 0"), F.col("whole")).alias("item_remain"),
        )

    @cached_property
    def core_log(self) -> DataFrame:
        return self.events.where(F.col("event_name").isin("click", "view")).select(
            "role_id", "event_time", "date", "part_date",
            F.when(F.col("event_name") == "click", "gain").otherwise("cost").alias("event_type"),
            F.expr("case when k = 63 then '638' else cast(k % 10 as string) end").alias("reason"),
            F.col("whole").alias("free_num"),
            F.expr("case when k % 3 <> 0 then cast(k as bigint) end").alias("paid_num"),
            F.expr("case when k % 7 <> 0 then cast(k * 10 as bigint) end").alias("core_end"),
        )

    @cached_property
    def summon_log(self) -> DataFrame:
        return self.late_events.where(F.col("event_name") == "purchase").select(
            "role_id", "event_time", "date", "part_date",
            F.expr("k % 5").alias("recruitid"),
            F.expr("cast(case when k % 2 = 0 then 10 else 1 end as bigint)").alias("count"),
            F.expr("case when k % 3 = 0 then 1 else 0 end").alias("is_free"),
            F.expr("k % 4").alias("currency_id"),
            F.col("whole").alias("currency_num"),
        )

    @cached_property
    def herosnap_log(self) -> DataFrame:
        picks = {
            "hero_id": "k % 20", "herostar": "k % 6", "flag_id": "k % 8", "flag_level": "k", "flag_star": "k % 5",
            "flag_awake": "k % 3", "artifact1_id": "k % 4", "artifact1_level": "k", "artifact2_id": "k % 3",
            "artifact2_level": "k + 1",
        }
        return self.late_events.select(
            "role_id", "event_time", "date", "part_date", "zone_id",
            *[F.expr(f"cast({rule} as bigint)").alias(name) for name, rule in picks.items()],
        )

    @cached_property
    def upgraderare_log(self) -> DataFrame:
        return self.late_events.where(F.col("event_name") == "error").select(
            "role_id", "event_time", "date", "part_date", "zone_id",
            F.expr("k % 20").alias("hero"),
            F.expr("100 + k % 9").alias("fromrare"),
            F.expr("101 + k % 9").alias("torare"),
            F.col("whole").alias("costchip"),
        )

    @cached_property
    def upgradehero_log(self) -> DataFrame:
        return self.late_events.where(F.col("event_name") == "signup").select(
            "role_id", "event_time", "date", "part_date", "zone_id",
            F.expr("k % 20").alias("hero"),
            F.expr("cast(k as bigint)").alias("fromlv"),
            F.expr("cast(k + 1 as bigint)").alias("tolv"),
        )

    def raw(self, name: str) -> list[DataFrame]:
        """A log as two versions of a game write it, with faulty rows (rules in FIXTURES.md).

        Odd days: all text, blank for a number that is absent, no ``date``. Even days: whole numbers as floating ones,
        ids as whole numbers.
        """
        log = getattr(self, name)
        if name == "base_log":
            log = log.withColumn("guild_id", F.col("zone_id"))
        rest, odd = F.expr("cast(role_id as bigint) % 29"), F.expr("cast(substr(part_date, 9, 2) as int) % 2 = 1")
        types = dict(log.dtypes)
        text = {c: F.col(c).cast("string") for c in log.columns if c != "date"}
        for c, kind in types.items():
            if kind in ("int", "bigint") or kind.startswith("decimal"):
                text[c] = F.coalesce(text[c], F.lit(" "))
        text["role_id"] = F.when(rest != 11, text["role_id"])
        text["event_time"] = F.when(rest != 7, text["event_time"]).otherwise(F.lit("no time"))
        text[FAULTY[name]] = F.when(rest != 13, text[FAULTY[name]]).otherwise(F.lit("n/a"))
        typed = {c: F.col(c).cast("double") if kind in ("int", "bigint") and not c.endswith("id") and c not in ("hero", "fromrare", "torare") else F.col(c)
                 for c, kind in types.items()}
        typed["role_id"] = F.when(rest != 11, F.col("role_id").cast("bigint"))
        typed["event_time"] = F.when(rest != 7, F.col("event_time"))
        if "guild_id" in typed:
            typed["alliance_id"] = typed.pop("guild_id")
        return [
            log.where(odd).select(*[v.alias(c) for c, v in text.items()]),
            log.where(~odd).select(*[v.alias(c) for c, v in typed.items()]),
        ]

    def raw_columns(self, name: str) -> list[str]:
        return [*getattr(self, name).columns, *(["alliance_id"] if name == "base_log" else [])]

    @cached_property
    def accounts(self) -> DataFrame:
        return self.read("customer").select(F.col("c_custkey").cast("string").alias("role_id"), "c_acctbal")

    @cached_property
    def test_accounts(self) -> DataFrame:
        return self.accounts.where("c_acctbal >= 9000").select("role_id")

    @cached_property
    def closed_accounts(self) -> DataFrame:
        return self.accounts.where("c_acctbal < -500").select("role_id")

    # user-level summaries

    @cached_property
    def daily(self) -> DataFrame:
        return upstream.user_daily(self.base_log, self.payment_log, self.test_accounts)

    @cached_property
    def all_info(self) -> DataFrame:
        return upstream.user_info(self.daily)

    @cached_property
    def info(self) -> DataFrame:
        """User attributes without closed accounts, so that some users of the logs have none."""
        return self.all_info.join(self.closed_accounts, "role_id", "left_anti")

    @cached_property
    def derive(self) -> DataFrame:
        return upstream.user_daily_derive(self.daily)

    @cached_property
    def daily_late(self) -> DataFrame:
        return upstream.user_daily(self.base_log_late, self.payment_log_late, self.test_accounts)

    @cached_property
    def info_late(self) -> DataFrame:
        return upstream.user_info(self.daily_late).join(self.closed_accounts, "role_id", "left_anti")

    @cached_property
    def hourly(self) -> DataFrame:
        return upstream.user_hourly(self.base_log, self.payment_log)

    @cached_property
    def core(self) -> DataFrame:
        return upstream.core_snapshot(self.core_log, GAME)

    @cached_property
    def items(self) -> DataFrame:
        return snapshots.item_snapshot(self.base_log_late, self.item_log)

    @cached_property
    def draws(self) -> DataFrame:
        return snapshots.summon_snapshot(self.base_log_late, self.summon_log)

    @cached_property
    def heroes(self) -> DataFrame:
        return snapshots.hero_snapshot(self.base_log_late, self.upgraderare_log, self.upgradehero_log)

    @cached_property
    def flags(self) -> DataFrame:
        return snapshots.flag_snapshot(self.base_log_late, self.herosnap_log)

    @cached_property
    def artifacts(self) -> DataFrame:
        return snapshots.artifact_snapshot(self.base_log_late, self.herosnap_log)

    @cached_property
    def kpi(self) -> DataFrame:
        return kpi.kpi_daily(self.daily, self.derive, self.all_info, DAYS)

    @cached_property
    def kpi_hourly(self) -> DataFrame:
        return upstream.kpi_hourly(self.hourly, self.all_info)

    # years of payments and token changes

    @cached_property
    def order_payments(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_custkey").cast("string").alias("role_id"),
            F.col("o_orderdate").alias("event_time"),
            F.to_date("o_orderdate").alias("date"),
            F.to_date("o_orderdate").cast("string").alias("part_date"),
            F.expr(
                "case o_orderstatus when 'F' then concat('pkg;', o_orderkey % 500) "
                "when 'O' then concat('gold_10000', 1 + o_orderkey % 6) else 'other' end"
            ).alias("payment_itemid"),
            F.expr("case when o_orderstatus = 'F' then 'web' else 'app' end").alias("pay_source"),
            F.lit("JPY").alias("currency"),
            F.col("o_totalprice").cast("decimal(32,4)").alias("money"),
            F.expr("cast(o_orderkey % 60 as bigint)").alias("level"),
            F.expr("cast(o_orderkey % 9 as bigint)").alias("vip_level"),
            F.expr("cast(o_custkey % 25 as string)").alias("zone_id"),
            F.expr("case when o_custkey % 6 <> 0 then concat('ch', o_custkey % 6) end").alias("channel"),
            F.expr("case when o_custkey % 2 = 0 then 'ios' else 'android' end").alias("os"),
        )

    @cached_property
    def token_log(self) -> DataFrame:
        orders = self.read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        lines = self.read("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"
        )
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").cast("string").alias("role_id"),
            F.col("o_orderdate").alias("event_time"),
            F.to_date("o_orderdate").alias("date"),
            F.to_date("o_orderdate").cast("string").alias("part_date"),
            F.expr("case when l_returnflag in ('A', 'R') then 'gain' else 'cost' end").alias("event_type"),
            F.expr("case when l_suppkey % 10 = 0 then '638' else cast(l_suppkey % 10 as string) end").alias("reason"),
            F.expr("case when l_partkey % 2 = 0 then '2' else '1' end").alias("item_id"),
            F.expr("cast(l_quantity as bigint)").alias("item_num"),
            F.expr("case when l_linenumber <> 7 then l_partkey end").alias("item_end"),
        )

    @cached_property
    def rates(self) -> DataFrame:
        """Monthly rates of two currencies over the months of the payments."""
        months = self.read("orders").agg(
            F.expr("sequence(trunc(min(o_orderdate), 'month'), trunc(max(o_orderdate), 'month'), interval 1 month)").alias("m")
        )
        return months.select(F.posexplode("m").alias("n", "month")).select(
            F.explode(F.array(F.lit("JPY"), F.lit("USD"))).alias("currency"),
            F.substring(F.col("month").cast("string"), 1, 7).alias("currency_time"),
            F.expr("cast(4.80 + 0.01 * n as decimal(12,6))").alias("rate"),
        )

    @cached_property
    def home_rates(self) -> DataFrame:
        return currency_rates(self.rates, GAME.currency)

    @cached_property
    def prices(self) -> DataFrame:
        return token_price_list(self.spark, GAME)

    @cached_property
    def order_daily(self) -> DataFrame:
        home = (F.col("money") * F.lit("0.05").cast("decimal(3,2)")).cast("decimal(32,4)")
        paid = self.order_payments.withColumns(
            {"money_rmb": home, "web_rmb": F.when(F.col("pay_source") == "web", home),
             "exchange_rate": F.lit("0.05").cast("decimal(12,6)"), "online_time": F.lit(1).cast("bigint")}
        )
        return upstream.user_daily(paid, paid, self.test_accounts)

    @cached_property
    def order_info(self) -> DataFrame:
        return upstream.user_info(self.order_daily).join(self.closed_accounts, "role_id", "left_anti")
