"""Raw logs in two shapes with faulty rows, read into their declared form."""

from __future__ import annotations

from harness.logs import FAULTY, Logs
from harness.registry import query
from rolemart.sources.raw import RAW_LOGS, accepted_shapes, fault_counts, set_apart_shapes

_EVENT = "role_id, event_time, date, part_date"
# The logs' columns in their declared types, as the comparison engine writes them.
_COLUMNS = {
    "base_log": f"{_EVENT}, event_name, zone_id, channel, os, level, vip_level, online_time, zone_id AS alliance_id",
    "payment_log": f"{_EVENT}, event_name, payment_itemid, pay_source, 'JPY' AS currency, money, money_rmb, web_rmb, exchange_rate, level",
    "item_log": f"{_EVENT}, event_name, item_id, item_add, item_cost, item_remain",
    "core_log": "role_id, CASE WHEN CAST(role_id AS BIGINT) % 29 <> 7 THEN event_time END AS event_time, date, part_date, "
    "event_type, reason, free_num, paid_num, core_end",
    "summon_log": f"{_EVENT}, CAST(recruitid AS VARCHAR) AS recruitid, CAST(count AS BIGINT) AS count, is_free, "
    "CAST(currency_id AS VARCHAR) AS currency_id, currency_num",
    "herosnap_log": f"{_EVENT}, zone_id, hero_id, herostar, flag_id, flag_level, flag_star, flag_awake, artifact1_id, "
    "artifact1_level, artifact2_id, artifact2_level",
    "upgraderare_log": f"{_EVENT}, zone_id, CAST(hero AS VARCHAR) AS hero, CAST(fromrare AS VARCHAR) AS fromrare, "
    "CAST(torare AS VARCHAR) AS torare, costchip",
    "upgradehero_log": f"{_EVENT}, zone_id, CAST(hero AS VARCHAR) AS hero, fromlv, tolv",
    "token_log": f"{_EVENT}, event_type, reason, item_id, item_num, item_end",
}
_ODD = "CAST(substr(part_date, 9, 2) AS INTEGER) % 2 = 1"
_REST = "CAST(role_id AS BIGINT) % 29"


def _has_time(name: str) -> str:
    """Core changes need no time, so only one that does not parse is a fault."""
    return f"({_REST} = 7 AND {_ODD})" if name == "core_log" else f"({_REST} = 7)"


def _counts(name: str) -> str:
    number, kind = FAULTY[name], "decimal(32,4)" if name == "payment_log" else "bigint"
    fault = (
        f"CASE WHEN {_REST} = 11 THEN 'no role_id' WHEN {_REST} = 13 AND {_ODD} THEN '{number} is not {kind}' "
        f"WHEN {_REST} = 7 AND {_ODD} THEN 'event_time is not timestamp_ntz' WHEN {_has_time(name)} THEN 'no event_time' END"
    )
    return (
        f"SELECT '{name}' AS log, part_date, fault, count(*) AS row_count "
        f"FROM (SELECT part_date, {fault} AS fault FROM {name}) x WHERE fault IS NOT NULL GROUP BY part_date, fault"
    )


def _register(name: str) -> None:
    sql = (
        f"SELECT {_COLUMNS[name]} FROM {name} "
        f"WHERE {_REST} <> 11 AND NOT {_has_time(name)} AND NOT ({_REST} = 13 AND {_ODD})"
    )

    @query(f"raw_{name}", sql)
    def _(t: Logs):
        rows = accepted_shapes(t.spark, t.raw(name), RAW_LOGS[name])
        return rows.select(*t.raw_columns(name))


for _name in RAW_LOGS:
    _register(_name)


@query("raw_quarantine", " UNION ALL ".join(_counts(name) for name in _COLUMNS))
def _(t: Logs):
    apart = [set_apart_shapes(t.spark, t.raw(name), RAW_LOGS[name]) for name in RAW_LOGS]
    rows = apart[0]
    for more in apart[1:]:
        rows = rows.unionByName(more)
    return fault_counts(rows)
