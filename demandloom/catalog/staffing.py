"""Workforce planning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandloom.catalog.registry import query
from demandloom.catalog.tables import CUBE, PANEL, contacts, panel, table
from demandloom.config import StaffingAssumptions
from demandloom.operators import staffing

OCCUPANCY = StaffingAssumptions(method="occupancy")
ERLANG = StaffingAssumptions()
TEXTBOOK = StaffingAssumptions(formula="erlang_c")

CELL = "timestamp:t channel:s"
PLAN = (
    "volume:i average_handle_time:6 workload:6 productive_agents:0 required_agents:0"
    " occupancy_used:6"
)


def cube(spark, folder):
    return staffing.demand_cube(contacts(spark, folder))


@query("demand_cube", f"{CELL} volume:i average_handle_time:6", f"{CUBE} => SELECT * FROM cube")
def demand_cube(spark, folder):
    return cube(spark, folder)


OCCUPIED = f"""{CUBE},
loads AS (SELECT *, volume * average_handle_time / 3600.0::DOUBLE AS workload FROM cube),
agents AS (SELECT *, ceil(workload / 0.85::DOUBLE) AS productive_agents FROM loads),
plan AS (SELECT *, ceil(productive_agents / (1.0::DOUBLE - 0.30::DOUBLE)) AS required_agents,
                workload / productive_agents AS occupancy_used FROM agents)"""


@query("staffing_occupancy", f"{CELL} {PLAN}", f"{OCCUPIED} => SELECT * FROM plan")
def staffing_occupancy(spark, folder):
    return staffing.staffing_plan(cube(spark, folder), OCCUPANCY)


def _erlang_sql(formula: str) -> str:
    wait = "1 / inverse" if formula == "blocking" else (
        "(n * (1 / inverse)) / (n - workload * (1 - 1 / inverse))"
    )
    return f"""
loads AS (SELECT *, volume * average_handle_time / 3600.0::DOUBLE AS workload FROM demand),
tried AS (SELECT *, unnest(range(greatest(1, CAST(ceil(workload) AS BIGINT) + 1),
                                 CAST(ceil(workload / 0.8) AS BIGINT) + 200)) AS n FROM loads),
chances AS (SELECT *, list_reduce(list_concat([1.0::DOUBLE],
              [x::DOUBLE FOR x IN range(1, n + 1)]),
              lambda acc, k: 1 + acc * k / workload) AS inverse FROM tried),
levels AS (SELECT *, greatest(0, least(1, 1 - ({wait}) * exp(-(n - workload) * 20.0::DOUBLE
                     / average_handle_time))) AS level FROM chances),
met AS (SELECT * EXCLUDE (n, inverse, level), min(n) FILTER (WHERE level >= 0.80) AS sl_agents
        FROM levels GROUP BY ALL),
agents AS (SELECT *, greatest(sl_agents, ceil(workload / 0.85::DOUBLE)) AS productive_agents FROM met),
plan AS (SELECT a.*, ceil(productive_agents / (1.0::DOUBLE - 0.30::DOUBLE)) AS required_agents,
                a.workload / productive_agents AS occupancy_used,
                l.level AS service_level_estimated
         FROM agents a JOIN levels l ON l.timestamp = a.timestamp AND l.channel = a.channel
              AND l.n = a.productive_agents)"""


DEMAND = f"""{CUBE}, demand AS (SELECT timestamp, channel, volume, average_handle_time FROM cube)"""


@query("staffing_erlang", f"{CELL} {PLAN} service_level_estimated:6",
       f"{DEMAND}, {_erlang_sql('blocking')} => SELECT * FROM plan")
def staffing_erlang(spark, folder):
    return staffing.staffing_plan(cube(spark, folder), ERLANG)


@query("staffing_erlang_textbook", f"{CELL} {PLAN} service_level_estimated:6",
       f"{DEMAND}, {_erlang_sql('erlang_c')} => SELECT * FROM plan")
def staffing_erlang_textbook(spark, folder):
    return staffing.staffing_plan(cube(spark, folder), TEXTBOOK)


@query("service_levels", f"{CELL} agents:i wait_probability:6 service_level:6",
       f"""{CUBE}, loads AS (SELECT *, volume * average_handle_time / 3600.0::DOUBLE AS workload,
                                    volume AS agents FROM cube),
       chances AS (SELECT *, list_reduce(list_concat([1.0::DOUBLE],
              [x::DOUBLE FOR x IN range(1, agents + 1)]),
              lambda acc, k: 1 + acc * k / workload) AS inverse FROM loads),
       waits AS (SELECT *, CASE WHEN agents <= workload THEN 1.0 ELSE 1 / inverse END
                   AS wait_probability FROM chances) =>
       SELECT timestamp, channel, agents, wait_probability,
              greatest(0, least(1, 1 - wait_probability * exp(-(agents - workload) * 20.0::DOUBLE
                / average_handle_time))) AS service_level FROM waits""")
def service_levels(spark, folder):
    rows = cube(spark, folder).withColumns(
        {
            "agents": F.col("volume"),
            "workload": staffing.workload(F.col("volume"), F.col("average_handle_time")),
        }
    )
    agents, load, aht = F.col("agents"), F.col("workload"), F.col("average_handle_time")
    return rows.withColumns(
        {
            "wait_probability": staffing.wait_probability(agents, load),
            "service_level": staffing.service_level(agents, load, aht),
        }
    )


@query("staffing_rollup", "channel:s volume:i average_handle_time:6 workload:6 required_agents:0",
       f"""{CUBE}, total AS (SELECT channel, sum(volume) AS volume,
              sum(volume * average_handle_time) / sum(volume) AS average_handle_time
              FROM cube GROUP BY 1),
       loads AS (SELECT *, volume * average_handle_time / 3600.0::DOUBLE AS workload FROM total) =>
       SELECT *, ceil(ceil(workload / 0.85::DOUBLE) / (1.0::DOUBLE - 0.30::DOUBLE))
         AS required_agents FROM loads""")
def staffing_rollup(spark, folder):
    return staffing.staffing_by(cube(spark, folder), ["channel"], OCCUPANCY)


@query("weighted_handle_time", "day:d channel:s volume:i average_handle_time:8",
       f"""{CUBE} => SELECT CAST(timestamp AS DATE) AS day, channel, sum(volume) AS volume,
           sum(volume * average_handle_time) / sum(volume) AS average_handle_time
       FROM cube GROUP BY 1, 2""")
def weighted_handle_time(spark, folder):
    rows = cube(spark, folder).withColumn("day", F.to_date("timestamp"))
    return staffing.weighted_handle_time(rows, ["day", "channel"])


GAPS = f"""{OCCUPIED},
gaps AS (SELECT *, CASE WHEN channel = 'view' THEN required_agents ELSE 2 END AS scheduled_agents,
                required_agents - CASE WHEN channel = 'view' THEN required_agents ELSE 2 END
                  AS staffing_gap FROM plan)"""


def gaps(spark, folder):
    plan = staffing.staffing_plan(cube(spark, folder), OCCUPANCY)
    known = plan.withColumn("scheduled_agents", F.when(F.col("channel") != "view", 2.0))
    return staffing.staffing_gap(known)


@query("staffing_gap",
       f"{CELL} scheduled_agents:0 staffing_gap:0 volume_lower:4 volume_upper:4",
       f"""{GAPS} => SELECT *, greatest(0, volume * 0.9::DOUBLE) AS volume_lower,
       volume * 1.1::DOUBLE AS volume_upper FROM gaps""")
def staffing_gap(spark, folder):
    return staffing.volume_bounds(gaps(spark, folder))


@query("staffing_summary",
       "channel:s total_volume:0 peak_required_agents:0 avg_required_agents:4 max_staffing_gap:0"
       " understaffed_intervals:i",
       f"""{GAPS} => SELECT channel, sum(volume) AS total_volume,
       max(required_agents) AS peak_required_agents, avg(required_agents) AS avg_required_agents,
       max(staffing_gap) AS max_staffing_gap,
       count(*) FILTER (WHERE staffing_gap > 0) AS understaffed_intervals FROM gaps GROUP BY 1""")
def staffing_summary(spark, folder):
    return staffing.staffing_summary(gaps(spark, folder), ["channel"])


@query("sales_to_contacts", "date:d store_id:s volume:i",
       f"""{PANEL} => SELECT date, store_id, greatest(0, round_even(sales / 1000.0::DOUBLE * 2.0, 0))
       AS volume FROM panel""")
def sales_to_contacts(spark, folder):
    return panel(spark, folder).withColumn("volume", staffing.contact_volume(F.col("sales"), 2.0))


@query("sales_staffing", "date:d store_id:s volume:i workload:6 required_agents:0",
       f"""{PANEL}, volumes AS (SELECT date, store_id,
              greatest(0, round_even(sales / 1000.0::DOUBLE * 2.0, 0)) AS volume FROM panel),
       loads AS (SELECT *, volume * 300.0::DOUBLE / 86400.0::DOUBLE AS workload FROM volumes) =>
       SELECT *, ceil(ceil(workload / 0.85::DOUBLE) / (1.0::DOUBLE - 0.30::DOUBLE))
         AS required_agents FROM loads""")
def sales_staffing(spark, folder):
    rows = panel(spark, folder).select(
        "date",
        "store_id",
        staffing.contact_volume(F.col("sales"), 2.0).alias("volume"),
        F.lit(300.0).alias("average_handle_time"),
    )
    daily = StaffingAssumptions(method="occupancy", interval_seconds=86_400)
    return staffing.staffing_plan(rows, daily)


@query("channel_staffing_large",
       "o_orderpriority:s volume:i workload:4 productive_agents:0 required_agents:0",
       f"""demand AS (SELECT TIMESTAMP '2024-01-01' AS timestamp, o_orderpriority AS channel,
                             count(*) AS volume, 300.0::DOUBLE AS average_handle_time
                      FROM orders GROUP BY 2), {_erlang_sql('blocking')} =>
       SELECT channel AS o_orderpriority, volume, workload, productive_agents, required_agents
       FROM plan""")
def channel_staffing_large(spark, folder):
    rows = table(spark, folder, "orders").groupBy("o_orderpriority").agg(
        F.count("*").alias("volume"), F.lit(300.0).alias("average_handle_time")
    )
    return staffing.staffing_plan(rows, ERLANG)
