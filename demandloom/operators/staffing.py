"""Workforce planning: workload, wait probability, agents, shrinkage, gaps, roll-ups."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.config import StaffingAssumptions

DEFAULTS = StaffingAssumptions()


def workload(volume: Column, handle_time: Column, interval_seconds: int = 3600) -> Column:
    """Offered load in agents: contacts x seconds / interval."""
    return volume * handle_time / F.lit(float(interval_seconds))


#: Gauss-Legendre points per integral; the integrand is close to a Gaussian, so 32 leave about 1e-11.
POINTS = 32


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _inverse_blocking(agents: Column, load: Column) -> tuple[Column, Column]:
    """``(s, i)`` with ``1 / blocking = exp(s) i``, for more agents than load and load above 0.

    The inverse is the integral of ``(v / load)^agents exp(load - v)`` over ``v >= load``. Its
    logarithm peaks at ``v = agents``, where ``s`` is taken out, and falls by more than 36 within
    the limits below. The work is the same for any number of agents, and nothing overflows.
    """
    low = F.greatest(load, agents - 9 * F.sqrt(agents)) - agents
    high = 12 + F.sqrt(144 + 72 * agents)
    knots, weights = np.polynomial.legendre.leggauss(POINTS)
    points = F.array(
        *[F.struct(F.lit(float(1 + x)).alias("x"), F.lit(float(w)).alias("w")) for x, w in zip(knots, weights)]
    )

    def integral(span: Column) -> Column:
        def add(total: Column, point: Column) -> Column:
            height = _bound(
                span["low"] + span["half"] * point["x"],
                lambda beyond: F.exp(span["n"] * F.log1p(beyond / span["n"]) - beyond),
            )
            return total + point["w"] * height

        return span["half"] * F.aggregate(points, F.lit(0.0), add)

    peak = agents * F.log1p((agents - load) / load) - (agents - load)
    span = F.struct(low.alias("low"), ((high - low) / 2).alias("half"), agents.alias("n"))
    return peak, _bound(span, integral)


def wait_probability(agents: Column, load: Column, formula: str = "blocking") -> Column:
    """Probability that a contact waits, for ``agents`` on an offered ``load``.

    1 where the agents do not exceed the load, 0 without load; null where one of both is null.
    """
    n = agents.cast("double")
    peak, integral = _inverse_blocking(n, load)
    blocked = F.exp(-peak) / integral
    if formula == "erlang_c":
        blocked = 1 / (1 + (n - load) / n * (F.exp(peak) * integral - 1))
    return (
        F.when((n <= 0) | (n <= load), 1.0)
        .when(load == 0, 0.0)
        .when(n.isNotNull() & load.isNotNull(), F.least(F.lit(1.0), blocked))
    )


def service_level(
    agents: Column,
    load: Column,
    handle_time: Column,
    answer_time_seconds: float = 20.0,
    formula: str = "blocking",
) -> Column:
    """Share of contacts answered in time, within [0, 1]; null where an input is null."""
    decay = F.exp(
        -(agents - load) * answer_time_seconds / F.greatest(handle_time, F.lit(1e-6))
    )
    level = 1 - wait_probability(agents, load, formula) * decay
    known = agents.isNotNull() & load.isNotNull() & handle_time.isNotNull()
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), level))
    return F.when(agents <= 0, 0.0).when(known, bounded)


def with_shrinkage(productive: Column, shrinkage: float) -> Column:
    if not 0 <= shrinkage < 1:
        raise ValueError("shrinkage must be in [0, 1)")
    return productive / F.lit(1.0 - shrinkage)


def agents_for_level(load: Column, handle_time: Column, cfg: StaffingAssumptions = DEFAULTS) -> Column:
    """Fewest agents above the load that meet the service level, or ``cfg.max_agents`` if fewer.

    The level grows with the agents, so halving finds them. The bracket ends where the waiting
    time alone, or the blocking term alone (below 1e-25), meets any target, whichever is nearer:
    its width grows with the root of the load at most. Null for a load that is null, not above 0
    or not finite.
    """
    first = F.greatest(F.lit(1.0), F.ceil(load).cast("double") + 1)
    last = load + 61 + F.sqrt(3600 + 120 * load)
    if cfg.answer_time_seconds > 0 and cfg.service_level_target < 1:
        patience = -math.log(1 - cfg.service_level_target) / cfg.answer_time_seconds
        last = F.least(last, load + handle_time * patience)
    last = F.greatest(first, F.ceil(last).cast("double") + 1)

    def halve(bracket: Column, _: Column) -> Column:
        middle = F.floor((bracket["low"] + bracket["high"]) / 2).cast("double")

        def half(n: Column) -> Column:
            level = service_level(n, load, handle_time, cfg.answer_time_seconds, cfg.formula)
            return F.when(
                level >= cfg.service_level_target,
                F.struct(bracket["low"].alias("low"), n.alias("high")),
            ).otherwise(F.struct((n + 1).alias("low"), bracket["high"].alias("high")))

        return F.when(bracket["low"] >= bracket["high"], bracket).otherwise(_bound(middle, half))

    halvings = F.sequence(F.lit(0), F.ceil(F.log2(last - first + 1)).cast("int"))
    start = F.struct(first.alias("low"), last.alias("high"))
    found = F.aggregate(halvings, start, halve, lambda bracket: bracket["high"])
    usable = (load > 0) & (load < F.lit(float("inf")))
    return F.when(usable, F.least(found, F.lit(float(cfg.max_agents))))


def staffing_plan(
    demand: DataFrame,
    cfg: StaffingAssumptions = DEFAULTS,
    volume: str = "volume",
    handle_time: str = "average_handle_time",
) -> DataFrame:
    """Append workload, agents, occupancy, service level and the settings used.

    Negative volumes and handle times count as 0. A workload that is not finite has no plan: null
    agents.
    """
    for column in (volume, handle_time):
        if column not in demand.columns:
            raise KeyError(f"Missing column: {column}")
    zero = F.lit(0.0)
    vol = F.greatest(zero, F.col(volume).cast("double"))
    aht = F.greatest(zero, F.col(handle_time).cast("double"))
    out = demand.withColumn("workload", workload(vol, aht, cfg.interval_seconds))
    idle = F.col("workload") <= 0
    empty = F.when(vol == 0, 1.0).otherwise(0.0)
    if cfg.method == "occupancy":
        productive = F.ceil(F.col("workload") / cfg.occupancy_target).cast("double")
        level = F.when(idle, empty)
    else:
        floor = F.ceil(F.col("workload") / cfg.occupancy_target).cast("double")
        productive = F.when(
            F.col("workload") < F.lit(float("inf")),
            F.greatest(agents_for_level(F.col("workload"), aht, cfg), floor),
        )
        reached = service_level(
            F.col("productive_agents"), F.col("workload"), aht, cfg.answer_time_seconds, cfg.formula
        )
        level = F.when(idle, empty).otherwise(reached)
    out = out.withColumn("productive_agents", F.when(idle, 0.0).otherwise(productive))
    busy = F.col("productive_agents") > 0
    return out.withColumns(
        {
            "required_agents": F.ceil(
                with_shrinkage(F.col("productive_agents"), cfg.shrinkage)
            ).cast("double"),
            "occupancy_used": F.when(busy, F.col("workload") / F.col("productive_agents")).otherwise(0.0),
            "service_level_estimated": level,
            "staffing_method": F.lit(cfg.method),
            "shrinkage": F.lit(cfg.shrinkage),
            "occupancy_target": F.lit(cfg.occupancy_target),
        }
    )


def weighted_handle_time(
    demand: DataFrame,
    by: Sequence[str] = (),
    volume: str = "volume",
    handle_time: str = "average_handle_time",
) -> DataFrame:
    """Total volume and volume-weighted handle time per group; null keys form a group."""
    total = F.coalesce(F.sum(F.col(volume).cast("double")), F.lit(0.0))
    weighted = F.sum(F.col(volume) * F.col(handle_time)) / F.sum(volume)
    return demand.groupBy(*by).agg(
        total.alias(volume),
        F.when(total > 0, weighted).otherwise(F.avg(handle_time)).alias(handle_time),
    )


def staffing_by(
    demand: DataFrame,
    by: Sequence[str],
    cfg: StaffingAssumptions = DEFAULTS,
    volume: str = "volume",
    handle_time: str = "average_handle_time",
) -> DataFrame:
    """Staff each group as one interval of ``cfg.interval_seconds``."""
    grouped = weighted_handle_time(demand, by, volume, handle_time)
    return staffing_plan(grouped, cfg, volume, handle_time)


def staffing_gap(plan: DataFrame, scheduled: float | None = None) -> DataFrame:
    """Required minus scheduled agents; an unknown schedule counts as the requirement."""
    if scheduled:
        value = F.lit(float(scheduled))
    elif "scheduled_agents" in plan.columns:
        value = F.coalesce(F.col("scheduled_agents").cast("double"), F.col("required_agents"))
    else:
        value = F.col("required_agents")
    return plan.withColumn("scheduled_agents", value).withColumn(
        "staffing_gap", F.col("required_agents") - F.col("scheduled_agents")
    )


def volume_bounds(plan: DataFrame, volume: str = "volume") -> DataFrame:
    """Forecast bounds of the volume; 10% either way where the forecast gives none."""
    if "forecast_lower" in plan.columns:
        low, high = F.col("forecast_lower"), F.col("forecast_upper")
    else:
        low = F.greatest(F.lit(0.0), F.col(volume) * 0.9)
        high = F.col(volume) * 1.1
    return plan.withColumns({"volume_lower": low, "volume_upper": high})


def staffing_summary(plan: DataFrame, by: Sequence[str] = (), volume: str = "volume") -> DataFrame:
    return plan.groupBy(*by).agg(
        F.sum(F.col(volume).cast("double")).alias("total_volume"),
        F.max("required_agents").alias("peak_required_agents"),
        F.avg("required_agents").alias("avg_required_agents"),
        F.max("staffing_gap").alias("max_staffing_gap"),
        F.count_if(F.col("staffing_gap") > 0).alias("understaffed_intervals"),
    )


def contact_volume(sales: Column, contacts_per_thousand: float) -> Column:
    """Contacts expected from sales, rounded half to even and floored at 0."""
    return F.greatest(F.lit(0.0), F.bround(sales / 1000.0 * contacts_per_thousand)).cast("long")


def demand_cube(
    contacts: DataFrame,
    time: str = "timestamp",
    by: Sequence[str] = ("channel",),
    handle_time: str = "handle_time",
    interval: str = "1 hour",
) -> DataFrame:
    """Volume and mean handle time per interval; works on batch and streaming input."""
    bucket = F.window(time, interval)
    return (
        contacts.groupBy(bucket.alias("__w"), *by)
        .agg(F.count(F.lit(1)).alias("volume"), F.avg(handle_time).alias("average_handle_time"))
        .select(F.col("__w.start").alias(time), *by, "volume", "average_handle_time")
    )
