"""Interleave sources so that every prefix follows the target weights (Pfair scheduling).

Time is cut into slots, one block each. Block ``k`` of a source with share ``w``
is released at slot ``floor(k / w)`` and due by ``ceil((k + 1) / w)``; in every
slot the released block with the earliest deadline goes. Shares sum to one, so
all deadlines are met and at every slot each source is less than one block away
from its share.

It is one schedule for all slots, worked out in periods that do not wait for each
other. What has been served when a period starts follows from the blocks whose
window spans that slot alone: earliest deadline first over the blocks released
within ``reach`` slots before it, the longest window, serves a set of them, and
the first of these by deadline, as many as slots are left over, are those that
the whole schedule has served (unit blocks before a common end form a matroid, and
serving by deadline is its greedy choice). Blocks released earlier are due by
then. Shares are integers of ``UNITS`` parts, so that no rounding adds up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseledger.llm.common import numbered_within
from pulseledger.session import materialise

BLOCK_ROWS = 8
# Slots worked out in one row, or the longest window if that is more; the result is the same for any.
PERIOD = 1000
# Shares are multiples of 1 / UNITS and at least about LEAST / UNITS, which bounds the windows.
UNITS = 1 << 40
LEAST = 1 << 20
# Slots whose order is appended at once.
CHUNK = 256
TEMPERATURE = 0.5


def tempered_weights(df: DataFrame, source: str = "source", temperature: float = TEMPERATURE) -> DataFrame:
    """``source, weight``: each source's row count to the power ``temperature``."""
    return df.groupBy(F.col(source).alias("source")).agg(
        F.pow(F.count(F.lit(1)).cast("double"), F.lit(temperature)).alias("weight")
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, not wherever it occurs."""
    return F.transform(F.array(value), body)[0]


def _div(value: Column, by: Column) -> Column:
    """Whole quotient of non-negative integers."""
    return F.call_function("div", value, by)


def _shares(weights: DataFrame, period: int = PERIOD) -> DataFrame:
    """One row: ``period``, ``reach`` and ``lanes``, an array of ``source, units``. One row per source meets here.

    The units sum to ``UNITS``; the largest share takes what rounding leaves.
    """
    positive = weights.where("weight > 0").groupBy("source").agg(F.sum("weight").alias("weight"))
    gathered = positive.agg(
        F.sort_array(F.collect_list(F.struct("source", "weight"))).alias("lanes"), F.sum("weight").alias("total")
    )
    parts = F.transform("lanes", lambda lane: F.greatest(lane["weight"] / F.col("total"), F.lit(LEAST / UNITS)))
    whole = F.aggregate("parts", F.lit(0.0), lambda sum_, part: sum_ + part)
    rounded = F.transform("parts", lambda part: F.floor(part / F.col("whole") * UNITS))
    left = F.lit(UNITS) - F.aggregate("units", F.lit(0).cast("bigint"), lambda sum_, units: sum_ + units)
    largest = F.array_position("units", F.array_max("units")) - 1
    exact = F.transform("units", lambda units, n: units + F.when(n == F.col("largest"), F.col("left")).otherwise(0))
    lanes = F.zip_with(
        "lanes", "exact", lambda lane, units: F.struct(lane["source"].alias("source"), units.alias("units"))
    )
    reach = F.coalesce(_div(F.lit(UNITS), F.array_min("exact")), F.lit(0)) + 2
    return (
        gathered.withColumn("parts", parts)
        .withColumn("whole", whole)
        .withColumn("units", rounded)
        .withColumn("left", left)
        .withColumn("largest", largest)
        .withColumn("exact", exact)
        .select(F.greatest(F.lit(period), reach).cast("bigint").alias("period"), reach.alias("reach"), lanes.alias("lanes"))
    )


def quotas(weights: DataFrame) -> DataFrame:
    """One row: ``period``, that is ``UNITS``, and ``lanes``, an array of ``source, quota``: each source's slots of them."""
    lanes = F.transform(
        "lanes", lambda lane: F.struct(lane["source"].alias("source"), lane["units"].alias("quota"))
    )
    return _shares(weights).select(F.lit(UNITS).alias("period"), lanes.alias("lanes"))


def _due(lane: Column, block: Column) -> Column:
    return _div((block + 1) * UNITS - lane["past"] + lane["units"] - 1, lane["units"])


def _chosen(done: Column, slot: Column) -> Column:
    """Number of the lane whose released block has the earliest deadline; -1 if none is released."""

    def offer(lane: Column, n: Column) -> Column:
        block = F.element_at(done, n + 1)
        released = block * UNITS - lane["past"] < (slot + 1) * lane["units"]
        return F.when(released, F.struct(_due(lane, block).alias("due"), n.alias("n")))

    offers = F.filter(F.transform("lanes", offer), lambda x: x.isNotNull())
    return F.coalesce(F.array_min(offers)["n"], F.lit(-1))


def _served(done: Column, n: Column) -> Column:
    return F.transform(done, lambda count, at: F.when(at == n, count + 1).otherwise(count))


def _slots(begin: Column, end: Column) -> Column:
    return F.when(begin < end, F.sequence(begin, end - 1)).otherwise(F.expr("cast(array() as array<bigint>)"))


def _starts(periods: DataFrame) -> DataFrame:
    """``k, lead, period, lanes, given``: what the whole schedule has served where period ``k`` starts.

    Slots and blocks count from ``lead`` slots before that; ``lanes`` has ``units``,
    the number ``base`` of the first block counted and its part ``past`` by then.
    """
    begin = F.greatest(F.col("k") * F.col("period") - F.col("reach"), F.lit(0))

    def lane_at(lane: Column) -> Column:
        product = lane["units"].cast("decimal(19,0)") * F.col("begin").cast("decimal(19,0)")
        units = F.lit(UNITS).cast("decimal(19,0)")
        return F.struct(
            lane["units"].alias("units"), _div(product, units).alias("base"), (product % units).cast("bigint").alias("past")
        )

    # The first block counted was released before, unless it starts with the slot.
    first = F.transform("lanes", lambda lane: F.when(lane["past"] > 0, 1).otherwise(0).cast("bigint"))
    done = F.aggregate(
        _slots(F.lit(0).cast("bigint"), F.col("lead")),
        first,
        lambda done, slot: _let(_chosen(done, slot), lambda n: _served(done, n)),
    )
    due_by_now = F.transform("lanes", lambda lane: _div(lane["past"] + lane["units"] * F.col("lead"), F.lit(UNITS)))
    spare = F.col("k") * F.col("period") - F.aggregate(
        F.zip_with("lanes", "floors", lambda lane, floor: lane["base"] + floor),
        F.lit(0).cast("bigint"),
        lambda sum_, blocks: sum_ + blocks,
    )
    ahead = F.filter(
        F.transform(
            F.arrays_zip("lanes", "floors", "done"),
            lambda x, n: F.when(
                x["done"] > x["floors"], F.struct(_due(x["lanes"], x["floors"]).alias("due"), n.alias("n"))
            ),
        ),
        lambda x: x.isNotNull(),
    )
    winners = F.transform(F.slice(F.array_sort(ahead), F.lit(1), F.col("spare").cast("int")), lambda x: x["n"])
    given = F.transform("floors", lambda floor, n: floor + F.array_contains(F.col("winners"), n).cast("bigint"))
    return (
        periods.withColumn("begin", begin)
        .withColumn("lead", F.col("k") * F.col("period") - F.col("begin"))
        .withColumn("lanes", F.transform("lanes", lane_at))
        .withColumn("done", done)
        .withColumn("floors", due_by_now)
        .withColumn("spare", spare)
        .withColumn("winners", winners)
        .select("k", "lead", "period", "lanes", given.alias("given"))
    )


def _turns(starts: DataFrame) -> DataFrame:
    """``n, __block, __slot``: the lane and its block in every slot of the periods."""

    def step(state: Column, slot: Column) -> Column:
        return _let(
            _chosen(state["done"], slot),
            lambda n: F.struct(
                _served(state["done"], n).alias("done"), F.concat(state["order"], F.array(n)).alias("order")
            ),
        )

    end = F.col("lead") + F.col("period")

    def chunk(state: Column, begin: Column) -> Column:
        start = F.struct(state["done"].alias("done"), F.expr("cast(array() as array<int>)").alias("order"))
        return _let(
            F.aggregate(_slots(begin, F.least(begin + CHUNK, end)), start, step),
            lambda after: F.struct(
                after["done"].alias("done"), F.concat(state["orders"], F.array(after["order"])).alias("orders")
            ),
        )

    start = F.struct(F.col("given").alias("done"), F.expr("cast(array() as array<array<int>>)").alias("orders"))
    begins = F.sequence(F.col("lead"), end - 1, F.lit(CHUNK).cast("bigint"))
    order = F.aggregate(begins, start, chunk, lambda state: F.flatten(state["orders"]))
    kept = ("k", "period", "lanes", "given")
    placed = starts.where(F.size("lanes") > 0).withColumn("order", order).select(*kept, F.posexplode("given").alias("n", "done"), "order")
    within = F.expr("transform(filter(transform(order, (x, at) -> struct(x, at)), s -> s.x = n), s -> cast(s.at as bigint))")
    served = F.element_at("lanes", F.col("n") + 1)["base"] + F.col("done")
    return placed.select("k", "period", "n", served.alias("served"), F.posexplode(within).alias("turn", "within")).select(
        "n", (F.col("served") + F.col("turn")).alias("__block"), (F.col("k") * F.col("period") + F.col("within")).alias("__slot")
    )


def schedule(shares: DataFrame, sizes: DataFrame) -> DataFrame:
    """``__source, __blocks, __block, __slot`` for every block of the sources and the one after.

    ``shares`` as ``_shares`` gives them, ``sizes`` has ``source, __blocks``. One
    row per period, then one per slot; periods are worked out apart.
    """
    tasks = int(shares.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lanes = shares.select("period", F.posexplode("lanes").alias("n", "lane")).select(
        "period", "n", F.col("lane.source").alias("__source"), "lane.units"
    )
    held = materialise(sizes.join(lanes, F.col("source").eqNullSafe(F.col("__source"))).drop("source"))
    # By then every source has been given the block after its last.
    slots = (F.col("__blocks") + 2) * (F.lit(float(UNITS)) / F.col("units"))
    count = held.agg(F.max(F.ceil(slots / F.col("period"))).alias("periods"))
    numbered = shares.crossJoin(count).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("periods") - 1)).alias("k"))
    starts = materialise(_starts(numbered.repartition(tasks, "k")))
    turns = _turns(starts.repartition(tasks, "k"))
    return turns.join(held, "n").where("__block <= __blocks").select("__source", "__blocks", "__block", "__slot")


def mix(
    df: DataFrame,
    weights: DataFrame | None = None,
    id_column: str = "doc_id",
    source_column: str = "source",
    block_rows: int = BLOCK_ROWS,
    period: int = PERIOD,
) -> DataFrame:
    """``id, source, block, slot, mix_order, at_target`` for every row of ``df``.

    Reading in ``mix_order`` gives the mix. ``weights`` has ``source, weight``
    (default: tempered row counts); rows of sources without a positive weight
    come after everything else (null slot and block). A source that has run out
    leaves its slots idle; ``at_target`` marks the slots before the first source
    runs out, where all weights hold. Rows are taken within a source in a hashed
    order of their ids. A null source is a source of its own; repeated ids keep
    their rows; an empty table gives an empty one.
    """
    rows = df.select(F.col(id_column).alias("__id"), F.col(source_column).alias("source"))
    if weights is None:
        weights = tempered_weights(rows)
    ordered = numbered_within(
        rows.withColumn("__hash", F.xxhash64("__id")), "source", ["__hash", F.col("__id").asc_nulls_first()]
    ).withColumn("block", F.floor(F.col("nth") / block_rows))
    sizes = ordered.groupBy("source").agg((F.max("block") + 1).alias("__blocks"))
    # Stored, so that Spark knows its size when it plans the joins, and weights are summed once.
    slots = materialise(schedule(materialise(_shares(weights, period)), sizes))
    # The slot in which a source would need the block after its last.
    ends = slots.where("__block = __blocks").agg(F.min("__slot").alias("__horizon"))
    same = F.col("source").eqNullSafe(F.col("__source")) & (F.col("block") == F.col("__block"))
    placed = ordered.join(slots.where("__block < __blocks"), same, "left")
    late = F.lit(1 << 62) + F.col("nth")
    return (
        placed.withColumn("slot", F.col("__slot"))
        .crossJoin(ends)
        .select(
            F.col("__id").alias(id_column),
            F.col("source").alias(source_column),
            F.when(F.col("slot").isNotNull(), F.col("block")).alias("block"),
            "slot",
            F.coalesce(F.col("slot") * block_rows + F.pmod("nth", F.lit(block_rows)), late).alias("mix_order"),
            F.coalesce(F.col("slot") < F.col("__horizon"), F.lit(False)).alias("at_target"),
        )
    )
