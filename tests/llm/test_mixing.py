import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from pulseledger.llm import mixing


def scheduled(spark, weights, period, slots):
    """Sources in slot order, as far as ``slots``, and each source's units."""
    frame = spark.createDataFrame(weights, "source string, weight double")
    shares = mixing._shares(frame, period)
    units = {lane.source: lane.units for lane in shares.collect()[0].lanes}
    blocks = [(name, part * slots // mixing.UNITS + 2) for name, part in units.items()]
    rows = mixing.schedule(shares, spark.createDataFrame(blocks, "source string, __blocks long")).collect()
    return {r.__getitem__("__slot"): (r.__getitem__("__source"), r.__getitem__("__block")) for r in rows}, units


def earliest_deadline_first(units, slots):
    """The whole schedule, slot by slot."""
    names = sorted(units, key=lambda name: (name is not None, name or ""))
    done, order = dict.fromkeys(names, 0), []
    for slot in range(slots):
        ready = [n for n in names if done[n] * mixing.UNITS // units[n] <= slot]
        pick = min(ready, key=lambda n: (-(-(done[n] + 1) * mixing.UNITS // units[n]), names.index(n)))
        order.append((pick, done[pick]))
        done[pick] += 1
    return order


UNEVEN = [("a", 7.0), ("b", 2.5), ("c", 1.0), ("d", 0.01), (None, 3.0), ("never", 0.0)]


@pytest.mark.parametrize("weights, period", [
    (UNEVEN, 97),
    ([(f"s{n:02}", float(n % 7) + 0.37) for n in range(31)], 40),
    ([("a", 0.5), ("b", 0.4999), ("c", 0.0001)], 1),
    ([("a", 1.0), ("b", 1.0), ("c", 1.0), ("d", 0.03), ("e", 0.03)], 60),
])
def test_periods_together_are_one_schedule(spark, weights, period):
    slots = 30_003 if period == 1 else 5_000
    found, units = scheduled(spark, weights, period, slots)
    assert sum(units.values()) == mixing.UNITS and "never" not in units
    total = sum(weight for _, weight in weights)
    assert all(abs(units[name] / mixing.UNITS - weight / total) < 1e-9 for name, weight in weights if weight)
    served = dict.fromkeys(units, 0)
    for slot, expected in enumerate(earliest_deadline_first(units, slots)):
        assert found[slot] == expected
        served[expected[0]] += 1
        assert all(abs(served[name] * mixing.UNITS - part * (slot + 1)) < mixing.UNITS for name, part in units.items())


def test_tiny_weights_have_bounded_windows(spark):
    shares = mixing._shares(spark.createDataFrame([("a", 1.0), ("b", 1e-12)], "source string, weight double")).collect()[0]
    assert shares.reach < 1.01 * mixing.UNITS / mixing.LEAST and sum(lane.units for lane in shares.lanes) == mixing.UNITS


def simulated(blocks, quota, period):
    """Earliest deadline first, slot by slot."""
    done, order, slot = dict.fromkeys(quota, 0), {}, 0
    names = sorted(quota, key=lambda name: (name is not None, name or ""))
    while any(done[n] < blocks[n] for n in names):
        ready = [n for n in names if done[n] * period // quota[n] <= slot]
        if ready:
            pick = min(ready, key=lambda n: (-(-(done[n] + 1) * period // quota[n]), names.index(n)))
            if done[pick] < blocks[pick]:
                order[pick, done[pick]] = slot
            done[pick] += 1
        slot += 1
    return order


def test_mix_places_every_row_once(docs):
    weights = docs.select("source").distinct().withColumn("weight", 1 + F.length("source").cast("double"))
    found = mixing.mix(docs, weights, block_rows=2).collect()
    assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert len({r.mix_order for r in found}) == len(found)
    lanes = mixing.quotas(weights).collect()[0]
    quota = {lane.source: lane.quota for lane in lanes.lanes}
    blocks = {name: 1 + max(r.block for r in found if r.source == name) for name in quota}
    expected = simulated(blocks, quota, lanes.period)
    assert {(r.source, r.block): r.slot for r in found} == expected


def test_awkward_rows(awkward, empty, spark):
    found = mixing.mix(awkward).collect()
    assert len(found) == awkward.count() and all(r.slot is not None for r in found)
    some = spark.createDataFrame([("s", 1.0)], "source string, weight double")
    partly = mixing.mix(awkward, some).collect()
    assert len(partly) == awkward.count()
    assert {r.source for r in partly if r.slot is None} == {None, "t", "u"}
    assert mixing.mix(empty).collect() == []


def test_no_python_in_the_plan(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("count", [0, 1])
def test_few_sources(spark, count):
    weights = spark.createDataFrame([("only", 2.0)][:count], "source string, weight double")
    sizes = spark.createDataFrame([("only", 10)][:count], "source string, __blocks long")
    found = mixing.schedule(mixing._shares(weights, 4), sizes).collect()
    assert sorted((r.__getitem__("__block"), r.__getitem__("__slot")) for r in found) == [(n, n) for n in range(11 * count)]


@pytest.mark.parametrize("weights", [
    [1.0] * 22,
    [3000.0**0.5] + [float(n) ** 0.5 for n in range(1, 20)],
    [0.003, 1.0, 2.0, 0.7],
])
def test_prefixes_follow_the_weights_over_many_periods(spark, weights):
    frame = spark.createDataFrame([(f"s{n:02}", w) for n, w in enumerate(weights)], "source string, weight double")
    shares = mixing._shares(frame, 100)
    period = shares.collect()[0].period
    periods = 15
    sizes = frame.selectExpr("source", f"cast(floor(weight / {sum(weights)} * {period * periods}) + 2 as bigint) AS __blocks")
    found = sorted((r.__getitem__("__slot"), r.__getitem__("__source")) for r in mixing.schedule(shares, sizes).collect())
    found = [x for x in found if x[0] < period * periods]
    assert [slot for slot, _ in found] == list(range(period * periods))
    share = {f"s{n:02}": Fraction(w) / sum(map(Fraction, weights)) for n, w in enumerate(weights)}
    served = dict.fromkeys(share, 0)
    for slot, source in found:
        served[source] += 1
        assert all(abs(served[name] - part * (slot + 1)) < 1 + Fraction(1, 10**6) for name, part in share.items())


def test_blocks_keep_their_order_over_periods(spark):
    rows = [(n, "ab"[n % 3 > 1]) for n in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    weights = spark.createDataFrame([("a", 2.0**0.5), ("b", 1.0)], "source string, weight double")
    found = mixing.mix(df, weights, block_rows=1, period=20).collect()
    for source in "ab":
        slots = [r.slot for r in sorted(found, key=lambda r: r.block) if r.source == source]
        share = (2.0**0.5 if source == "a" else 1.0) / (1 + 2.0**0.5)
        assert slots == sorted(set(slots)) and all(abs(n + 1 - share * (slot + 1)) < 1 + 1e-6 for n, slot in enumerate(slots))
