"""Exact quantiles with linear interpolation."""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.sizing import setting

# Size of a sketch, and the share of the ranks it may be wrong by on either side (twice its bound at 99 %).
SKETCH = 4096
_ERROR_FACTOR, _ERROR_POWER = 4.6, 0.9021
# Values of all brackets that come to the driver at once.
ROWS = 200_000
_INF = float("inf")
_MOST = 1.7976931348623157e308


@dataclass
class _Zone:
    """Rows between two brackets of a column, or inside one."""

    inside: bool
    n: int
    low: float
    high: float
    sketch: bytes | None = None


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """Quantiles of each column; a column without values has none. NaN is the largest value.

    They are computed at once, because as subqueries they would be copied into every
    later plan. One pass sketches all columns (the sketches are merged map-side), which
    brackets every wanted rank; a second one counts the rows below each bracket and
    collects the few distinct values inside, so the result is exact, however the values
    are spread. Brackets with more rows than the driver should take are sketched again
    first; a bracket that a sketch placed wrongly is found by the counts and moved, within
    the bounds that earlier counts have set for its rank, so every pass narrows them.
    """
    pairs = [F.struct(F.lit(k).alias("c"), F.col(name).cast("double").alias("v")) for k, name in enumerate(wanted)]
    values = df.select(F.inline(F.array(*pairs))).filter("v is not null")
    rows, size = setting(df, "quantileRows", ROWS), setting(df, "quantileSketch", SKETCH)
    error = min(_ERROR_FACTOR / size**_ERROR_POWER, 0.25)

    brackets = {k: [(-_MOST, _MOST)] for k in range(len(wanted))}
    zones = _counted(values, brackets, size)
    positions = {k: [p * (sum(z.n for z in zones[k]) - 1) for p in probabilities] for k, probabilities in enumerate(wanted.values()) if zones[k]}
    open_ = {k: {f(x) for x in found for f in (math.floor, math.ceil)} for k, found in positions.items()}
    found: dict[int, dict[int, float]] = defaultdict(dict)
    # What the counts so far say of the value at each open rank.
    bounds = {k: dict.fromkeys(ranks, (-_MOST, _MOST)) for k, ranks in open_.items()}
    while True:
        brackets, expected, asked = {}, 0.0, []
        for k, ranks in open_.items():
            below = 0
            for zone in zones[k]:
                held = sorted(r for r in ranks if below <= r < below + zone.n)
                bounds[k].update({r: (max(bounds[k][r][0], zone.low), min(bounds[k][r][1], zone.high)) for r in held})
                if held and (zone.low == zone.high or math.isnan(zone.low)):
                    found[k].update(dict.fromkeys(held, zone.low))
                    ranks.difference_update(held)
                elif held and zone.sketch is not None:
                    for r in held:
                        at = (r - below) / zone.n
                        asked.append((k, zone, max(at - error, 0.0), min(at + 1 / zone.n + error, 1.0), bounds[k][r]))
                        expected += zone.n * min(2 * error, 1.0) + 2
                elif held:  # between the brackets
                    brackets.setdefault(k, []).extend(bounds[k][r] for r in held)
                    expected += zone.n
                below += zone.n
        open_ = {k: ranks for k, ranks in open_.items() if ranks}
        if not open_:
            break
        narrowed: dict[int, tuple[int, _Zone, list]] = {}
        for (k, zone, _, _, (least, most)), (low, high) in zip(asked, _asked(df, asked), strict=True):
            part = max(low, least), min(high, most)
            narrowed.setdefault(id(zone), (k, zone, []))[2].append(part if part[0] <= part[1] else (least, most))
        for k, zone, parts in narrowed.values():
            parts = _disjoint(parts)
            if parts == [(zone.low, zone.high)] and expected > rows:
                # The sketch can't narrow it: the halves are counted apart.
                # Of neighbouring doubles the middle may be rounded to the upper one.
                middle = min(zone.low / 2 + zone.high / 2, math.nextafter(zone.high, -_INF))
                parts = [(zone.low, middle), (math.nextafter(middle, _INF), zone.high)]
            brackets.setdefault(k, []).extend(parts)
        brackets = {k: _disjoint(list_) for k, list_ in brackets.items()}
        wanted_now = values.filter(F.col("c").isin(list(brackets)))
        zones = _collected(wanted_now, brackets) if expected <= rows else _counted(wanted_now, brackets, size)
    return {
        name: [_between(found[k], x) for x in positions[k]] if k in positions else [None] * len(probabilities)
        for k, (name, probabilities) in enumerate(wanted.items())
    }


def _between(at_rank: dict[int, float], position: float) -> float:
    low, high, share = at_rank[math.floor(position)], at_rank[math.ceil(position)], position - math.floor(position)
    if low == high or share == 0:
        return low
    step = high - low
    # The difference of two doubles may be beyond them.
    return low + step * share if math.isfinite(step) else low * (1 - share) + high * share


def _disjoint(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for low, high in sorted(set(brackets)):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _zoned(values: DataFrame, brackets: dict[int, list[tuple[float, float]]]) -> DataFrame:
    """Values with the number of their zone, in rising order: odd inside a bracket, NaN last."""
    v, zone = F.col("v"), F
    for k, list_ in brackets.items():
        here = F.col("c") == k
        for i, (low, high) in enumerate(list_):
            zone = zone.when(here & (v < low), 2 * i).when(here & (v <= high), 2 * i + 1)
        zone = zone.when(here & ~F.isnan(v), 2 * len(list_)).when(here, 2 * len(list_) + 2)
    return values.withColumn("zone", zone)


def _counted(values: DataFrame, brackets: dict, size: int) -> dict[int, list[_Zone]]:
    inside = F.when(F.col("zone") % 2 == 1, F.col("v"))
    rows = (
        _zoned(values, brackets)
        .groupBy("c", "zone")
        .agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.kll_sketch_agg_double(inside, F.lit(size)).alias("sketch"))
        .collect()  # a few rows per column
    )
    out: dict[int, list[_Zone]] = {k: [] for k in brackets}
    for r in sorted(rows, key=lambda r: (r["c"], r["zone"])):
        odd = r["zone"] % 2 == 1
        out[r["c"]].append(_Zone(odd, r["n"], r["low"], r["high"], bytes(r["sketch"]) if odd else None))
    return out


def _collected(values: DataFrame, brackets: dict) -> dict[int, list[_Zone]]:
    """Each distinct value inside a bracket is a zone of its own."""
    rows = (
        _zoned(values, brackets)
        .groupBy("c", "zone", F.when(F.col("zone") % 2 == 1, F.col("v")).alias("kept"))
        .agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()
    )
    out: dict[int, list[_Zone]] = {k: [] for k in brackets}
    for r in sorted(rows, key=lambda r: (r["c"], r["zone"], r["low"] if r["kept"] is not None else 0.0)):
        out[r["c"]].append(_Zone(r["zone"] % 2 == 1, r["n"], r["low"], r["high"]))
    return out


def _asked(df: DataFrame, asked: list[tuple[int, _Zone, float, float, tuple[float, float]]]) -> list[tuple[float, float]]:
    """The values that the zones' sketches have at a lower and an upper share of their rows."""
    if not asked:
        return []
    told = [
        F.kll_sketch_get_quantile_double(F.lit(bytearray(zone.sketch)), F.array(F.lit(low), F.lit(high))).alias(str(i))
        for i, (_, zone, low, high, _) in enumerate(asked)
    ]
    return [tuple(at) for at in df.sparkSession.range(1).select(*told).first()]
