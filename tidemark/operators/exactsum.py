"""Sums and averages of doubles that do not depend on the order of the rows.

A double is a whole number of some power of two. It is cut into parts of 32 bits, each a
whole number of a fixed power, its limb. Parts of a limb are added up as integers, exactly
and in any order, and only the total is rounded. Two rows or two billion, one task or a
thousand: the same rows give the same bits.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import hour_end, named
from tidemark.operators.aggregate import WEATHER_MAXIMA, WEATHER_MEANS, with_hour

#: Bits of a limb. The limbs of all finite doubles have these numbers.
BITS, LOWEST, HIGHEST = 32, -36, 32
#: Numbers that are no limbs: how many values, NaNs, positive and negative infinities.
COUNT, NAN, PLUS, MINUS = 101, 102, 103, 104
#: Below this size a double is scaled up by a power of two before it is cut.
TINY, LIFT = 2.0**-400, 19
#: Limbs that the 53 bits of a double may meet, when the first may be one too high.
STEPS = 4


def _power(limb: Column) -> Column:
    """2 ** (BITS * limb), from a table: powers that are exact on every machine. Beyond the
    range of doubles it is null."""
    exponents = [BITS * n for n in range(LOWEST, HIGHEST + 1)]
    table = [2.0**e if -1022 <= e <= 1023 else None for e in exponents]
    values = F.array(*[F.lit(v).cast("double") for v in table])
    return F.get(values, limb - LOWEST)


def limb_entries(
    rows: DataFrame, keep: Sequence[Column | str], values: Sequence[Column]
) -> DataFrame:
    """The ``keep`` columns with ``measure`` (the place in ``values``), ``limb`` and ``part``:
    a row for each part of each value, one for each value that is not null (COUNT), one for
    each that is not finite, and one for each row of ``rows`` (measure -1, COUNT).

    Each step is a projection of its own, which Spark does not copy into the next as the next
    uses it twice; all of them run in one generated loop.
    """
    numbers = range(len(values))
    kept = rows.select(*keep).columns
    each = rows.select(*keep, *[v.cast("double").alias(f"__v{n}") for n, v in enumerate(values)])

    def value(name: str, n: int) -> Column:
        return F.col(f"__{name}{n}")

    finite = {n: F.abs(value("v", n)) < float("inf") for n in numbers}  # neither NaN nor null
    each = each.withColumns(
        {
            f"__tiny{n}": F.coalesce(finite[n] & (F.abs(value("v", n)) < TINY), F.lit(False))
            for n in numbers
        }
    )
    lift = F.lit(2.0 ** (BITS * LIFT))
    each = each.withColumns(
        {
            f"__rest{n}": F.when(value("tiny", n), value("v", n) * lift)
            .when(finite[n], value("v", n))
            .otherwise(F.lit(0.0))
            for n in numbers
        }
    )
    # The logarithm may be off by one limb at a limb's edge; a part has room for that.
    top = {n: F.floor(F.log2(F.abs(value("rest", n))) / BITS).cast("int") for n in numbers}
    each = each.withColumns({f"__top{n}": F.coalesce(top[n], F.lit(0)) + 1 for n in numbers})
    for step in range(STEPS):
        power = {n: _power(value("top", n) - step) for n in numbers}
        parts = {
            f"__part{step}_{n}": F.coalesce(
                (value("rest", n) / power[n]).cast("long"), F.lit(0).cast("long")
            )
            for n in numbers
        }
        each = each.withColumns(parts)
        taken = {n: F.coalesce(value(f"part{step}_", n) * power[n], F.lit(0.0)) for n in numbers}
        each = each.withColumns({f"__rest{n}": value("rest", n) - taken[n] for n in numbers})

    def entry(measure: int, limb: Column, part: Column) -> Column:
        return F.struct(
            F.lit(measure).alias("measure"),
            limb.cast("int").alias("limb"),
            part.cast("long").alias("part"),
        )

    entries = [entry(-1, F.lit(COUNT), F.lit(1))]
    for n in numbers:
        v = value("v", n)
        odd = (
            F.when(F.isnan(v), F.lit(NAN))
            .when(v == float("inf"), F.lit(PLUS))
            .when(v == float("-inf"), F.lit(MINUS))
        )
        entries.append(entry(n, F.lit(COUNT), v.isNotNull().cast("long")))
        entries.append(entry(n, odd, odd.isNotNull().cast("long")))
        shift = F.when(value("tiny", n), F.lit(LIFT)).otherwise(F.lit(0))
        entries += [
            entry(n, value("top", n) - step - shift, value(f"part{step}_", n))
            for step in range(STEPS)
        ]
    spread = each.select(*[named(name) for name in kept], F.inline(F.array(*entries)))
    return spread.where("part <> 0")


def exact_total(entries: Column) -> Column:
    """The double nearest to the sum of ``entries``, an array of summed (limb, part), with at
    most one entry a limb.

    Carries go upwards first, so that all parts have the sign of the total and are below a
    limb's size. The highest three parts that are not zero, and whether any is below them,
    make one whole number, which is rounded once.
    """
    finite = F.filter(entries, lambda e: e["limb"] <= HIGHEST)
    has = lambda kind: F.exists(entries, lambda e: e["limb"] == kind)
    whole_number = lambda c: c.cast("decimal(38,0)")
    base = F.lit(1 << BITS).cast("decimal(20,0)")
    zero = whole_number(F.lit(0))
    numbers = F.transform(finite, lambda e: e["limb"])
    last = F.array_max(numbers) + 3  # sums of 2**64 rows end there

    def carried(sign: int, finish: Callable[[Column], Column]) -> Column:
        def step(state: Column, limb: Column) -> Column:
            own = F.aggregate(
                F.filter(finite, lambda e: e["limb"] == limb), zero,
                lambda total, e: whole_number(total + e["part"]),
            )
            whole = whole_number(own * sign + state["carry"])
            low = whole_number(F.when(limb == last, whole).otherwise(F.pmod(whole, base)))
            highest = whole_number(whole_number(low * base + state["b"]) * base + state["a"])
            sticky = F.when(state["below"], F.lit(1)).otherwise(F.lit(0))
            return F.struct(
                whole_number((whole - low) / base).alias("carry"),
                whole.alias("top"),
                state["b"].alias("a"),
                low.alias("b"),
                (state["below"] | (state["a"] != 0)).alias("below"),
                F.when(low != 0, whole_number(highest * 2 + sticky))
                .otherwise(state["number"])
                .alias("number"),
                F.when(low != 0, limb).otherwise(state["limb"]).alias("limb"),
            )

        start = F.struct(
            zero.alias("carry"), zero.alias("top"), zero.alias("a"), zero.alias("b"),
            F.lit(False).alias("below"), zero.alias("number"), F.lit(0).alias("limb"),
        )
        return F.aggregate(F.sequence(F.array_min(numbers), last), start, step, finish)

    def rounded(state: Column) -> Column:
        return _scaled(state["number"].cast("double") * 0.5, state["limb"] - 2)

    negative = carried(1, lambda s: s["top"]) < 0
    total = (
        F.when(F.size(finite) == 0, F.lit(0.0))
        .when(negative, -carried(-1, rounded))
        .otherwise(carried(1, rounded))
    )
    nan, plus, minus = has(NAN), has(PLUS), has(MINUS)
    return (
        F.when(nan | (plus & minus), F.lit(float("nan")))
        .when(plus, F.lit(float("inf")))
        .when(minus, F.lit(float("-inf")))
        .otherwise(total)
    )


def _scaled(part: Column, limb: Column) -> Column:
    """``part * 2 ** (BITS * limb)``; in two steps where the power alone is out of range."""
    low = F.lit(-LIFT)
    return (
        F.when(part == 0, F.lit(0.0))
        .when(limb < -31, part * _power(limb - low) * _power(low))
        .otherwise(part * _power(limb))
    )


def hourly_reproducible(
    rows: DataFrame,
    entity: str = "city",
    event_time: str = "event_time",
    means: Mapping[str, str] = WEATHER_MEANS,
    maxima: Mapping[str, str] = WEATHER_MAXIMA,
    round_to: int | None = 2,
    width: str = "1 hour",
) -> DataFrame:
    """As :func:`hourly_aggregate`, with averages that are the same for every partitioning and
    retry, of any doubles.

    A row gives a few entries for each average. Entries of a limb are summed in each task and
    again after the shuffle, so a hot entity costs a task a few rows per hour. A NaN among the
    values, or infinities of both signs, make the average NaN.
    """
    keys = [entity, "hour_start"]
    tops = [named(column).alias(f"__max_{n}") for n, column in enumerate(maxima.values())]
    top_names = [f"__max_{n}" for n in range(len(maxima))]
    hours = with_hour(rows, event_time, width)
    entries = limb_entries(hours, [*keys, *tops], [named(column) for column in means.values()])
    summed = entries.groupBy(*keys, "measure", "limb").agg(
        F.sum(F.col("part").cast("decimal(20,0)")).cast("decimal(38,0)").alias("part"),
        *[F.max(name).alias(name) for name in top_names],
    )

    def of(measure: int, value: Column) -> Column:
        return F.collect_list(F.when(F.col("measure") == measure, value))

    pair = F.struct("limb", "part")
    grouped = summed.groupBy(*keys).agg(
        *[of(number, pair).alias(f"__{number}") for number in range(-1, len(means))],
        *[F.max(name).alias(name) for name in top_names],
    )

    def count(name: str) -> Column:
        ones = F.filter(F.col(f"`{name}`"), lambda e: e["limb"] == COUNT)
        return F.get(ones, F.lit(0))["part"].cast("long")

    averages = []
    for number, alias in enumerate(means):
        own = F.filter(F.col(f"`__{number}`"), lambda e: e["limb"] != COUNT)
        mean = exact_total(own) / count(f"__{number}")
        averages.append((mean if round_to is None else F.round(mean, round_to)).alias(alias))
    return grouped.select(
        *keys,
        hour_end(F.col("hour_start"), width).alias("hour_end"),
        *averages,
        *[F.col(name).alias(alias) for name, alias in zip(top_names, maxima, strict=True)],
        count("__-1").alias("record_count"),
    )
