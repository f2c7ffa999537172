"""Exact medians per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlens.functions.aggregates import grid_point, grid_value

#: The values of a ratio: 1,001 points on three digits.
RATIO = (0.0, 1.0)
#: A window over one group's points holds two to this power at most.
LEVEL_BITS = 13
POINT_BITS = 64


def grouped_medians(
    df: DataFrame,
    key: str,
    value: str,
    digits: int,
    populations: dict[str, tuple[str, Column | None]],
    sums: dict[str, str] | None = None,
    span: tuple[float, float] | None = None,
) -> DataFrame:
    """Per key: size and median of every population, plus sums, in one pass over the rows.

    ``populations`` maps the name of a count to the name of its median and the
    population's predicate (None for all rows). The median is the lower one,
    rounded to ``digits``; NULL values count as rows but not for the median, and NaN
    sorts last.

    Rows first collapse to one per (key, rounded value) in a hash aggregate, with
    map-side combining: a ratio on three digits leaves 1,001 rows per key however
    hot the key is. Running counts over those rows then find the middle.

    ``span`` declares the smallest and largest value of a narrow measure, ``RATIO`` for a
    ratio; one window then takes the points of a group. Any other measure is narrowed
    down level by level, so that no window takes more than ``2 ** LEVEL_BITS`` rows of a
    group, however many different values it has. Values beyond a span are not lost, they only
    make its window longer.
    """
    sums = sums or {}
    sizes = {
        name: F.count("*") if member is None else F.count_if(member)
        for name, (_, member) in populations.items()
    }
    histogram = df.groupBy(key, grid_point(value, digits).alias("_point")).agg(
        *[size.alias(name) for name, size in sizes.items()],
        *[F.sum(column).alias(name) for name, column in sums.items()],
    )
    narrow = span is not None and (span[1] - span[0]) * 10**digits <= 1 << LEVEL_BITS
    if not narrow:
        return _by_levels(histogram, key, digits, populations, [*populations, *sums])
    group = Window.partitionBy(key)
    upwards = group.orderBy("_point").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = {}
    for name in populations:
        known = F.when(F.col("_point").isNotNull(), F.col(name))
        running[f"_upto_{name}"] = F.sum(known).over(upwards)
        running[f"_all_{name}"] = F.sum(known).over(group)
    measures = [F.sum(name).alias(name) for name in [*populations, *sums]]
    for name, (median, _) in populations.items():
        reached = F.col(f"_upto_{name}") >= F.ceil(F.col(f"_all_{name}") / 2)
        middle = F.min(F.when(reached & (F.col(f"_all_{name}") > 0), F.col("_point")))
        measures.append(grid_value(middle, digits).alias(median))
    # The window left the rows partitioned by key: no further shuffle.
    return histogram.withColumns(running).groupBy(key).agg(*measures)


def _by_levels(
    histogram: DataFrame,
    key: str,
    digits: int,
    populations: dict[str, tuple[str, Column | None]],
    totals: list[str],
) -> DataFrame:
    """Counts are summed up over ever shorter prefixes of the points, then the middle is
    followed down again: at each level only the rows below the prefix found are looked at.

    Rows meet their prefix by (key, prefix), so a group's points are spread over tasks.
    """
    places = range(len(populations))
    known = [F.when(F.col("_point").isNotNull(), F.col(name)).otherwise(0) for name in populations]
    overall = histogram.groupBy(F.col(key).alias("_key")).agg(
        *[F.sum(name).alias(name) for name in totals],
        F.array(*[F.sum(count) for count in known]).alias("_all"),
    )
    points = histogram.filter(F.col("_point").isNotNull())
    levels = [points.select(
        F.col(key).alias("_key"), F.col("_point").alias("_bin"), F.array(*known).alias("_n"))]
    while len(levels) * LEVEL_BITS < POINT_BITS:
        counts = [F.sum(F.col("_n")[i]) for i in places]
        levels.append(
            levels[-1].groupBy("_key", F.shiftright("_bin", LEVEL_BITS).alias("_bin"))
            .agg(F.array(*counts).alias("_n")))
    middles = F.posexplode(F.transform("_all", lambda n: F.ceil(n / 2)))
    wanted = overall.select("_key", F.lit(0).cast("long").alias("_above"),
                            middles.alias("_population", "_rank"))
    wanted = wanted.filter(F.col("_rank") > 0)
    for level in reversed(levels):
        wanted = _descend(_below(level, wanted, top=level is levels[-1]))
    middle = wanted.groupBy("_key").agg(*[
        F.max(F.when(F.col("_population") == i, F.col("_above"))).alias(f"_middle_{i}")
        for i in places
    ])
    medians = [
        grid_value(f"_middle_{i}", digits).alias(median)
        for i, (median, _) in enumerate(populations.values())
    ]
    same = F.col("_all._key").eqNullSafe(F.col("_found._key"))
    met = overall.alias("_all").join(middle.alias("_found"), same, "left")
    return met.select(F.col("_all._key").alias(key), *totals, *medians)


def _below(level: DataFrame, wanted: DataFrame, top: bool) -> DataFrame:
    """The counts of a level that lie below the prefixes found, per population."""
    above = F.lit(0) if top else F.shiftright("_bin", LEVEL_BITS)
    rows = level.withColumn("_above", above.cast("long")).alias("_rows")
    same = F.col("_rows._key").eqNullSafe(F.col("_wanted._key"))
    same &= F.col("_rows._above") == F.col("_wanted._above")
    return rows.join(wanted.alias("_wanted"), same).select(
        "_rows._key", "_population", "_rank", "_bin",
        F.col("_n")[F.col("_population")].alias("_count"),
    )


def _descend(rows: DataFrame) -> DataFrame:
    """Per key and population the prefix that holds the rank, and the rank within it."""
    group = Window.partitionBy("_key", "_population")
    upwards = group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_upto", F.sum("_count").over(upwards))
    reached = F.col("_upto") >= F.col("_rank")
    before = F.coalesce(F.max(F.when(~reached, F.col("_upto"))), F.lit(0).cast("long"))
    return rows.groupBy("_key", "_population").agg(
        F.min(F.when(reached, F.col("_bin"))).alias("_above"),
        (F.max("_rank") - before).alias("_rank"),
    )
