"""Two series side by side: join by date, correlation, density, histogram."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.numbers import pearson, real
from tidemark.session import join_per_key, with_fit

HISTOGRAM_BINS = 10
KDE_GRID = 100
KDE_CUT = 3.0
KDE_STEP = 0.1  # of the bins, in kernel widths


def join_by_date(rows: DataFrame, per_day: DataFrame, day: str = "Date") -> DataFrame:
    """Inner join of rows with a table that has one row per day."""
    return join_per_key(rows, per_day, day)


def pair_corr(df: DataFrame, cols: Sequence[str], by: str | None = None) -> DataFrame:
    """Correlation of each pair of columns, per key if asked: ``x, y, r`` and ``r`` rounded for a label."""
    pairs = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), pearson(real(F.col(a)), real(F.col(b))).alias("r"))
        for a, b in combinations(cols, 2)
    ]
    keys = [by] if by else []
    return (
        df.groupBy(*keys)
        .agg(F.array(*pairs).alias("pairs"))
        .select(*keys, F.inline("pairs"))
        .withColumn("label", F.bround("r", 2))
    )


def histogram(
    df: DataFrame, col: str, bins: int = HISTOGRAM_BINS, by: str | None = None
) -> DataFrame:
    """Counts in equal bins from the smallest to the largest value: ``bin, lo, hi, n``; the last bin is
    closed and empty bins are listed. With ``by``, one histogram per key.

    A bin's count is the number of values at or above its lower edge less those at or above its upper
    edge, so that values on an edge fall where they belong. These counts are added up in each task: one row
    per task and key is shuffled. A constant column is given a range of one around its value.
    """
    keys = [by] if by else []
    values = df.select(*keys, real(F.col(col)).alias("_x")).where(F.col("_x").isNotNull())
    values = values.where(F.col(by).isNotNull()) if by else values
    spread = F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    flat = F.col("_fit.lo") == F.col("_fit.hi")
    ranged = with_fit(values, spread, by, how="inner").select(
        *keys,
        "_x",
        F.when(flat, F.col("_fit.lo") - 0.5).otherwise(F.col("_fit.lo")).alias("_lo"),
        F.when(flat, F.col("_fit.hi") + 0.5).otherwise(F.col("_fit.hi")).alias("_hi"),
    )

    def edge(i: int) -> Column:
        return i * ((F.col("_hi") - F.col("_lo")) / bins) + F.col("_lo")

    at_least = [F.count(F.lit(1)), *[F.count_if(F.col("_x") >= edge(i)) for i in range(1, bins)]]
    counted = ranged.groupBy(*keys).agg(
        F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.array(*at_least).alias("_n")
    )

    def entry(i: int) -> Column:
        last = i == bins - 1
        above = F.lit(0) if last else F.col("_n")[i + 1]
        return F.struct(
            F.lit(i).alias("bin"),
            edge(i).alias("lo"),
            (F.col("_hi") if last else edge(i + 1)).alias("hi"),
            (F.col("_n")[i] - above).alias("n"),
        )

    return counted.where(F.col("_n")[0] > 0).select(
        *keys, F.inline(F.array(*[entry(i) for i in range(bins)]))
    )


def _points(df: DataFrame, x: str, y: str, by: str | None) -> tuple[list[str], DataFrame, Column]:
    """Keys, points and the fit of a density: count, ranges, kernel covariance."""
    keys = [by] if by else []
    points = df.select(*keys, real(F.col(x)).alias("_x"), real(F.col(y)).alias("_y")).na.drop("any")
    shrink = F.pow(F.count(F.lit(1)).cast("double"), F.lit(-1.0 / 3.0))
    moments = F.struct(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.min("_x").alias("x0"),
        F.max("_x").alias("x1"),
        F.min("_y").alias("y0"),
        F.max("_y").alias("y1"),
        (F.var_samp("_x") * shrink).alias("xx"),
        (F.var_samp("_y") * shrink).alias("yy"),
        (F.covar_samp("_x", "_y") * shrink).alias("xy"),
    )
    return keys, points, moments


def _lattice(fit: Column, grid: int, cut: float) -> tuple[Column, Column]:
    """The place of lattice point ``i, j``."""

    def place(i, low, high, variance):
        start, stop = low - cut * F.sqrt(variance), high + cut * F.sqrt(variance)
        return start + i * ((stop - start) / (grid - 1))

    return place(F.col("i"), fit["x0"], fit["x1"], fit["xx"]), place(F.col("j"), fit["y0"], fit["y1"], fit["yy"])


def _determinant(fit: Column) -> Column:
    return F.greatest(fit["xx"] * fit["yy"] - fit["xy"] * fit["xy"], F.lit(0.0))


def kde_grid(
    df: DataFrame,
    x: str,
    y: str,
    grid: int = KDE_GRID,
    cut: float = KDE_CUT,
    by: str | None = None,
) -> DataFrame:
    """Two-variable Gaussian density on a ``grid`` x ``grid`` lattice: ``i, j, gx, gy, density``.
    With ``by``, one lattice per key.

    The kernel covariance is the sample covariance times n^(-1/3) (Scott's rule in two dimensions); the
    lattice reaches ``cut`` kernel widths beyond the data. Each task adds its rows into the lattice, so
    the shuffle carries lattice cells; the work is rows times cells. Points on one line have no density
    (null).
    """
    keys, points, moments = _points(df, x, y, by)
    fit = F.col("_fit")
    gx, gy = _lattice(fit, grid, cut)
    det = _determinant(fit)
    dx, dy = gx - F.col("_x"), gy - F.col("_y")
    distance = F.try_divide(fit["yy"] * dx * dx - 2 * fit["xy"] * dx * dy + fit["xx"] * dy * dy, det)
    # Equal points are evaluated once; a kernel sum costs far more than this shuffle of points.
    weighted = points.groupBy(*keys, "_x", "_y").agg(F.count(F.lit(1)).alias("_times"))
    cells = (
        with_fit(weighted, moments, by, of=points, how="inner")
        .select(*keys, "_x", "_y", "_times", "_fit", F.explode(F.sequence(F.lit(0), F.lit(grid * grid - 1))).alias("_cell"))
        .withColumn("i", F.floor(F.col("_cell") / grid).cast("int"))
        .withColumn("j", (F.col("_cell") % grid).cast("int"))
        .groupBy(*keys, "i", "j")
        .agg(F.sum(F.col("_times") * F.exp(-0.5 * distance)).alias("_mass"))
    )
    return with_fit(cells, moments, by, of=points, how="inner").select(
        *keys,
        "i",
        "j",
        gx.alias("gx"),
        gy.alias("gy"),
        F.try_divide("_mass", fit["n"] * 2 * F.pi() * F.sqrt(det)).alias("density"),
    )


def kde_binned(
    df: DataFrame,
    x: str,
    y: str,
    grid: int = KDE_GRID,
    cut: float = KDE_CUT,
    by: str | None = None,
    step: float = KDE_STEP,
) -> DataFrame:
    """The density of :func:`kde_grid` from binned points: ``i, j, gx, gy, density, bound``; work is linear in the points.

    With ``v = y - x * xy / xx`` the kernel is a product of one in ``x`` and one in ``v``. Every point is dealt to the four
    corners of its bin, bins being ``step`` kernel widths wide in both directions. Then the corners are summed along ``x``
    at the lattice's columns, and along ``v`` at its points: corners times columns, and so on, instead of points times
    cells. The corners are bounded by the range of the data in kernel widths.

    Dealing to corners replaces the kernel by its bilinear interpolant, which is off by no more than an eighth of
    ``step`` squared times the kernel's second derivative in either direction, and that is at most the kernel's height. So
    the density is off by at most ``bound``, a quarter of ``step`` squared times the height of one kernel.
    """
    keys, points, moments = _points(df, x, y, by)
    fit = F.col("_fit")
    gx, gy = _lattice(fit, grid, cut)
    det, slope = _determinant(fit), F.try_divide(fit["xy"], fit["xx"])
    wide, high = step * F.sqrt(fit["xx"]), step * F.sqrt(F.try_divide(det, fit["xx"]))
    placed = with_fit(points, moments, by, of=points, how="inner")
    across, up = F.try_divide("_x", wide), F.try_divide(F.col("_y") - slope * F.col("_x"), high)
    placed = placed.select(*keys, across.alias("_a"), up.alias("_b")).na.drop("any")
    a, b = F.floor("_a"), F.floor("_b")
    right, top = F.col("_a") - a, F.col("_b") - b
    corners = [
        F.struct((a + p).alias("a"), (b + q).alias("b"), ((right if p else 1 - right) * (top if q else 1 - top)).alias("w"))
        for p in (0, 1)
        for q in (0, 1)
    ]
    weights = placed.select(*keys, F.inline(F.array(*corners))).groupBy(*keys, "a", "b").agg(F.sum("w").alias("w"))

    def listed(rows: DataFrame, name: str) -> DataFrame:
        every = with_fit(rows, moments, by, of=points, how="inner")
        return every.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))

    def kernel(distance: Column, width: Column) -> Column:
        return F.exp(-0.5 * F.pow(F.try_divide(distance, width), F.lit(2)))

    columns = listed(weights, "i").groupBy(*keys, "i", "b").agg(F.sum(F.col("w") * kernel(gx - F.col("a") * wide, wide / step)).alias("w"))
    cells = listed(columns, "j").groupBy(*keys, "i", "j").agg(F.sum(F.col("w") * kernel(gy - slope * gx - F.col("b") * high, high / step)).alias("w"))
    # Points on one line have corners of no height and no cells; their lattice is listed without a density.
    flat = with_fit(points.select(*keys).distinct() if by else points.limit(1).select(), moments, by, of=points, how="inner").where(~(det > 0) | det.isNull())
    flat = flat.select(*keys, "_fit", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i")).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    every = with_fit(cells, moments, by, of=points, how="inner").select(*keys, "_fit", "i", "j", "w")
    every = every.where(det > 0).unionByName(flat.withColumn("w", F.lit(None).cast("double")))
    peak = F.try_divide(F.lit(1.0), 2 * F.pi() * F.sqrt(det))
    return every.select(*keys, "i", "j", gx.alias("gx"), gy.alias("gy"), (F.col("w") * peak / fit["n"]).alias("density"), (step * step / 4 * peak).alias("bound"))
