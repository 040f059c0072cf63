"""Price statistics, daily series, relation of two series."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.tables import BARS, PRICE, SENTIMENT, bars, day_text, orders, rounded, sentiment, table
from tidemark.operators import prices, relation, series
from tidemark.plans.prices import RELATED, price_and_sentiment
from tidemark.session import staged

GRID = 12


def price_stats(spark, sf):
    return rounded(prices.price_stats(bars(spark, sf)), 6, "max_open", "min_open")


def customer_stats(spark, sf):
    return prices.price_stats(table(spark, sf, "customer"), "c_mktsegment", "c_acctbal", "c_nationkey")


def monthly_mean_open(spark, sf):
    means = prices.monthly_mean(bars(spark, sf), "Open", "mean_open")
    return rounded(day_text(means, "month_year"), 6, "mean_open")


def monthly_mean_volume(spark, sf):
    means = prices.monthly_mean(bars(spark, sf), "Volume", "mean_volume")
    return day_text(means, "month_year")


def distinct_company(spark, sf):
    return prices.companies(bars(spark, sf))


def sum_volume_one_company(spark, sf):
    return prices.total_of(bars(spark, sf), "2-HIGH", "Volume", "total_volume")


def lag_diff(spark, sf):
    rows = series.lag_diff(orders(spark, sf), "o_orderpriority", "o_orderdate", "price")
    rows = rows.na.drop("any", subset=["lagged"])
    return rounded(day_text(rows, "o_orderdate"), 6, "price", "lagged", "difference")


def log_interpolate(spark, sf):
    """Days with a mean under 70 count as gaps, so that there is something to fill."""
    logs = series.log_series(orders(spark, sf), "o_orderpriority", "o_orderdate", "price", "log_price")
    gaps = logs.withColumn("known", F.when(F.col("price") >= 70, F.col("log_price")))
    filled = series.interpolate_linear(gaps, "o_orderpriority", "o_orderdate", "known", "filled")
    return rounded(
        day_text(filled, "o_orderdate").select("o_orderpriority", "o_orderdate", F.coalesce("filled", F.lit(-1.0)).alias("filled")),
        7,
        "filled",
    )


def _decomposed(spark, sf, model):
    parts = series.decompose(orders(spark, sf), "o_orderpriority", "o_orderdate", "price", model=model)
    kept = parts.where(F.col("issue").isNull()).na.drop("any", subset=["trend", "residual"])
    return day_text(kept.drop("issue", "price"), "o_orderdate")


def decompose(spark, sf):
    parts = _decomposed(spark, sf, "multiplicative")
    return rounded(parts, 6, "trend", "seasonality", "residual")


def decompose_additive(spark, sf):
    return rounded(_decomposed(spark, sf, "additive"), 6, "trend", "seasonality", "residual")


def decomposed_features(spark, sf):
    rows = series.decomposed_features(orders(spark, sf), "o_orderpriority", "o_orderdate", "price")
    rows = day_text(rows.select("o_orderpriority", "o_orderdate", "difference", "standardized_residual"), "o_orderdate")
    return rounded(rows, 6, "difference", "standardized_residual")


def unfit_customers(spark, sf):
    """Customers whose orders are on too few days for two periods of two."""
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderdate", F.col("o_totalprice").alias("price"))
    return series.unfit(rows, "o_custkey", "o_orderdate", "price", period=2)


def lookup_join(spark, sf):
    joined = relation.join_by_date(
        bars(spark, sf), series.standardized_daily(sentiment(spark, sf), "Date", "avg_sentiment_all_news", "z")
    )
    return rounded(day_text(joined, "Date"), 6, "Open", "avg_sentiment_all_news", "z")


def price_sentiment_rows(spark, sf):
    rows = price_and_sentiment(bars(spark, sf), sentiment(spark, sf))
    rows = day_text(rows.select("Company", "Date", *RELATED), "Date")
    return rounded(rows, 6, *RELATED)


def _related(spark, sf):
    """Staged, since the operators read their input twice."""
    return staged(price_and_sentiment(bars(spark, sf), sentiment(spark, sf)), "related")


def pair_corr(spark, sf):
    return rounded(relation.pair_corr(_related(spark, sf), RELATED), 8, "r")


def company_corr(spark, sf):
    return rounded(relation.pair_corr(_related(spark, sf), RELATED, by="Company"), 8, "r")


def company_histogram(spark, sf):
    bins = relation.histogram(_related(spark, sf), "difference", by="Company")
    return rounded(bins, 5, "lo", "hi")


def company_density(spark, sf):
    density = relation.kde_grid(_related(spark, sf), RELATED[1], RELATED[2], GRID, by="Company")
    return rounded(rounded(density, 4, "gx", "gy"), 7, "density")


def item_corr(spark, sf):
    items = table(spark, sf, "lineitem")
    return rounded(relation.pair_corr(items, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]), 8, "r")


def histogram10(spark, sf):
    bins = relation.histogram(table(spark, sf, "events"), "value")
    return rounded(bins, 6, "lo", "hi")


def residual_histogram(spark, sf):
    return rounded(relation.histogram(_related(spark, sf), "standardized_residual"), 5, "lo", "hi")


def kde_grid(spark, sf):
    density = relation.kde_grid(_related(spark, sf), RELATED[1], RELATED[2], GRID)
    return rounded(rounded(density, 4, "gx", "gy"), 7, "density")


def density_binned(spark, sf):
    """The density from binned points."""
    density = relation.kde_binned(_related(spark, sf), RELATED[1], RELATED[2], GRID)
    return rounded(rounded(density.drop("bound"), 4, "gx", "gy"), 7, "density")


def density_within_bound(spark, sf):
    """Whether the binned density of each company keeps its bound against the exact one."""
    related = _related(spark, sf)
    exact = relation.kde_grid(related, RELATED[1], RELATED[2], GRID, by="Company").select("Company", "i", "j", F.col("density").alias("exact"))
    binned = relation.kde_binned(related, RELATED[1], RELATED[2], GRID, by="Company")
    off = F.abs(F.col("density") - F.col("exact"))
    return binned.join(exact, ["Company", "i", "j"]).select("Company", "i", "j", (off <= F.col("bound")).alias("within"))


QUERIES = {
    f.__name__: f
    for f in (
        price_stats, customer_stats, monthly_mean_open, monthly_mean_volume, distinct_company,
        sum_volume_one_company, lag_diff, log_interpolate, decompose, decompose_additive,
        decomposed_features, unfit_customers, lookup_join, price_sentiment_rows, pair_corr, item_corr, histogram10,
        residual_histogram, kde_grid, company_corr, company_histogram, company_density,
        density_binned, density_within_bound,
    )
}

_DAILY = f"""
    SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS d, avg({PRICE}) AS x FROM orders GROUP BY 1, 2
"""


def _decompose_sql(over: str) -> str:
    """Common table expressions up to ``parts``: key, day, value, trend, season, residual."""
    return f"""
    WITH s AS ({_DAILY}),
    n AS MATERIALIZED (SELECT *, row_number() OVER w - 1 AS rn,
                 CASE WHEN count(x) OVER (w ROWS BETWEEN 14 PRECEDING AND 14 FOLLOWING) = 29 THEN
                   (sum(x) OVER (w ROWS BETWEEN 13 PRECEDING AND 13 FOLLOWING)
                    + 0.5::DOUBLE * (lag(x, 14) OVER w + lead(x, 14) OVER w)) / 28 END AS trend
          FROM s WINDOW w AS (PARTITION BY o_orderpriority ORDER BY d)),
    p AS (SELECT o_orderpriority, rn % 28 AS phase, avg(x {over} trend) AS pm FROM n GROUP BY 1, 2),
    q AS (SELECT o_orderpriority, phase, pm {over} avg(pm) OVER (PARTITION BY o_orderpriority) AS season FROM p),
    parts AS (SELECT n.o_orderpriority, n.d, n.x, n.trend, q.season, n.x {over} q.season {over} n.trend AS residual,
                     n.x - lag(n.x) OVER (PARTITION BY n.o_orderpriority ORDER BY n.d) AS difference
              FROM n JOIN q ON n.o_orderpriority = q.o_orderpriority AND n.rn % 28 = q.phase)
    """


_FEATURES = f"""{_decompose_sql("/")},
    f AS MATERIALIZED (SELECT o_orderpriority, d, trend, season, residual, difference,
                 (residual - avg(residual) OVER k) / stddev_pop(residual) OVER k AS z
          FROM parts WHERE trend IS NOT NULL AND difference IS NOT NULL
          WINDOW k AS (PARTITION BY o_orderpriority)),
    l AS (SELECT Date, avg(avg_sentiment_all_news) AS a FROM ({SENTIMENT}) GROUP BY 1),
    z AS (SELECT Date, a, (a - avg(a) OVER ()) / stddev_pop(a) OVER () AS zs FROM l),
    m AS MATERIALIZED (SELECT f.o_orderpriority AS Company, f.d AS Date, f.difference, f.z AS standardized_residual,
                 z.zs AS standardized_sentiment_all_news FROM f JOIN z ON f.d = z.Date)
"""


def _bins_sql(source: str, col: str, places: int) -> str:
    return f"""
    h AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {source}),
    b AS (SELECT CAST(i AS INTEGER) AS bin, i * ((hi - lo) / 10) + lo AS lo,
                 CASE WHEN i = 9 THEN hi ELSE (i + 1) * ((hi - lo) / 10) + lo END AS hi
          FROM h, range(10) t(i))
    SELECT bin, round(b.lo, {places}) + 0.0 AS lo, round(b.hi, {places}) + 0.0 AS hi,
           (SELECT count(*) FROM {source} v WHERE v.{col} >= b.lo AND (v.{col} < b.hi OR (bin = 9 AND v.{col} <= b.hi))) AS n
    FROM b
    """


def _corr_sql(source: str, cols: list[str], by: str = "") -> str:
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    return " UNION ALL ".join(
        f"SELECT {by + ', ' if by else ''}'{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 8) + 0.0 AS r FROM {source}"
        + (f" GROUP BY {by}" if by else "")
        for a, b in pairs
    )


def _density_sql(by: str = "") -> str:
    key, own = (f"{by}, ", f"g.{by}, ") if by else ("", "")
    group, match = (f"GROUP BY {by}", f"WHERE g.{by} = m.{by}") if by else ("", "")
    return f"""{_FEATURES},
        c AS (SELECT {key}count(*) AS n, min(standardized_residual) AS x0, max(standardized_residual) AS x1,
                     min(standardized_sentiment_all_news) AS y0, max(standardized_sentiment_all_news) AS y1,
                     var_samp(standardized_residual) * pow(count(*), -1.0 / 3) AS xx,
                     var_samp(standardized_sentiment_all_news) * pow(count(*), -1.0 / 3) AS yy,
                     covar_samp(standardized_residual, standardized_sentiment_all_news) * pow(count(*), -1.0 / 3) AS xy
              FROM m {group}),
        g AS (SELECT {key}i, j, n, xx, yy, xy, xx * yy - xy * xy AS det,
                     x0 - 3 * sqrt(xx) + i * (x1 - x0 + 6 * sqrt(xx)) / {GRID - 1} AS gx,
                     y0 - 3 * sqrt(yy) + j * (y1 - y0 + 6 * sqrt(yy)) / {GRID - 1} AS gy
              FROM c, range({GRID}) a(i), range({GRID}) b(j))
        SELECT {own}CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(gx, 4) + 0.0 AS gx, round(gy, 4) + 0.0 AS gy,
               round(sum(exp(-0.5 * (yy * (gx - standardized_residual) ** 2
                     - 2 * xy * (gx - standardized_residual) * (gy - standardized_sentiment_all_news)
                     + xx * (gy - standardized_sentiment_all_news) ** 2) / det))
                     / (n * 2 * pi() * sqrt(det)), 7) + 0.0 AS density
        FROM g, m {match} GROUP BY {own}i, j, gx, gy, n, det
    """


_STEP = relation.KDE_STEP
_BINNED = f"""{_FEATURES},
    c AS (SELECT *, xx * yy - xy * xy AS det, xy / xx AS slope, {_STEP}::DOUBLE * sqrt(xx) AS wide, {_STEP}::DOUBLE * sqrt((xx * yy - xy * xy) / xx) AS high
          FROM (SELECT count(*) AS n, min(standardized_residual) AS x0, max(standardized_residual) AS x1,
                       min(standardized_sentiment_all_news) AS y0, max(standardized_sentiment_all_news) AS y1,
                       var_samp(standardized_residual) * pow(count(*), -1.0 / 3) AS xx,
                       var_samp(standardized_sentiment_all_news) * pow(count(*), -1.0 / 3) AS yy,
                       covar_samp(standardized_residual, standardized_sentiment_all_news) * pow(count(*), -1.0 / 3) AS xy FROM m)),
    v AS (SELECT standardized_residual / wide AS a, (standardized_sentiment_all_news - slope * standardized_residual) / high AS b FROM m, c),
    w AS MATERIALIZED (
          SELECT floor(a) + da AS a, floor(b) + db AS b,
                 sum((CASE WHEN da = 1 THEN a - floor(a) ELSE 1 - a + floor(a) END) * (CASE WHEN db = 1 THEN b - floor(b) ELSE 1 - b + floor(b) END)) AS w
          FROM v, range(2) r(da), range(2) t(db) GROUP BY 1, 2),
    g AS (SELECT i, j, n, xx, det, slope, wide, high, x0 - 3 * sqrt(xx) + i * (x1 - x0 + 6 * sqrt(xx)) / {GRID - 1} AS gx,
                 y0 - 3 * sqrt(yy) + j * (y1 - y0 + 6 * sqrt(yy)) / {GRID - 1} AS gy FROM c, range({GRID}) a(i), range({GRID}) b(j))
    SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(gx, 4) + 0.0 AS gx, round(gy, 4) + 0.0 AS gy,
           round(sum(w * exp(-0.5 * ((gx - a * wide) ** 2 / xx + (gy - slope * gx - b * high) ** 2 * xx / det))) / (any_value(n) * 2 * pi() * sqrt(any_value(det))), 7) + 0.0 AS density
    FROM g, w GROUP BY i, j, gx, gy
"""


SQL = {
    "density_binned": _BINNED,
    "density_within_bound": f"""
        SELECT Company, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, true AS within
        FROM (SELECT DISTINCT o_orderpriority AS Company FROM orders), range({GRID}) a(i), range({GRID}) b(j)
    """,
    "unfit_customers": """
        SELECT o_custkey, 'fewer than two periods' AS issue FROM orders
        GROUP BY o_custkey HAVING count(DISTINCT CAST(o_orderdate AS DATE)) < 4
    """,
    "price_stats": f"""
        SELECT Company, round(max(Open), 6) AS max_open, round(min(Open), 6) AS min_open,
               avg(Volume) AS mean_volume, min(Volume) AS min_volume
        FROM ({BARS}) GROUP BY Company
    """,
    "customer_stats": """
        SELECT c_mktsegment, max(c_acctbal) AS max_open, min(c_acctbal) AS min_open,
               avg(c_nationkey) AS mean_volume, min(c_nationkey) AS min_volume
        FROM customer GROUP BY c_mktsegment
    """,
    "monthly_mean_open": f"""
        SELECT Company, strftime(date_trunc('month', Date), '%Y-%m-%d') AS month_year, round(avg(Open), 6) AS mean_open
        FROM ({BARS}) GROUP BY 1, 2
    """,
    "monthly_mean_volume": f"""
        SELECT Company, strftime(date_trunc('month', Date), '%Y-%m-%d') AS month_year, avg(Volume) AS mean_volume
        FROM ({BARS}) GROUP BY 1, 2
    """,
    "distinct_company": "SELECT DISTINCT o_orderpriority AS Company FROM orders",
    "sum_volume_one_company": f"SELECT sum(Volume) AS total_volume FROM ({BARS}) WHERE Company = '2-HIGH'",
    "lag_diff": f"""
        WITH s AS ({_DAILY}), l AS (SELECT *, lag(x) OVER (PARTITION BY o_orderpriority ORDER BY d) AS p FROM s)
        SELECT o_orderpriority, strftime(d, '%Y-%m-%d') AS o_orderdate, round(x, 6) + 0.0 AS price,
               round(p, 6) + 0.0 AS lagged, round(x - p, 6) + 0.0 AS difference
        FROM l WHERE p IS NOT NULL
    """,
    "log_interpolate": f"""
        WITH s AS (SELECT *, CASE WHEN x >= 70 THEN ln(x) END AS y,
                          row_number() OVER (PARTITION BY o_orderpriority ORDER BY d) AS rn FROM ({_DAILY})),
        g AS (SELECT *, last_value(y IGNORE NULLS) OVER b AS y0,
                     last_value(CASE WHEN y IS NOT NULL THEN rn END IGNORE NULLS) OVER b AS r0,
                     first_value(y IGNORE NULLS) OVER a AS y1,
                     first_value(CASE WHEN y IS NOT NULL THEN rn END IGNORE NULLS) OVER a AS r1
              FROM s
              WINDOW b AS (PARTITION BY o_orderpriority ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     a AS (PARTITION BY o_orderpriority ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        SELECT o_orderpriority, strftime(d, '%Y-%m-%d') AS o_orderdate,
               round(coalesce(y, CASE WHEN y1 IS NULL THEN y0 ELSE y0 + (y1 - y0) * (rn - r0) / (r1 - r0) END, -1), 7) + 0.0 AS filled
        FROM g
    """,
    "decompose": f"""{_decompose_sql("/")}
        SELECT o_orderpriority, strftime(d, '%Y-%m-%d') AS o_orderdate, round(trend, 6) + 0.0 AS trend,
               round(season, 6) + 0.0 AS seasonality, round(residual, 6) + 0.0 AS residual
        FROM parts WHERE trend IS NOT NULL
    """,
    "decompose_additive": f"""{_decompose_sql("-")}
        SELECT o_orderpriority, strftime(d, '%Y-%m-%d') AS o_orderdate, round(trend, 6) + 0.0 AS trend,
               round(season, 6) + 0.0 AS seasonality, round(residual, 6) + 0.0 AS residual
        FROM parts WHERE trend IS NOT NULL
    """,
    "decomposed_features": f"""{_FEATURES}
        SELECT o_orderpriority, strftime(d, '%Y-%m-%d') AS o_orderdate, round(difference, 6) + 0.0 AS difference,
               round(z, 6) + 0.0 AS standardized_residual FROM f
    """,
    "lookup_join": f"""{_FEATURES}
        SELECT Company, strftime(b.Date, '%Y-%m-%d') AS Date, round(Open, 6) + 0.0 AS Open, Volume,
               round(a, 6) + 0.0 AS avg_sentiment_all_news, round(zs, 6) + 0.0 AS z
        FROM ({BARS}) b JOIN z ON b.Date = z.Date
    """,
    "price_sentiment_rows": f"""{_FEATURES}
        SELECT Company, strftime(Date, '%Y-%m-%d') AS Date, round(difference, 6) + 0.0 AS difference,
               round(standardized_residual, 6) + 0.0 AS standardized_residual,
               round(standardized_sentiment_all_news, 6) + 0.0 AS standardized_sentiment_all_news
        FROM m
    """,
    "pair_corr": f"{_FEATURES} SELECT *, round(r, 2) + 0.0 AS label FROM ({_corr_sql('m', RELATED)})",
    "item_corr": f"""
        SELECT x, y, r, round(r, 2) + 0.0 AS label
        FROM ({_corr_sql('lineitem', ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])})
    """,
    "histogram10": f"WITH {_bins_sql('events', 'value', 6)}",
    "residual_histogram": f"{_FEATURES}, {_bins_sql('m', 'standardized_residual', 5)}",
    "company_corr": f"{_FEATURES} SELECT *, round(r, 2) + 0.0 AS label FROM ({_corr_sql('m', RELATED, 'Company')})",
    "company_histogram": f"""{_FEATURES},
        h AS (SELECT Company, min(difference) AS lo, max(difference) AS hi FROM m GROUP BY 1),
        b AS (SELECT Company, CAST(i AS INTEGER) AS bin, i * ((hi - lo) / 10) + lo AS lo,
                     CASE WHEN i = 9 THEN hi ELSE (i + 1) * ((hi - lo) / 10) + lo END AS hi
              FROM h, range(10) t(i))
        SELECT b.Company, bin, round(b.lo, 5) + 0.0 AS lo, round(b.hi, 5) + 0.0 AS hi, count(v.difference) AS n
        FROM b LEFT JOIN m v ON v.Company = b.Company AND v.difference >= b.lo
             AND (v.difference < b.hi OR (bin = 9 AND v.difference <= b.hi))
        GROUP BY 1, 2, 3, 4
    """,
    "company_density": _density_sql("Company"),
    "kde_grid": _density_sql(),
}
