"""Models whose figures SQL can state in closed form."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestrata.functions.numeric import half_up
from lodestrata.operators import centroids, moments
from lodestrata.workload.lake import Lake
from lodestrata.workload.registry import query
from lodestrata.workload.sqltext import rnd

ALPHAS = (0.0, 1.0, 5000.0)
FOLDS = 3
_ROWS = f"""
    rows AS (SELECT l_quantity AS x1, l_discount AS x2, l_extendedprice / 1000.0 AS y, l_linenumber % {FOLDS} AS fold FROM lineitem),
    settings AS (SELECT * FROM (VALUES {', '.join(f'({a}::DOUBLE)' for a in ALPHAS)}) a(alpha), (SELECT DISTINCT fold FROM rows))"""
_ERRORS = f"""
    SELECT alpha, CAST(fold AS INTEGER) AS fold, COUNT(*) AS n, {rnd("MIN(intercept)", 4)} AS intercept, {rnd("MIN(b1)", 4)} AS slope_1,
           {rnd("MIN(b2)", 4)} AS slope_2, {rnd("SQRT(AVG((y - intercept - b1 * x1 - b2 * x2) ** 2))", 4)} AS rmse,
           {rnd("1 - AVG((y - intercept - b1 * x1 - b2 * x2) ** 2) / VAR_POP(y)", 4)} AS r2
    FROM fitted JOIN rows USING (fold) GROUP BY alpha, fold"""


def _lines(lake: Lake, features: list[str]) -> DataFrame:
    lines = lake.source("lineitem").select(
        "l_quantity", "l_discount", (F.col("l_extendedprice") / 1000.0).alias("price"), "l_linenumber")
    found = moments.ridge_folds(lines, features, "price", F.col("l_linenumber") % FOLDS, ALPHAS)
    slope = [half_up(F.get("slopes", F.lit(i)), 4) if i < len(features) else F.lit(0.0) for i in range(2)]
    return found.select("alpha", "fold", "n", half_up("intercept", 4).alias("intercept"), slope[0].alias("slope_1"),
                        slope[1].alias("slope_2"), half_up("rmse", 4).alias("rmse"), half_up("r2", 4).alias("r2"))


@query("ridge_moments_one", "L5, L7, A30", f"""
    WITH {_ROWS},
    trained AS (
        SELECT alpha, s.fold, COUNT(*) AS n, AVG(x1) AS m1, AVG(y) AS my, VAR_POP(x1) AS v1, COVAR_POP(x1, y) AS c1
        FROM settings s JOIN rows r ON r.fold <> s.fold GROUP BY alpha, s.fold),
    fitted AS (
        SELECT alpha, fold, b1, 0.0 AS b2, my - b1 * m1 AS intercept
        FROM (SELECT *, n * c1 / ((n + alpha) * v1) AS b1 FROM trained))
    {_ERRORS}""")
def ridge_moments_one(lake: Lake) -> DataFrame:
    """Ridge with one feature, every fold left out in turn, from one pass over the lines."""
    return _lines(lake, ["l_quantity"])


@query("ridge_moments_two", "L5, L7, A30", f"""
    WITH {_ROWS},
    trained AS (
        SELECT alpha, s.fold, COUNT(*) AS n, AVG(x1) AS m1, AVG(x2) AS m2, AVG(y) AS my, STDDEV_POP(x1) AS s1, STDDEV_POP(x2) AS s2,
               COVAR_POP(x1, x2) / (STDDEV_POP(x1) * STDDEV_POP(x2)) AS r, COVAR_POP(x1, y) / STDDEV_POP(x1) AS c1,
               COVAR_POP(x2, y) / STDDEV_POP(x2) AS c2
        FROM settings s JOIN rows q ON q.fold <> s.fold GROUP BY alpha, s.fold),
    fitted AS (
        SELECT alpha, fold, b1, b2, my - b1 * m1 - b2 * m2 AS intercept FROM (
            SELECT *, n * ((n + alpha) * c1 - n * r * c2) / ((n + alpha) ** 2 - (n * r) ** 2) / s1 AS b1,
                   n * ((n + alpha) * c2 - n * r * c1) / ((n + alpha) ** 2 - (n * r) ** 2) / s2 AS b2 FROM trained))
    {_ERRORS}""")
def ridge_moments_two(lake: Lake) -> DataFrame:
    """The same with two features."""
    return _lines(lake, ["l_quantity", "l_discount"])


@query("kmeans_line", "L11, L12", f"""
    WITH counted AS (SELECT 100.0::DOUBLE * (l_linenumber % 3) + l_quantity AS x, COUNT(*) AS n FROM lineitem GROUP BY 1),
    running AS (SELECT SUM(n) OVER w AS n, SUM(n * x) OVER w AS s, SUM(n * x * x) OVER w AS q FROM counted WINDOW w AS (ORDER BY x)),
    ends AS (SELECT MAX(n) AS tn, MAX(s) AS ts, MAX(q) AS tq FROM running),
    two AS (
        SELECT n AS low_rows, s / n AS low_centre, (ts - s) / (tn - n) AS high_centre, q - s * s / n + tq - q - (ts - s) ** 2 / (tn - n) AS cost
        FROM running, ends WHERE n < tn),
    three AS (
        SELECT a.n AS low_rows, a.s / a.n AS low_centre, (ts - b.s) / (tn - b.n) AS high_centre,
               a.q - a.s * a.s / a.n + b.q - a.q - (b.s - a.s) ** 2 / (b.n - a.n) + tq - b.q - (ts - b.s) ** 2 / (tn - b.n) AS cost
        FROM running a JOIN running b ON a.n < b.n, ends WHERE b.n < tn)
    SELECT CAST(k AS INTEGER) AS k, CAST(low_rows AS BIGINT) AS low_rows, {rnd("low_centre", 3)} AS low_centre,
           {rnd("high_centre", 3)} AS high_centre, {rnd("cost", 0)} AS inertia
    FROM (SELECT 2 AS k, * FROM (SELECT * FROM two ORDER BY cost LIMIT 1) UNION ALL SELECT 3, * FROM (SELECT * FROM three ORDER BY cost LIMIT 1))""")
def kmeans_line(lake: Lake) -> DataFrame:
    """Two and three clusters on a line, where SQL can try every cut; ten seeds of both in the same passes."""
    lines = lake.source("lineitem").select(
        F.array((100.0 * (F.col("l_linenumber") % 3) + F.col("l_quantity")).cast("double")).alias("x"))
    rows = []
    for k, c in centroids.scan(lines, (2, 3), range(10)).items():
        order = c.centres[:, 0].argsort()
        rows.append((k, int(c.sizes[order[0]]), float(c.centres[order[0], 0]), float(c.centres[order[-1], 0]), c.inertia))
    found = lines.sparkSession.createDataFrame(rows, "k int, low_rows long, low_centre double, high_centre double, inertia double")
    return found.select("k", "low_rows", half_up("low_centre", 3).alias("low_centre"), half_up("high_centre", 3).alias("high_centre"),
                        half_up("inertia", 0).alias("inertia"))
