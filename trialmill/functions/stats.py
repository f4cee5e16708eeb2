"""Statistical tests as plain Column expressions.

They run after aggregation, on one row per run, so their cost does not depend on the number of
trials except through the Fisher support (see :func:`fisher_p`).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos approximation, g = 7, n = 9 (public constants).
LANCZOS_G = 7.0
LANCZOS = (
    0.99999999999980993,
    676.5203681218851,
    -1259.1392167224028,
    771.32342877765313,
    -176.61502916214059,
    12.507343278686905,
    -0.13857109526572012,
    9.9843695780195716e-6,
    1.5056327351493116e-7,
)
PANELS = 400


def ratio(numerator: Column, denominator: Column, otherwise: float | None = None) -> Column:
    """Division that never raises under ANSI mode: ``otherwise`` where the denominator is 0."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return quotient if otherwise is None else F.coalesce(quotient, F.lit(otherwise))


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x > 0."""
    z = x - 1.0
    series = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], start=1):
        series = series + F.lit(c) / (z + float(i))
    t = z + (LANCZOS_G + 0.5)
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.ln(t) - t + F.ln(series)


def half_step_gamma_ratio(z: Column) -> Column:
    """Gamma(z + 1/2) / Gamma(z); the asymptotic series keeps full precision for large z."""
    far = F.sqrt(z) * (
        1.0
        - F.try_divide(F.lit(1.0), 8.0 * z)
        + F.try_divide(F.lit(1.0), 128.0 * z * z)
        + F.try_divide(F.lit(5.0), 1024.0 * z * z * z)
        - F.try_divide(F.lit(21.0), 32768.0 * z * z * z * z)
    )
    near = F.exp(log_gamma(z + 0.5) - log_gamma(z))
    return F.when(z > 100.0, far).otherwise(near)


def let(values: dict[str, Column], body) -> Column:
    """Evaluate ``values`` once and hand them to ``body`` as columns.

    Expressions inside a lambda are otherwise evaluated again for every element.
    """
    bound = F.struct(*[v.alias(k) for k, v in values.items()])
    return F.element_at(F.transform(F.array(bound), body), 1)


def student_two_sided(t: Column, df: Column) -> Column:
    """P(|T| >= |t|) by Simpson's rule after t = sqrt(df) tan(u).

    The integrand is flat beyond 40 standard widths, so the interval is cut there; that keeps the
    panels fine for any number of trials.
    """

    def area(v: Column) -> Column:
        def term(i: Column) -> Column:
            weight = F.when((i == 0) | (i == PANELS), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
            return weight * F.pow(F.cos(v["step"] * i), v["power"])

        total = F.aggregate(F.sequence(F.lit(0), F.lit(PANELS)), F.lit(0.0), lambda acc, i: acc + term(i))
        return total * v["scale"] * v["step"]

    def inside(v: Column) -> Column:
        theta = F.least(F.atan(F.abs(v["t"]) / F.sqrt(v["df"])), F.lit(40.0) / F.sqrt(v["df"]))
        return let(
            {
                "step": theta / float(PANELS),
                "power": v["df"] - 1.0,
                "scale": half_step_gamma_ratio(v["df"] / 2.0) * (2.0 / (3.0 * math.sqrt(math.pi))),
            },
            area,
        )

    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - let({"t": t, "df": df}, inside)))


def welch_p(n1: Column, m1: Column, v1: Column, n2: Column, m2: Column, v2: Column) -> Column:
    """Two-sided Welch test from counts, means and sample variances.

    Null when a side has fewer than two values or when both variances and the mean difference are 0;
    0.0 when both variances are 0 but the means differ.
    """

    def test(v: Column) -> Column:
        spread = v["e1"] + v["e2"]
        t = F.try_divide(v["m1"] - v["m2"], F.sqrt(spread))
        df = F.try_divide(
            spread * spread,
            F.try_divide(v["e1"] * v["e1"], v["n1"] - 1) + F.try_divide(v["e2"] * v["e2"], v["n2"] - 1),
        )
        return (
            F.when((v["n1"] < 2) | (v["n2"] < 2), F.lit(None).cast("double"))
            .when(spread > 0, student_two_sided(t, df))
            .when(v["m1"] != v["m2"], F.lit(0.0))
        )

    return let({"n1": n1, "m1": m1, "e1": ratio(v1, n1), "n2": n2, "m2": m2, "e2": ratio(v2, n2)}, test)


def fisher_p(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Two-sided Fisher exact test on [[a, b], [c, d]]; null when a row of the table is empty.

    Weights are relative to the observed table and follow from the ratio of neighbouring terms, so no
    factorials are needed. For tables of every size the terms within max(10 000, 40 standard deviations) of
    the mode are summed. By Bernstein's inequality all terms beyond add up to less than exp(-759), below the
    smallest double: they do not change a sum, and an observation out there has a p-value that rounds to 0.0.
    """

    def bounds(v: Column) -> Column:
        a = v["a"]
        r1, r2, c1 = v["a"] + v["b"], v["c"] + v["d"], v["a"] + v["c"]
        low = F.greatest(F.lit(0).cast("bigint"), c1 - r2)
        high = F.least(r1, c1)
        n, r1d, c1d = (r1 + r2).cast("double"), r1.cast("double"), c1.cast("double")
        mode = F.floor((r1d + 1.0) * (c1d + 1.0) / (n + 2.0)).cast("bigint")
        variance = F.try_divide(r1d * c1d * (n - r1d) * (n - c1d), n * n * F.greatest(n - 1.0, F.lit(1.0)))
        reach = F.greatest(F.lit(10_000).cast("bigint"), F.ceil(40.0 * F.sqrt(variance)).cast("bigint"))
        test = let(
            {
                "a": a,
                "r1": r1,
                "c1": c1,
                "rest": r2 - c1,
                "first": F.greatest(low, mode - reach),
                "last": F.least(high, mode + reach),
            },
            _fisher_sum,
        )
        return F.when((r1 > 0) & (r2 > 0), test)

    return let({k: x.cast("bigint") for k, x in zip("abcd", (a, b, c, d))}, bounds)


def _fisher_sum(v: Column) -> Column:
    a, r1, c1, rest, first, last = (v[k] for k in ("a", "r1", "c1", "rest", "first", "last"))
    none = F.array().cast("array<bigint>")
    up = F.when(a < last, F.sequence(a, last - 1)).otherwise(none)
    down = F.when(a > first, F.sequence(a, first + 1, F.lit(-1).cast("bigint"))).otherwise(none)

    def walk(steps: Column, total: Column, tail: Column, change, finish) -> Column:
        def add(acc: Column, x: Column) -> Column:
            lw = acc["lw"] + change(x)
            weight = F.exp(F.least(lw, F.lit(700.0)))
            return F.struct(
                lw.alias("lw"),
                (acc["total"] + weight).alias("total"),
                (acc["tail"] + F.when(lw <= 1e-7, weight).otherwise(0.0)).alias("tail"),
            )

        start = F.struct(F.lit(0.0).alias("lw"), total.alias("total"), tail.alias("tail"))
        return F.aggregate(steps, start, add, finish)

    def gain(x: Column) -> Column:
        return F.ln((r1 - x) * (c1 - x).cast("double")) - F.ln((x + 1) * (rest + x + 1).cast("double"))

    p = walk(
        up, F.lit(1.0), F.lit(1.0), gain,
        lambda above: walk(
            down, above["total"], above["tail"], lambda x: -gain(x - 1),
            lambda both: both["tail"] / both["total"],
        ),
    )
    return F.when((a < first) | (a > last), F.lit(0.0)).otherwise(F.least(F.lit(1.0), p))


def significance_marker(p: Column) -> Column:
    """`` ***``, `` **`` or `` *`` at 0.001, 0.01 and 0.05."""
    return (
        F.when(p < 0.001, " ***").when(p < 0.01, " **").when(p < 0.05, " *").otherwise("")
    )
