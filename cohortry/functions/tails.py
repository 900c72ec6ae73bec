"""Tail probabilities as Catalyst expressions.

Spark SQL has no gamma, beta or error function. Each one here is a convergent
expansion evaluated backwards, so the running value is a single double folded
with ``aggregate`` over ``sequence(depth, 1)``: no Python worker, no loop on the
driver. The depth follows from the arguments. They are meant for aggregated rows
(one per experiment or segment).

Series and continued fractions: Abramowitz & Stegun 6.5.29, 6.5.31, 26.5.8. Large
parameters: Temme's uniform expansion of the incomplete gamma function (DLMF
8.12), Hill (1970) for t, Scheffe & Tukey (1944) for F. Each agrees with the exact
form to 1e-9 where it takes over.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

LARGE_SHAPE = 5000.0
LARGE_DF = 5000.0
LARGE_F_DF = 1_000_000.0


def _fold(step: Callable[[Column, Column], Column], size: Column, start: float = 0.0) -> Column:
    """Terms fall off after some multiple of the square root of the largest parameter, ``size``."""
    depth = F.least(F.ceil(9.0 * F.sqrt(F.greatest(F.coalesce(size, F.lit(0.0)), F.lit(0.0)))), F.lit(8000)) + 100
    order = F.sequence(depth.cast("int"), F.lit(1), F.lit(-1))
    return F.aggregate(order, F.lit(start), lambda acc, k: step(acc, k.cast("double")))


def let(body: Callable[..., Column], *values: Column) -> Column:
    """Bind values to names inside an expression, so that a value used many times is written once."""
    bound = F.struct(*[v.cast("double").alias(f"v{i}") for i, v in enumerate(values)])
    return F.transform(F.array(bound), lambda s: body(*[s[f"v{i}"] for i in range(len(values))]))[0]


def log_gamma(x: Column) -> Column:
    """Stirling's series at x + 10, stepped back down by the recurrence."""
    return let(_log_gamma, x)


def _log_gamma(x: Column) -> Column:
    y = x + 10.0
    shift = x
    for k in range(1, 10):
        shift = shift * (x + float(k))
    inv2 = 1.0 / (y * y)
    tail = (1 / 12 - inv2 * (1 / 360 - inv2 * (1 / 1260 - inv2 * (1 / 1680 - inv2 / 1188)))) / y
    return (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + tail - F.ln(shift)


def gamma_upper(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma Q(a, x)."""
    return let(_gamma_upper, a, x)


def _gamma_upper(a: Column, x: Column) -> Column:
    large = let(_temme, a, x)
    return F.when(a > LARGE_SHAPE, F.when(x <= 0, F.lit(1.0)).otherwise(large)).otherwise(_gamma_small(a, x))


def _gamma_small(a: Column, x: Column) -> Column:
    front = F.exp(a * F.ln(x) - x - log_gamma(a))
    series = _fold(lambda acc, k: 1.0 + x / (a + k) * acc, a, 1.0) / a
    fraction = 1.0 / (x + 1.0 - a - _fold(lambda acc, k: k * (k - a) / (x + 2.0 * k + 1.0 - a - acc), a))
    return (
        F.when(x.isNull() | a.isNull(), F.lit(None).cast("double"))
        .when(x <= 0, F.lit(1.0))
        .when(x < a + 1.0, 1.0 - front * series)
        .otherwise(front * fraction)
    )


def _horner(x: Column, *coefficients: float) -> Column:
    out = F.lit(coefficients[-1])
    for c in coefficients[-2::-1]:
        out = out * x + c
    return out


def _temme(a: Column, x: Column) -> Column:
    """Q(a, x) for a large shape: a normal tail in eta and two terms of its correction.

    Where eta is not small the tail is zero or one in double precision, so the series at zero are enough.
    """
    mu = (x - a) / a
    # mu - ln(1 + mu) without cancellation near zero.
    small = mu * mu * _horner(mu, 1 / 2, -1 / 3, 1 / 4, -1 / 5, 1 / 6, -1 / 7, 1 / 8, -1 / 9, 1 / 10, -1 / 11, 1 / 12)
    half = F.when(F.abs(mu) < 0.05, small).otherwise(mu - F.log1p(F.greatest(mu, F.lit(-1.0 + 1e-300))))
    eta = F.signum(mu) * F.sqrt(2.0 * F.greatest(half, F.lit(0.0)))
    return let(_temme_tail, a, F.greatest(F.least(eta, F.lit(1.0)), F.lit(-1.0)))


def _temme_tail(a: Column, eta: Column) -> Column:
    first = _horner(eta, -1 / 3, 1 / 12, -2 / 135, 1 / 864, 1 / 2835, -139 / 777600, 1 / 25515)
    second = _horner(eta, -1 / 540, -1 / 288, 1 / 378, -77 / 77760)
    rest = F.exp(-a * eta * eta / 2.0) / F.sqrt(2.0 * math.pi * a) * (first + second / a)
    return F.least(F.greatest(normal_upper(eta * F.sqrt(a)) + rest, F.lit(0.0)), F.lit(1.0))


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    def step(acc: Column, k: Column) -> Column:
        even = k * (b - k) * x / ((a + 2.0 * k - 1.0) * (a + 2.0 * k))
        odd = -(a + k) * (a + b + k) * x / ((a + 2.0 * k) * (a + 2.0 * k + 1.0))
        return even / (1.0 + odd / (1.0 + acc))

    first = -(a + b) * x / (a + 1.0)
    return 1.0 / (1.0 + first / (1.0 + _fold(step, F.greatest(a, b))))


def beta_lower(a: Column, b: Column, x: Column) -> Column:
    """Regularised incomplete beta I_x(a, b)."""
    return let(_beta_lower, a, b, x)


def _beta_lower(a: Column, b: Column, x: Column) -> Column:
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.ln(x) + b * F.ln(1.0 - x))
    direct = front * _beta_fraction(a, b, x) / a
    mirrored = 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b
    return (
        F.when(x <= 0, F.lit(0.0))
        .when(x >= 1, F.lit(1.0))
        .when(x < (a + 1.0) / (a + b + 2.0), direct)
        .otherwise(mirrored)
    )


def normal_two_sided(z: Column) -> Column:
    """P(|Z| >= |z|), which is Q(1/2, z^2 / 2)."""
    return let(_gamma_small, F.lit(0.5), z * z / 2.0)


def normal_upper(z: Column) -> Column:
    """P(Z >= z)."""
    return let(_normal_upper, z)


def _normal_upper(z: Column) -> Column:
    half = normal_two_sided(z) / 2.0
    return F.when(z >= 0, half).otherwise(1.0 - half)


#: Numerator and denominator of Hart's rational form of the normal tail (1968, no. 5666), lowest power first.
HART_TOP = (220.206867912376, 221.213596169931, 112.079291497871, 33.912866078383, 6.37396220353165, 0.700383064443688, 3.52624965998911e-02)
HART_BOTTOM = (
    440.413735824752, 793.826512519948, 637.333633378831, 296.564248779674, 86.7807322029461, 16.064177579207, 1.75566716318264, 8.83883476483184e-02,
)


def normal_tail(z: Column) -> Column:
    """P(Z >= z) in some twenty operations, to 1e-15: for sums over many nodes."""
    return let(_normal_tail, z)


def _normal_tail(z: Column) -> Column:
    x = F.abs(z)
    near = F.exp(-0.5 * z * z) * _horner(x, *HART_TOP) / _horner(x, *HART_BOTTOM)
    far = F.exp(-0.5 * z * z) / (x + 1.0 / (x + 2.0 / (x + 3.0 / (x + 4.0 / (x + 0.65))))) / math.sqrt(2.0 * math.pi)
    half = F.when(x < 7.07106781186547, near).otherwise(far)
    return F.when(z >= 0, half).otherwise(1.0 - half)


def _hill(z: Column, b: Column) -> Column:
    z2 = z * z
    third = (4.0 * z2 * z2 * z2 + 33.0 * z2 * z2 + 240.0 * z2 + 855.0) * z
    return z + (z2 + 3.0) * z / b - third / (10.0 * b * (b + 0.8 * z2 * z2 + 100.0))


def t_two_sided(t: Column, df: Column) -> Column:
    """P(|T| >= |t|) for Student's t."""
    return let(_t_two_sided, t, df)


def _t_two_sided(t: Column, df: Column) -> Column:
    exact = beta_lower(df / 2.0, F.lit(0.5), df / (df + t * t))
    near = let(_hill, F.sqrt((df - 0.5) * F.log1p(t * t / df)), 48.0 * (df - 0.5) * (df - 0.5))
    return (
        F.when(t.isNull() | df.isNull() | (df <= 0), F.lit(None).cast("double"))
        .when(df > LARGE_DF, normal_two_sided(near))
        .otherwise(exact)
    )


def chi2_sf(x: Column, df: Column) -> Column:
    """P(X >= x) for chi-square."""
    return let(_chi2_sf, x, df)


def _chi2_sf(x: Column, d: Column) -> Column:
    return F.when(x.isNull() | d.isNull() | (d <= 0), F.lit(None).cast("double")).otherwise(gamma_upper(d / 2.0, x / 2.0))


def f_sf(f: Column, df1: Column, df2: Column) -> Column:
    """P(X >= f) for Fisher's F."""
    return let(_f_sf, f, df1, df2)


def _f_sf(f: Column, d1: Column, d2: Column) -> Column:
    exact = beta_lower(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))
    shrink = (2.0 * d2 + d1 * f / 3.0 + d1 - 2.0) / (2.0 * d2 + 4.0 * d1 * f / 3.0)
    return (
        F.when(f.isNull() | d1.isNull() | d2.isNull() | (d1 <= 0) | (d2 <= 0), F.lit(None).cast("double"))
        .when(d2 > LARGE_F_DF, chi2_sf(shrink * d1 * f, d1))
        .otherwise(exact)
    )
