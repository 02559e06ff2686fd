"""Projection to web mercator by column math: geographic, web mercator and UTM sources.

UTM uses the published Krueger series in the third flattening, to its fourth order.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The WGS84 ellipsoid and the UTM grid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0
#: Half the width of the web mercator square.
WORLD = math.pi * SEMI_MAJOR

_N = FLATTENING / (2 - FLATTENING)
_RECTIFYING = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Series coefficients, transverse mercator to conformal sphere.
_TO_SPHERE = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
# Series coefficients, conformal to geodetic latitude.
_TO_GEODETIC = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def mercator_x(longitude: Column) -> Column:
    """Longitude in radians to metres east."""
    return longitude * F.lit(SEMI_MAJOR)


def mercator_y(latitude: Column) -> Column:
    """Latitude in radians to metres north."""
    return F.asinh(F.tan(latitude)) * F.lit(SEMI_MAJOR)


def is_utm(code: Column) -> Column:
    """Whether a code is a UTM zone on WGS84."""
    return F.coalesce(F.floor(code / F.lit(100)).isin(326, 327) & (code % F.lit(100)).between(1, 60), F.lit(False))


def equator(code: Column) -> Column:
    """Northing of the equator in a zone; 0 for other codes."""
    return F.when(F.floor(code / F.lit(100)) == 327, F.lit(FALSE_NORTHING_SOUTH)).otherwise(F.lit(0.0))


def to_mercator(
    df: DataFrame, epsg: str, xs: Mapping[str, Column], ys: Mapping[str, Column], pairs: Sequence[tuple[str, str]] | None = None
) -> DataFrame:
    """Web mercator positions ``mx_{a}{b}`` and ``my_{a}{b}`` of x ``a`` with y ``b`` for all pairs, or those named.

    Geographic, web mercator and UTM codes are known; any other code gives nulls. Each
    step is a column of its own and never null inside (NaN stands for it), and what
    depends on one axis is worked out once per axis: this keeps the generated code small
    enough for the JVM to compile.
    """
    code, nan, two = F.col(epsg), F.lit(float("nan")), F.lit(2.0)
    to_rectified = F.lit(1.0 / (SCALE * _RECTIFYING))
    pairs = list(pairs or ((a, b) for a in xs for b in ys))

    steps: list[dict[str, Column]] = [
        {f"_x_{a}": F.coalesce(x.cast("double"), nan) for a, x in xs.items()}
        | {f"_y_{b}": F.coalesce(y.cast("double"), nan) for b, y in ys.items()}
        | {
            "_utm": is_utm(code),
            "_south": equator(code),
            "_meridian": F.coalesce(
                F.radians((code % F.lit(100)).cast("double") * F.lit(6.0) - F.lit(183.0)), nan
            ),
        },
        {
            f"_eta_{a}": F.when(F.col("_utm"), (F.col(f"_x_{a}") - F.lit(FALSE_EASTING)) * to_rectified).otherwise(nan)
            for a in xs
        }
        | {
            f"_xi_{b}": F.when(F.col("_utm"), (F.col(f"_y_{b}") - F.col("_south")) * to_rectified).otherwise(nan)
            for b in ys
        },
        {f"_sh1_{a}": F.sinh(two * F.col(f"_eta_{a}")) for a in xs}
        | {f"_ch1_{a}": F.cosh(two * F.col(f"_eta_{a}")) for a in xs}
        | {f"_s1_{b}": F.sin(two * F.col(f"_xi_{b}")) for b in ys}
        | {f"_c1_{b}": F.cos(two * F.col(f"_xi_{b}")) for b in ys},
    ]
    for high, low, rest in ((2, 1, 1), (3, 2, 1), (4, 2, 2)):
        steps.append(
            {name: c for a in xs for name, c in _add("_sh", "_ch", a, high, low, rest, 1.0)}
            | {name: c for b in ys for name, c in _add("_s", "_c", b, high, low, rest, -1.0)}
        )
    steps += [
        {f"_sx_{a}{b}": _sum(f"_xi_{b}", _TO_SPHERE, f"_s{{}}_{b}", f"_ch{{}}_{a}") for a, b in pairs}
        | {f"_se_{a}{b}": _sum(f"_eta_{a}", _TO_SPHERE, f"_c{{}}_{b}", f"_sh{{}}_{a}") for a, b in pairs},
        {f"_chi_{a}{b}": F.asin(F.sin(f"_sx_{a}{b}") / F.cosh(f"_se_{a}{b}")) for a, b in pairs}
        | {
            f"_lon_{a}{b}": F.when(code == 4326, F.radians(f"_x_{a}")).otherwise(
                F.col("_meridian") + F.atan2(F.sinh(f"_se_{a}{b}"), F.cos(f"_sx_{a}{b}"))
            )
            for a, b in pairs
        },
        {f"_s1_{a}{b}": F.sin(two * F.col(f"_chi_{a}{b}")) for a, b in pairs}
        | {f"_c1_{a}{b}": F.cos(two * F.col(f"_chi_{a}{b}")) for a, b in pairs},
    ]
    for high, low, rest in ((2, 1, 1), (3, 2, 1), (4, 2, 2)):
        steps.append({name: c for a, b in pairs for name, c in _add("_s", "_c", a + b, high, low, rest, -1.0)})
    steps += [
        {
            f"_lat_{a}{b}": F.when(code == 4326, F.radians(f"_y_{b}")).otherwise(
                _sum(f"_chi_{a}{b}", [-d for d in _TO_GEODETIC], f"_s{{}}_{a}{b}")
            )
            for a, b in pairs
        },
        {f"mx_{a}{b}": F.when(code == 3857, F.col(f"_x_{a}")).otherwise(mercator_x(F.col(f"_lon_{a}{b}"))) for a, b in pairs}
        | {f"my_{a}{b}": F.when(code == 3857, F.col(f"_y_{b}")).otherwise(mercator_y(F.col(f"_lat_{a}{b}"))) for a, b in pairs},
    ]
    out = df
    for step in steps:
        out = out.withColumns(step)
    # behind an inline, a filter on the result stays above and is not spelled out in terms of all the steps
    sides = [F.nullif(f"{m}_{a}{b}", nan).alias(f"{m}_{a}{b}") for a, b in pairs for m in ("mx", "my")]
    return out.select(*df.columns, F.inline(F.array(F.struct(*sides))))


def _add(sine: str, cosine: str, label: str, high: int, low: int, rest: int, sign: float) -> list[tuple[str, Column]]:
    """Sine and cosine of ``high = low + rest`` times an angle; ``sign`` is 1 for the hyperbolic ones."""
    s, c = F.col(f"{sine}{low}_{label}"), F.col(f"{cosine}{low}_{label}")
    s_rest, c_rest = F.col(f"{sine}{rest}_{label}"), F.col(f"{cosine}{rest}_{label}")
    return [
        (f"{sine}{high}_{label}", s * c_rest + c * s_rest),
        (f"{cosine}{high}_{label}", c * c_rest + F.lit(sign) * s * s_rest),
    ]


def _sum(start: str, weights: Sequence[float], *terms: str) -> Column:
    """A start column less the weighted products of its numbered terms."""
    out = F.col(start)
    for j, weight in enumerate(weights, start=1):
        product = F.lit(weight)
        for term in terms:
            product = product * F.col(term.format(j))
        out = out - product
    return out
