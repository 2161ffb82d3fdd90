"""Inverse Albers equal-area projection (EPSG:5070 to 4326) as an SQL expression."""

from __future__ import annotations

import math

# The GRS 80 ellipsoid and the projection's parameters.
_A, _F = 6378137.0, 1 / 298.257222101
_LAT1, _LAT2, _LAT0, _LON0 = 29.5, 45.5, 23.0, -96.0
_E2 = 2 * _F - _F * _F
_E = math.sqrt(_E2)


def _q(lat: float) -> float:
    s = math.sin(math.radians(lat))
    return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


def _m2(lat: float) -> float:
    s = math.sin(math.radians(lat))
    return math.cos(math.radians(lat)) ** 2 / (1 - _E2 * s * s)


_N = (_m2(_LAT1) - _m2(_LAT2)) / (_q(_LAT2) - _q(_LAT1))
_C = _m2(_LAT1) + _N * _q(_LAT1)
_RHO0 = _A * math.sqrt(_C - _N * _q(_LAT0)) / _N
ROUNDS = 5


def _lit(v: float) -> str:
    return f"cast({v!r} as double)"


def longitude_sql(x: str, y: str) -> str:
    """Degrees east of a point in metres."""
    return f"{_lit(_LON0)} + degrees(atan2({x}, {_lit(_RHO0)} - {y})) / {_lit(_N)}"


def latitude_sql(x: str, y: str) -> list[tuple[str, str]]:
    """Named steps to degrees north; each may use the one before. The last is the latitude."""
    rho2 = f"({x} * {x} + ({_lit(_RHO0)} - {y}) * ({_lit(_RHO0)} - {y}))"
    steps = [("q", f"({_lit(_C)} - {rho2} * {_lit(_N * _N / _A / _A)}) / {_lit(_N)}"), ("p0", "asin(q / 2)")]
    for k in range(ROUNDS):
        s = f"sin(p{k})"
        d = f"(1 - {_lit(_E2)} * {s} * {s})"
        steps.append((f"p{k + 1}", f"p{k} + {d} * {d} / (2 * cos(p{k})) * (q / {_lit(1 - _E2)} - {s} / {d} + ln((1 - {_lit(_E)} * {s}) / (1 + {_lit(_E)} * {s})) / {_lit(2 * _E)})"))
    return [*steps, ("latitude", f"degrees(p{ROUNDS})")]
