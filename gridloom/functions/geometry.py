"""Plane geometry and the transverse Mercator projection, in numpy. Rings are (n, 2) arrays, open or closed."""

from __future__ import annotations

import numpy as np

#: The WGS84 ellipsoid and the projection's scale and false easting.
_A, _F, _K0, _E0 = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)
#: Krueger's series to the fourth order in n.
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_E = np.sqrt(_F * (2 - _F))


def utm_zone(lon: float) -> int:
    return int((lon + 180) // 6) + 1


def utm_epsg(lon: float, lat: float) -> int:
    return (32600 if lat >= 0 else 32700) + utm_zone(lon)


def to_utm(lon: np.ndarray, lat: np.ndarray, epsg: int) -> tuple[np.ndarray, np.ndarray]:
    south, zone = epsg // 100 == 327, epsg % 100
    phi, lam = np.radians(lat), np.radians(np.asarray(lon) - (6 * zone - 183))
    t = np.sinh(np.arctanh(np.sin(phi)) - _E * np.arctanh(_E * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arcsinh(np.sin(lam) / np.hypot(t, np.cos(lam)))
    x, y = eta.copy(), xi.copy()
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
        y = y + a * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
    return _E0 + _K0 * _RADIUS * x, (1e7 if south else 0) + _K0 * _RADIUS * y


def from_utm(x: np.ndarray, y: np.ndarray, epsg: int) -> tuple[np.ndarray, np.ndarray]:
    south, zone = epsg // 100 == 327, epsg % 100
    xi, eta = (np.asarray(y) - (1e7 if south else 0)) / (_K0 * _RADIUS), (np.asarray(x) - _E0) / (_K0 * _RADIUS)
    p, q = xi.copy(), eta.copy()
    for j, b in enumerate(_BETA, 1):
        p = p - b * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
        q = q - b * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
    chi = np.arcsin(np.sin(p) / np.cosh(q))
    phi = chi
    for _ in range(6):
        phi = np.arcsin(np.tanh(np.arctanh(np.sin(chi)) + _E * np.arctanh(_E * np.sin(phi))))
    return np.degrees(np.arctan2(np.sinh(q), np.cos(p))) + 6 * zone - 183, np.degrees(phi)


def area(ring: np.ndarray) -> float:
    x, y = ring[:, 0], ring[:, 1]
    return abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1)))) / 2


def _counter_clockwise(ring: np.ndarray) -> np.ndarray:
    x, y = ring[:, 0], ring[:, 1]
    return ring if np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1)) >= 0 else ring[::-1]


def clip(subject: np.ndarray, convex: np.ndarray) -> np.ndarray:
    """Sutherland-Hodgman: the subject inside a convex ring; its area is right even where bridges degenerate."""
    window, out = _counter_clockwise(convex), subject
    for a, b in zip(window, np.roll(window, -1, axis=0), strict=True):
        if len(out) == 0:
            break
        side = (b[0] - a[0]) * (out[:, 1] - a[1]) - (b[1] - a[1]) * (out[:, 0] - a[0])
        kept = []
        for i in range(len(out)):
            p, q, u, v = out[i - 1], out[i], side[i - 1], side[i]
            if (u < 0) != (v < 0):
                kept.append(p + (q - p) * (u / (u - v)))
            if v >= 0:
                kept.append(q)
        out = np.array(kept).reshape(-1, 2)
    return out


def union_area(rings: list[np.ndarray]) -> float:
    """Exact area of a union of simple rings: trapezoids between all ends and crossings of edges."""
    edges = [(p, q) for ring in rings for p, q in zip(ring, np.roll(ring, -1, axis=0), strict=True) if p[0] != q[0]]
    if not edges:
        return 0.0
    owner = np.array([i for i, ring in enumerate(rings) for p, q in zip(ring, np.roll(ring, -1, axis=0), strict=True) if p[0] != q[0]])
    left = np.array([min(p, q, key=lambda v: v[0]) for p, q in edges])
    right = np.array([max(p, q, key=lambda v: v[0]) for p, q in edges])
    slope = (right[:, 1] - left[:, 1]) / (right[:, 0] - left[:, 0])
    base = left[:, 1] - slope * left[:, 0]
    cuts = {*left[:, 0], *right[:, 0]}
    for i in range(len(edges)):
        with np.errstate(divide="ignore", invalid="ignore"):
            x = (base[i + 1 :] - base[i]) / (slope[i] - slope[i + 1 :])
        good = np.isfinite(x) & (x > np.maximum(left[i, 0], left[i + 1 :, 0])) & (x < np.minimum(right[i, 0], right[i + 1 :, 0]))
        cuts.update(x[good])
    total, xs = 0.0, np.array(sorted(cuts))
    for a, b in zip(xs[:-1], xs[1:], strict=True):
        middle = (a + b) / 2
        here = np.flatnonzero((left[:, 0] <= a) & (right[:, 0] >= b))
        heights = slope[here] * middle + base[here]
        inside: dict[int, bool] = {}
        start = 0.0
        for i in here[np.argsort(heights)]:
            was = any(inside.values())
            inside[owner[i]] = not inside.get(owner[i], False)
            now = any(inside.values())
            h = slope[i] * middle + base[i]
            if now and not was:
                start = h
            elif was and not now:
                total += (h - start) * (b - a)
    return total


def contains(ring: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Even-odd test of points."""
    out = np.zeros(np.shape(x), bool)
    for (x0, y0), (x1, y1) in zip(ring, np.roll(ring, -1, axis=0), strict=True):
        if y0 != y1:
            out ^= ((y0 > y) != (y1 > y)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
    return out


def distance(ring: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distance of points from a ring's edges."""
    best = np.full(np.shape(x), np.inf)
    for p, q in zip(ring, np.roll(ring, -1, axis=0), strict=True):
        d = q - p
        t = np.clip(((x - p[0]) * d[0] + (y - p[1]) * d[1]) / max(float(d @ d), 1e-300), 0, 1)
        best = np.minimum(best, np.hypot(x - p[0] - t * d[0], y - p[1] - t * d[1]))
    return best


def buffer(ring: np.ndarray, size: float, segments: int = 16) -> list[np.ndarray]:
    """Rings whose union is the ring widened by size with round joins: itself, a strip per edge, a disc per vertex."""
    turn = np.linspace(0, 2 * np.pi, 4 * segments, endpoint=False)
    disc = size * np.stack([np.cos(turn), np.sin(turn)], axis=1)
    out = [ring]
    for p, q in zip(ring, np.roll(ring, -1, axis=0), strict=True):
        d = q - p
        if n := float(np.hypot(*d)):
            off = size * np.array([-d[1], d[0]]) / n
            out.append(np.array([p + off, q + off, q - off, p - off]))
        out.append(p + disc)
    return out
