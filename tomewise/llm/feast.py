"""The largest eigenvalues of a symmetric matrix by contour integration (FEAST), slice by slice.

Inertia counts (signs of the pivots of shifted LDL' factors, taken on the tridiagonal form) say how
many eigenvalues lie above a number. They place the slices in gaps of the spectrum, and later verify
that a slice has found all its eigenvalues. Within a slice, quadrature of (zI - A)^-1 Y along a circle
around it projects a random block onto the slice's eigenvectors; Rayleigh-Ritz extracts pairs from it,
and the Ritz vectors are the next block. Slices do not depend on each other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = np.finfo(float).eps
NODES = 8  # of the quadrature on the upper half of a circle
PER_SLICE = 8  # eigenvalues in a slice, unless some lie too close to be cut apart
APART = 1e-8  # of the largest eigenvalue: gaps in which a cut may lie
LOOPS = 60


@dataclass
class Slice:
    """Eigenvalues between ``low`` and ``high``: ``count`` of them by inertia."""

    low: float
    high: float
    count: int


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix."""
    a, n = a.copy(), len(a)
    off = np.zeros(max(n - 1, 0))
    for k in range(n - 1):
        x = a[k + 1 :, k]
        off[k] = alpha = -np.copysign(np.linalg.norm(x), x[0])
        v = x.copy()
        v[0] -= alpha
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v /= size
        p = a[k + 1 :, k + 1 :] @ v
        w = p - (v @ p) * v
        a[k + 1 :, k + 1 :] -= 2 * (np.outer(v, w) + np.outer(w, v))
    return np.diag(a).copy(), off


def above(form: tuple[np.ndarray, np.ndarray], shifts) -> np.ndarray:
    """How many eigenvalues are larger than each shift."""
    diagonal, off = form
    shifts = np.atleast_1d(np.asarray(shifts, float))
    tiny = EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), 1e-300)
    count, pivot = np.zeros(len(shifts), np.int64), np.ones(len(shifts))
    for i, d in enumerate(diagonal):
        pivot = d - shifts - (off[i - 1] ** 2 / pivot if i else 0)
        pivot = np.where(np.abs(pivot) < tiny * EPS, -tiny * EPS, pivot)
        count += pivot > 0
    return count


def slices(a: np.ndarray, wanted: int, least: float = 1e-11) -> list[Slice]:
    """Slices from the top that hold the ``wanted`` largest eigenvalues, or as many as are larger
    than ``least`` times the largest; the last slice may hold more."""
    n, form = len(a), tridiagonal(a)
    bound = np.abs(a).sum(1).max() * (1 + 1e-9)
    if not bound > 0:
        return []
    # eigenvalues by bisection, largest first, to a part in 2 ** 45 of the bound
    index = np.arange(min(n, wanted + 2 * PER_SLICE))
    low, high = np.full(len(index), -bound), np.full(len(index), bound)
    for _ in range(45):
        middle = (low + high) / 2
        more = above(form, middle) > index
        low, high = np.where(more, middle, low), np.where(more, high, middle)
    values = (low + high) / 2
    wanted = min(wanted, int((values > least * values[0]).sum()))
    out, start, top = [], 0, bound * 1.01
    while start < wanted:
        ends = [e for e in range(start + 1, len(values)) if values[e - 1] - values[e] > APART * values[0]]
        near = [e for e in ends if PER_SLICE // 2 <= e - start <= 3 * PER_SLICE // 2]
        near = near or [e for e in ends if e - start >= PER_SLICE][:1] or ends[-1:]
        if near:
            end = max(near, key=lambda e: values[e - 1] - values[e])
            bottom = (values[end - 1] + values[end]) / 2
        else:
            end, bottom = n, -bound * 1.01
        counts = above(form, [bottom, top])
        # the circle is drawn closer than the cuts where the gaps beside the slice are wide
        first, last = values[start], values[end - 1] if end <= len(values) else bottom
        margin = max((first - last) / 4, min(top - first, max(last - bottom, 0)))
        out.append(Slice(float(max(bottom, last - margin)), float(min(top, first + margin)), int(counts[0] - counts[1])))
        start, top = end, bottom
    return out


def project(a: np.ndarray, block: np.ndarray, part: Slice, nodes: int = NODES) -> np.ndarray:
    """The block under the spectral projector of a slice: Gauss-Legendre quadrature along the circle
    of the resolvent's real part, as the lower half of the circle gives the conjugate."""
    centre, radius = (part.low + part.high) / 2, (part.high - part.low) / 2
    out, eye = np.zeros_like(block), np.eye(len(a))
    for t, weight in zip(*np.polynomial.legendre.leggauss(nodes), strict=True):
        turn = np.exp(0.5j * np.pi * (t + 1))
        out += weight / 2 * (radius * turn * np.linalg.solve((centre + radius * turn) * eye - a, block)).real
    return out


def solve(a: np.ndarray, part: Slice, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a slice, largest first, and their unit vectors (in columns)."""
    n, size = len(a), np.abs(a).sum(1).max()
    rng, width = np.random.default_rng(seed), min(len(a), part.count + part.count // 2 + 4)
    block, before = rng.standard_normal((n, width)), np.inf
    for _ in range(LOOPS):
        basis = np.linalg.qr(project(a, block, part))[0]
        values, small = np.linalg.eigh(basis.T @ a @ basis)
        block = basis @ small
        residual = np.linalg.norm(a @ block - block * values, axis=0)
        inside = np.flatnonzero((values > part.low) & (values < part.high))
        inside = inside[np.argsort(residual[inside], kind="stable")][: part.count]
        worst = residual[inside].max(initial=0)
        good = len(inside) == part.count and worst < 1e-10 * size
        if good and (worst < 16 * EPS * size or worst > before / 2):  # as exact as it gets
            inside = inside[np.argsort(-values[inside], kind="stable")]
            return values[inside], block[:, inside]
        before = worst if len(inside) == part.count else np.inf
    raise ArithmeticError(f"a slice has {part.count} eigenvalues by inertia, not all of which were found")
