"""Eigenvectors of a symmetric matrix by spectral divide and conquer.

The orthogonal factor of a shifted matrix is its matrix sign, which gives the projector onto the eigenvectors above
the shift. It comes from the dynamically weighted Halley iteration, whose steps are QR decompositions. The projector
splits the matrix into two smaller ones without coupling, which are split in turn.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
#: Halley steps at most; six suffice for any matrix that is not singular in double precision.
STEPS = 12
#: How much of the matrix' norm a split may leave between the parts, per row.
COUPLING = 8 * EPS


def polar_sign(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix without an eigenvalue 0: its sign."""
    size = len(a)
    x = a / np.linalg.norm(a)
    lowest = EPS  # below the smallest singular value, unless that vanishes
    eye = np.eye(size)
    for _ in range(STEPS):
        square = lowest * lowest
        d = np.cbrt(4 * (1 - square) / (square * square))
        weight = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d)))
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        q, _ = np.linalg.qr(np.concatenate([np.sqrt(c) * x, eye]))
        new = b / c * x + (weight - b / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        lowest = min(1.0, lowest * (weight + b * square) / (1 + c * square))
        if moved <= np.cbrt(EPS) and 1 - lowest <= 16 * EPS:
            break
    return x


def _basis(projector: np.ndarray, rank: int, rng: np.random.Generator) -> np.ndarray:
    """Orthonormal columns that span the range of a projector, by subspace iteration."""
    q, _ = np.linalg.qr(projector @ rng.standard_normal((len(projector), rank)))
    return np.linalg.qr(projector @ q)[0]


def _split(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[int, np.ndarray] | None:
    """Dimensions above the shift and an orthonormal basis that begins with them; None if the shift divides nothing."""
    size = len(a)
    shifted = a - shift * np.eye(size)
    if not shifted.any():
        return None
    upper = (polar_sign(shifted) + np.eye(size)) / 2
    rank = round(float(np.trace(upper)))
    if not 0 < rank < size:
        return None
    q, _ = np.linalg.qr(np.concatenate([_basis(upper, rank, rng), _basis(np.eye(size) - upper, size - rank, rng)], axis=1))
    return rank, q


def eigen(a: np.ndarray, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors as columns.

    Where eigenvalues agree to rounding, any orthonormal basis of their space is returned. A matrix of size 0 has none.
    """
    a = np.asarray(a, np.float64)
    a = (a + a.T) / 2
    size = len(a)
    rng = np.random.default_rng(seed)
    scale = float(np.linalg.norm(a))
    values, vectors = np.zeros(size), np.zeros((size, size))
    open_parts = [(a, np.eye(size))] if size else []
    done = 0
    while open_parts:
        part, basis = open_parts.pop()
        own = len(part)
        off = part - np.diag(np.diag(part))
        if own == 1 or np.linalg.norm(off) <= EPS * scale:
            values[done : done + own] = np.diag(part)
            vectors[:, done : done + own] = basis
            done += own
            continue
        # The mean of the eigenvalues always has some on either side; the median of the diagonal divides more evenly.
        diagonal = np.sort(np.diag(part))
        mean = float(np.trace(part)) / own
        gap = float(diagonal[-1] - diagonal[0]) / own + np.linalg.norm(off) / own
        shifts = [float(np.median(diagonal)), mean, *(mean + gap * rng.uniform(-1, 1) for _ in range(2 * own + 8))]
        best = None
        for shift in shifts:
            found = _split(part, shift, rng)
            if found is None:
                continue
            rank, q = found
            turned = q.T @ part @ q
            left = float(np.linalg.norm(turned[rank:, :rank]))
            if best is None or left < best[0]:
                best = (left, rank, q, turned)
            if left <= COUPLING * own * scale:
                break
        if best is None:
            # No shift tells the eigenvalues apart: they agree to rounding.
            values[done : done + own] = np.diag(part)
            vectors[:, done : done + own] = basis
            done += own
            continue
        _, rank, q, turned = best
        for low, high in ((0, rank), (rank, own)):
            inner = turned[low:high, low:high]
            open_parts.append(((inner + inner.T) / 2, basis @ q[:, low:high]))
    # One Rayleigh quotient each, against the matrix itself.
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]
