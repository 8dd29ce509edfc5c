"""Eigenvectors of a symmetric matrix by polar decompositions (QDWH divide and conquer).

The polar factor of ``A - s I`` has eigenvalue 1 above the shift ``s`` and -1 below it, so ``(U + I) / 2``
projects on the invariant subspace above.  Bases of it and of its complement cut the matrix in two, and
each half goes the same way.  The matrix has one row per dimension, however many rows the data have.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Six or seven steps reach the polar factor from any condition number.
_STEPS = 30


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by dynamically weighted Halley steps."""
    n = len(a)
    scale = np.linalg.norm(a)
    if not scale:
        return np.eye(n)
    x, low, eye = a / scale, EPS, np.eye(n)
    for _ in range(_STEPS):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:n] @ q[n:].T
        else:
            # well conditioned by now: Cholesky instead of QR
            factor = np.linalg.cholesky(eye + wc * x.T @ x)
            half = np.linalg.solve(factor, x.T)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(factor.T, half).T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if 1 - low < 10 * EPS and moved <= np.cbrt(EPS):
            break
    return x


def _split(a: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the subspaces above and below a shift; None if no shift parts the eigenvalues."""
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
    if spread <= 8 * n * EPS * size:
        return None
    # an eigenvalue at the shift itself has no sign: then try beside it
    best = None
    for step in (0.0, 0.37, -0.37, 0.11, -0.11, 0.71, -0.71):
        above = (polar(a - (mean + step * spread) * np.eye(n)) + np.eye(n)) / 2
        rank = int(round(np.trace(above)))
        if not 0 < rank < n:
            continue
        basis = np.random.default_rng(7).standard_normal((n, n))
        high = np.linalg.qr(above @ basis[:, :rank])[0]
        high = np.linalg.qr(above @ high)[0]
        low = np.linalg.qr(np.hstack([high, basis[:, rank:]]))[0][:, rank:]
        fault = np.linalg.norm(low.T @ a @ high)
        if best is None or fault < best[0]:
            best = (fault, high, low)
        if fault <= 16 * n * EPS * size:
            break
    return None if best is None else best[1:]


def eigenvectors(a: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues (all by default), falling, and their unit eigenvectors as columns.

    Halves that lie below the wanted eigenvalues are never taken apart.  A block whose
    eigenvalues cannot be parted in double precision counts as one eigenvalue several times.
    """
    n = len(a)
    most = n if most is None else min(most, n)
    if not most:
        return np.zeros(0), np.zeros((n, 0))
    a = (a + a.T) / 2
    size = np.linalg.norm(a)
    found: list[np.ndarray] = []
    stack = [np.eye(n)]
    while stack and sum(v.shape[1] for v in found) < most:
        basis = stack.pop()
        block = basis.T @ a @ basis
        parts = _split((block + block.T) / 2, size) if basis.shape[1] > 1 else None
        if parts is None:
            found.append(basis)
        else:
            stack += [basis @ parts[1], basis @ parts[0]]
    vectors = np.linalg.qr(np.hstack(found))[0]
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")[:most]
    return values[order], vectors[:, order]
