"""Batched solves of small symmetric systems."""

from __future__ import annotations

import numpy as np


def batched_solve(G: np.ndarray, b: np.ndarray, lam: float) -> np.ndarray:
    """(G + λI)⁺ b for a stack of symmetric k×k systems; the answer of one system never depends on its neighbours.

    With λ > 0 the systems are positive definite and solved by LU; a numerically
    singular one among them, and every system with λ = 0, gets the
    pseudo-inverse (the minimum-norm answer for rank-deficient groups).
    """
    k = G.shape[-1]
    A = G.copy()
    idx = np.arange(k)
    A[:, idx, idx] += lam
    if lam > 0:
        try:
            return np.linalg.solve(A, b[..., None])[..., 0]
        except np.linalg.LinAlgError:
            return np.stack([_one(a, y) for a, y in zip(A, b)])
    return np.einsum("bij,bj->bi", np.linalg.pinv(A, hermitian=True), b)


def _one(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(a[None], y[None, :, None])[0, :, 0]
    except np.linalg.LinAlgError:
        return np.linalg.pinv(a, hermitian=True) @ y
