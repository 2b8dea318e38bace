"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

Sylvester's law: V - s*I has as many positive eigenvalues as the block
diagonal D of its factorization L*D*L^T, so one factorization counts the
eigenvalues above s.  Such counts shrink an interval until it holds one
eigenvalue; Rayleigh quotient iteration then converges cubically from inside.
Counts on both sides of the value found certify its number.
"""

from __future__ import annotations

import numpy as np

#: Bunch and Kaufman's bound for one-by-one pivots.
ALPHA = (1 + 17 ** 0.5) / 8
#: Most iterations from one start.
STEPS = 12
EPS = np.finfo(float).eps


def positives(matrix: np.ndarray) -> int:
    """The number of positive eigenvalues, by an L*D*L^T factorization with
    one-by-one and two-by-two pivots."""
    a, n, k, found = matrix.copy(), len(matrix), 0, 0
    while k < n:
        below = np.abs(a[k + 1:, k])
        largest = below.max() if k + 1 < n else 0.0
        size, swap = 1, k
        if abs(a[k, k]) < ALPHA * largest:
            r = k + 1 + int(below.argmax())
            beside = max(np.abs(a[k:r, r]).max(), np.abs(a[r + 1:, r]).max(initial=0.0))
            if abs(a[k, k]) * beside < ALPHA * largest * largest:
                if abs(a[r, r]) >= ALPHA * beside:
                    swap = r
                else:
                    size, swap = 2, r
        at = k + size - 1
        if swap != at:
            a[[at, swap]] = a[[swap, at]]
            a[:, [at, swap]] = a[:, [swap, at]]
        after = k + size
        if size == 1:
            pivot, column = a[k, k], a[after:, k].copy()
            found += pivot > 0
            if pivot:
                a[after:, after:] -= np.outer(column / pivot, column)
        else:
            pivot, columns = a[k:after, k:after].copy(), a[after:, k:after].copy()
            product = pivot[0, 0] * pivot[1, 1] - pivot[0, 1] ** 2
            found += 1 if product < 0 else 2 * int(pivot[0, 0] + pivot[1, 1] > 0)
            a[after:, after:] -= columns @ np.linalg.solve(pivot, columns.T)
        k = after
    return int(found)


class Slices:
    """Counts of a matrix's eigenvalues above shifts, and what they imply."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
        self.known = {-self.norm * (1 + EPS) - EPS: len(matrix), self.norm * (1 + EPS) + EPS: 0}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = positives(self.matrix - shift * np.eye(len(self.matrix)))
        return self.known[shift]

    def bracket(self, k: int) -> tuple[float, float]:
        """The narrowest known (low, high] that holds the k-th largest eigenvalue."""
        low = max(s for s, n in self.known.items() if n >= k)
        return low, min((s for s, n in self.known.items() if n < k and s > low))

    def halve(self, k: int) -> None:
        low, high = self.bracket(k)
        self.above((low + high) / 2)


def _apart(y: np.ndarray, found: np.ndarray) -> np.ndarray:
    """``y`` without its parts along ``found`` columns, of length one."""
    for _ in range(2):
        y = y - found @ (found.T @ y)
    return y / np.linalg.norm(y)


def _solve(matrix: np.ndarray, shift: float, y: np.ndarray, norm: float) -> np.ndarray:
    eye = np.eye(len(matrix))
    try:
        return np.linalg.solve(matrix - shift * eye, y)
    except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
        return np.linalg.solve(matrix - (shift + 4 * EPS * norm) * eye, y)


def _refined(s: Slices, k: int, found: np.ndarray, start: np.ndarray) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from the middle of the k-th bracket."""
    low, high = s.bracket(k)
    y = _apart(_solve(s.matrix, (low + high) / 2, _apart(start, found), s.norm), found)
    value, last = float(y @ s.matrix @ y), np.inf
    for _ in range(STEPS):
        rest = float(np.linalg.norm(s.matrix @ y - value * y))
        if rest >= last / 2 and rest <= 64 * EPS * s.norm:
            break
        last = rest
        y = _apart(_solve(s.matrix, value, y, s.norm), found)
        value = float(y @ s.matrix @ y)
    return value, y


def leading(matrix: np.ndarray, most: int, least: float = 1e-12
            ) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` largest eigenvalues above ``least`` times the trace, falling,
    and their unit eigenvectors as columns.

    Eigenvalues closer than rounding can tell apart get orthogonal vectors of
    their common space.  A value that the counts do not certify raises.
    """
    d = len(matrix)
    s, floor = Slices(matrix), least * float(np.trace(matrix))
    values, vectors = [], np.zeros((d, 0))
    near = 256 * EPS * s.norm
    k = 1
    if floor <= 0:
        return np.zeros(0), vectors
    count = min(most, s.above(floor))
    starts = np.random.default_rng(0).standard_normal((d, d))
    while k <= count:
        low, high = s.bracket(k)
        alone = s.above(low) == k and s.above(high) == k - 1
        if not alone and high - low > near:
            s.halve(k)
            continue
        value, y = _refined(s, k, vectors, starts[:, k - 1])
        slack = near if alone else 4 * near
        if not low - slack <= value <= high + slack:
            if high - low <= near:
                raise ArithmeticError(f"eigenvalue {k} is not where its counts place it")
            s.halve(k)
            continue
        values.append(value)
        vectors = np.column_stack([vectors, y])
        k += 1
    order = np.argsort(-np.array(values), kind="stable")
    values, vectors = np.array(values)[order], vectors[:, order]
    for k, (value, y) in enumerate(zip(values, vectors.T), 1):
        off = max(near, 4 * float(np.linalg.norm(matrix @ y - value * y)))
        if s.above(value - off) < k or s.above(value + off) >= k:
            raise ArithmeticError(f"the counts do not certify eigenvalue {k}")
    return values, vectors
