"""Linear regression from sums alone.

The coefficients of ridge regression depend on rows only through their number and the
sums and products of features and label, which a grouped pass gathers and states
keep. What is solved on the driver has the size of the features, not of the data.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

REGULARIZATION = 0.01


@dataclass(frozen=True)
class Sums:
    """Rows, sums and sums of products of some variables, of which the last is the label."""

    n: float
    sums: np.ndarray
    products: np.ndarray

    def spread(self) -> np.ndarray:
        """Population covariances."""
        mean = self.sums / self.n
        return self.products / self.n - np.outer(mean, mean)


@dataclass(frozen=True)
class Line:
    """``standard`` are the coefficients of features of mean 0 and deviation 1."""

    intercept: float
    coefficients: np.ndarray
    standard: np.ndarray

    def squared_error(self, over: Sums) -> float:
        """Sum of squared residuals of the rows that ``over`` sums up."""
        w = np.append(-self.coefficients, 1.0)
        shifted = over.products @ w - self.intercept * over.sums
        return float(w @ shifted - self.intercept * (over.sums @ w) + over.n * self.intercept**2)


def solved(over: Sums, regularization: float = REGULARIZATION) -> Line | None:
    """The line of least mean squared error plus ``regularization`` times the squared
    standardised coefficients over the label's deviation, as Spark ML's normal solver
    has it; None without rows. Features (and labels) that do not vary count for nothing."""
    if not over.n:
        return None
    spread, mean = over.spread(), over.sums / over.n
    # what is left of a constant by rounding is no variation
    floor = 1e-12 * (np.abs(over.products.diagonal()) / over.n + mean * mean)
    scale = np.sqrt(np.where(spread.diagonal() > floor, spread.diagonal(), 0))
    inverse = np.divide(1, scale, out=np.zeros_like(scale), where=scale > 0)
    related = spread * np.outer(inverse, inverse)
    within, label = related[:-1, :-1].copy(), scale[-1]
    if label == 0:
        return Line(float(mean[-1]), np.zeros(len(mean) - 1), np.zeros(len(mean) - 1))
    np.fill_diagonal(within, 1 + regularization / label)
    standard = np.linalg.solve(within, related[:-1, -1])
    coefficients = standard * label * inverse[:-1]
    return Line(float(mean[-1] - coefficients @ mean[:-1]), coefficients, standard * label)
