"""The search of weights in numpy, one problem at a time: what the Spark rounds are compared with."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

from marketloom import config
from marketloom.operators.allocate import GRADIENT_TOLERANCE


class Problem:
    """One symbol list: means, covariances and limits."""

    def __init__(self, row, risk_free_rate: float, crypto_total: float):
        self.returns = np.array(row.annual_returns, float)
        self.covariances = np.array([list(r) for r in row.annual_covariances], float)
        self.caps = np.array(row.upper_bounds, float)
        self.crypto = np.array(row.is_crypto, bool)
        self.rate, self.crypto_total = risk_free_rate, crypto_total

    def fill(self, order: Iterable[int]) -> np.ndarray:
        """All weight, given to the symbols in turn as far as the limits allow."""
        weights, left, crypto = np.zeros(len(self.caps)), 1.0, self.crypto_total
        for i in order:
            room = min(self.caps[i], left, crypto if self.crypto[i] else left)
            weights[i] = room
            left -= room
            crypto -= room if self.crypto[i] else 0.0
        return weights

    def sharpe(self, weights: np.ndarray) -> float:
        variance = weights @ self.covariances @ weights
        excess = weights @ self.returns - self.rate
        return excess / variance**0.5 if variance > 0 else -np.inf

    def room(self, weights: np.ndarray) -> np.ndarray:
        """How much can move from symbol i to symbol j, as a matrix."""
        room = np.minimum(weights[:, None], (self.caps - weights)[None, :])
        crypto_left = max(0.0, self.crypto_total - weights[self.crypto].sum())
        enters = ~self.crypto[:, None] & self.crypto[None, :]
        room = np.where(enters, np.minimum(room, crypto_left), room)
        np.fill_diagonal(room, 0.0)
        return np.where(room > 1e-15, room, 0.0)

    def gradient(self, weights: np.ndarray) -> np.ndarray:
        risk = self.covariances @ weights
        variance = weights @ risk
        excess = weights @ self.returns - self.rate
        return (self.returns * variance - excess * risk) / variance**1.5

    def ascend(self, weights: np.ndarray) -> np.ndarray:
        """Moves along the steepest pair, each to the best point on its way, until none helps.

        Near the optimum a move gains less than a double shows. Such moves go on while the steepest
        slope falls; when it has not fallen for as many moves as there are pairs, it is noise.
        """
        least, since, best = np.inf, 0, weights
        while np.isfinite(self.sharpe(weights)):
            slope, room = self.gradient(weights), self.room(weights)
            gain = np.where(room > 0, slope[None, :] - slope[:, None], -np.inf)
            i, j = np.unravel_index(np.argmax(gain), gain.shape)
            since += 1
            if gain[i, j] < least or self.sharpe(weights) > self.sharpe(best):
                least, since, best = min(least, gain[i, j]), 0, weights
            if gain[i, j] < GRADIENT_TOLERANCE / 100 or since > gain.size:
                break
            step = self._best_step(weights, i, j, room[i, j])
            weights = weights.copy()
            weights[i], weights[j] = weights[i] - step, weights[j] + step
        return best

    def _best_step(self, weights: np.ndarray, i: int, j: int, most: float) -> float:
        risk = self.covariances @ weights
        c, cov = weights @ risk, self.covariances
        a, b = weights @ self.returns - self.rate, self.returns[j] - self.returns[i]
        d, e = risk[j] - risk[i], cov[i, i] + cov[j, j] - 2 * cov[i, j]
        # The slope of (a + b t) / sqrt(c + 2 d t + e t^2) has the sign of this line.
        start, change = b * c - a * d, b * d - a * e
        return min(most, -start / change) if change < 0 else most

    def climb_corners(self, weights: np.ndarray) -> np.ndarray:
        """The best of all whole moves between two symbols, until none helps."""
        best = self.sharpe(weights)
        while True:
            room, risk = self.room(weights), self.covariances @ weights
            diagonal = np.diag(self.covariances)
            excess = weights @ self.returns - self.rate
            excess = excess + room * (self.returns[None, :] - self.returns[:, None])
            bend = diagonal[:, None] + diagonal[None, :] - 2 * self.covariances
            variance = weights @ risk + 2 * room * (risk[None, :] - risk[:, None]) + room**2 * bend
            positive = (variance > 0) & (room > 0)
            values = np.where(positive, excess / np.sqrt(np.where(positive, variance, 1)), -np.inf)
            i, j = np.unravel_index(np.argmax(values), values.shape)
            moved = weights.copy()
            moved[i], moved[j] = moved[i] - room[i, j], moved[j] + room[i, j]
            if not self.sharpe(moved) > best + 1e-15:
                return weights
            weights, best = moved, self.sharpe(moved)

    def solve(self, starts: list[np.ndarray]) -> np.ndarray | None:
        """The best weights; None if the limits leave no room or every ratio is undefined."""
        by_return = np.argsort(-self.returns, kind="stable")
        richest = self.fill(by_return)
        if abs(richest.sum() - 1) > config.WEIGHT_TOLERANCE:
            return None
        if richest @ self.returns > self.rate:
            found = [self.ascend(richest)]
        else:
            firsts = [self.fill([i, *by_return[by_return != i]]) for i in range(len(self.caps))]
            corners = [self.climb_corners(w) for w in [*starts, richest, *firsts]]
            found = [self.ascend(max(corners, key=self.sharpe))]
        best = max(found, key=self.sharpe)
        return best if np.isfinite(self.sharpe(best)) else None
