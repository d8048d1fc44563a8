"""Models whose optimum follows from the fold moments alone.

Ridge, ridge classification, lasso and elastic net, linear discriminant
analysis, Gaussian and multinomial naive Bayes. Fitting every grid point on
every training subset needs no further pass over the data.
"""

from __future__ import annotations

import numpy as np

from tablewright.errors import ConvergenceError
from tablewright.operators.moments import Moments, prepared_gram
from tablewright.operators.scoring import ARGMAX, SIGN, VALUE, LinearScorer, QuadraticScorer


class LinearSystem:
    """Centred second moments of one training subset's prepared features."""

    def __init__(self, m: Moments, maps, t: int):
        self.fm = maps[t]
        self.n = m.n(t)
        g = prepared_gram(self.fm, m.train("gram", t))
        self.mean = g[0, 1:] / self.n
        self.sxx = g[1:, 1:] - self.n * np.outer(self.mean, self.mean)

    def cross(self, totals: np.ndarray, y_sum) -> np.ndarray:
        """Centred cross products for encoded totals of y·u; one column per target."""
        pushed = self.fm.push(totals)[1:]
        return pushed - np.outer(self.mean, np.atleast_1d(y_sum))


def solve_ridge(sxx: np.ndarray, sxy: np.ndarray, alpha: float) -> np.ndarray:
    """Minimum-norm solution when alpha is zero or the system is singular."""
    a = sxx + alpha * np.eye(len(sxx))
    try:
        return np.linalg.solve(a, sxy)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(a, sxy, rcond=None)[0]


def ridge(m: Moments, maps, t: int, alpha: float) -> LinearScorer:
    s = LinearSystem(m, maps, t)
    y_sum = m.train("xy", t)[0]
    w = solve_ridge(s.sxx, s.cross(m.train("xy", t)[:, None], y_sum), alpha)
    b = y_sum / s.n - s.mean @ w
    return LinearScorer(s.fm.pull(w, b), VALUE)


def ridge_classifier(m: Moments, maps, t: int, alpha: float) -> LinearScorer:
    """Ridge on ±1 targets, one per class; two classes share one."""
    s = LinearSystem(m, maps, t)
    by_class = m.train("sums", t)
    total = by_class.sum(axis=0)
    if m.n_classes == 2:
        signed, rule = (by_class[1] - by_class[0])[:, None], SIGN
    else:
        signed, rule = (2 * by_class - total).T, ARGMAX
    w = solve_ridge(s.sxx, s.cross(signed, signed[0]), alpha)
    b = signed[0] / s.n - s.mean @ w
    return LinearScorer(s.fm.pull(w, b), rule)


def coordinate_descent(sxx: np.ndarray, sxy: np.ndarray, l1: float, l2: float, n: float, tol: float = 1e-9,
                       max_iter: int = 5000) -> np.ndarray:
    """Minimises 1/(2n)·‖y-Xw‖² + l1·‖w‖₁ + l2/2·‖w‖² over centred moments."""
    h, c = sxx / n, sxy / n
    w = np.zeros(len(c))
    grad = -c.copy()  # h @ w - c
    for _ in range(max_iter):
        moved = 0.0
        for j in range(len(w)):
            den = h[j, j] + l2
            if h[j, j] <= 1e-15:
                continue
            rho = h[j, j] * w[j] - grad[j]
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / den
            step = new - w[j]
            if step:
                grad += h[:, j] * step
                w[j] = new
                moved = max(moved, abs(step))
        if moved <= tol * max(1.0, np.abs(w).max()):
            return w
    raise ConvergenceError(f"coordinate descent missed its tolerance after {max_iter} sweeps")


def elastic_net(m: Moments, maps, t: int, alpha: float, l1_ratio: float) -> LinearScorer:
    """Lasso at ``l1_ratio=1``. The intercept is not penalised."""
    s = LinearSystem(m, maps, t)
    y_sum = m.train("xy", t)[0]
    sxy = s.cross(m.train("xy", t)[:, None], y_sum)[:, 0]
    w = coordinate_descent(s.sxx, sxy, alpha * l1_ratio, alpha * (1 - l1_ratio), s.n)
    b = y_sum / s.n - s.mean @ w
    return LinearScorer(s.fm.pull(w[:, None], np.array([b])), VALUE)


def class_means(m: Moments, fm, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows per class, class means of prepared features [class, feature])."""
    sums = m.train("sums", t)
    n = sums[:, 0]
    pushed = fm.push(sums.T)[1:].T
    return n, pushed / np.maximum(n, 1)[:, None]


def class_variances(m: Moments, fm, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(n, means, population variances, variance over all classes)."""
    n, mu = class_means(m, fm, t)
    sums, squares = m.train("sums", t), m.train("squares", t)
    second_c = np.array([fm.second(s, q) for s, q in zip(sums, squares)])
    var = np.maximum(second_c / np.maximum(n, 1)[:, None] - mu**2, 0.0)
    total_n = n.sum()
    mean_all = (n[:, None] * mu).sum(axis=0) / total_n
    var_all = np.maximum(second_c.sum(axis=0) / total_n - mean_all**2, 0.0)
    return n, mu, var, var_all


def gaussian_bayes(m: Moments, maps, t: int, var_smoothing: float) -> QuadraticScorer:
    fm = maps[t]
    n, mu, var, var_all = class_variances(m, fm, t)
    var = var + var_smoothing * var_all.max()
    var = np.where(var > 0, var, 1e-300)
    with np.errstate(divide="ignore"):
        prior = np.log(n / n.sum())
    const = prior - 0.5 * (np.log(2 * np.pi * var) + mu**2 / var).sum(axis=1)
    return QuadraticScorer(fm.matrix, (mu / var).T, (-0.5 / var).T, const)


def multinomial_bayes(m: Moments, maps, t: int, alpha: float, fit_prior: bool = True) -> LinearScorer:
    """Smoothed feature shares per class; negative totals are rejected."""
    fm = maps[t]
    sums = m.train("sums", t)
    counts = fm.push(sums.T)[1:].T
    if (counts < 0).any():
        raise ValueError("multinomial naive Bayes needs non-negative features")
    n = sums[:, 0]
    smooth = counts + alpha
    logp = np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True))
    with np.errstate(divide="ignore"):
        prior = np.log(n / n.sum()) if fit_prior else np.where(n > 0, -np.log((n > 0).sum()), -np.inf)
    return LinearScorer(fm.pull(logp.T, np.maximum(prior, -1e300)), ARGMAX)


def ledoit_wolf_intensity(p: int, trace: float, spread: float, mean_fourth: float, n: float) -> float:
    """Optimal shrinkage toward a scaled identity of a covariance of ``p`` columns.

    ``spread`` is the sum of its squared entries, ``mean_fourth`` the mean of ‖x‖⁴.
    """
    mu = trace / p
    beta = (mean_fourth - spread) / (p * n)
    delta = (spread - p * mu * mu) / p
    beta = min(max(beta, 0.0), delta)
    return 0.0 if beta <= 0 else beta / delta


def discriminant(m: Moments, maps, t: int, solver: str = "svd", shrinkage=None,
                 fourth: np.ndarray | None = None) -> LinearScorer:
    """Linear discriminant analysis.

    ``svd`` scales the within-class scatter by n - classes; the other solvers
    weigh population covariances by the priors. ``shrinkage`` is None, a number
    or 'auto'; 'auto' needs ``fourth``: per class, the mean of ‖z‖⁴ of the
    rows standardised within the class.
    """
    fm = maps[t]
    n, mu = class_means(m, fm, t)
    total, prior = n.sum(), n / n.sum()
    d = mu.shape[1]
    if shrinkage is None:
        g = prepared_gram(fm, m.train("gram", t))[1:, 1:]
        within = g - (mu.T * n) @ mu
        cov = within / (total - (n > 0).sum()) if solver == "svd" else within / total
    else:
        cov = np.zeros((d, d))
        grams = m.train("class_gram", t) if shrinkage == "auto" else None
        if grams is None:
            g = prepared_gram(fm, m.train("gram", t))[1:, 1:]
            cov = (1 - shrinkage) * (g - (mu.T * n) @ mu) / total
            _, _, var, _ = class_variances(m, fm, t)
            cov += np.eye(d) * shrinkage * (prior * var.mean(axis=1)).sum()
        else:
            for c in range(m.n_classes):
                own = prepared_gram(fm, grams[c])[1:, 1:] / n[c] - np.outer(mu[c], mu[c])
                scale = np.sqrt(np.maximum(np.diag(own), 0))
                scale[scale < 1e-12] = 1.0
                z = own / np.outer(scale, scale)
                s = ledoit_wolf_intensity(d, np.trace(z), (z**2).sum(), fourth[c], n[c])
                z = (1 - s) * z + s * np.trace(z) / d * np.eye(d)
                cov += prior[c] * z * np.outer(scale, scale)
    # rank-revealing solve: directions without within-class spread are left out
    w = np.linalg.pinv(cov, rcond=1e-10, hermitian=True) @ mu.T
    b = np.log(np.maximum(prior, 1e-300)) - 0.5 * np.einsum("cd,dc->c", mu, w)
    if m.n_classes == 2:
        return LinearScorer(fm.pull(w[:, 1:] - w[:, :1], b[1:] - b[:1]), SIGN)
    return LinearScorer(fm.pull(w, b), ARGMAX)


def class_scales(m: Moments, fm, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Class means and deviations (zero deviation as one), for the fourth-moment pass."""
    _, mu, var, _ = class_variances(m, fm, t)
    std = np.sqrt(var)
    return mu, np.where(std < 1e-12, 1.0, std)
