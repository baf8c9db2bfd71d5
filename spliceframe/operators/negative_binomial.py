"""Negative-binomial fits of counts in groups, vectorised over the rows of a batch (numpy alone)."""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, lgamma, log, sqrt

import numpy as np

#: Fixed values of the published method: dispersion's least value, least fitted mean, prior's least variance, cap of a robust dispersion's floor.
LEAST_DISPERSION, LEAST_MEAN, LEAST_PRIOR, ROBUST_FLOOR = 1e-8, 0.5, 0.25, 0.04
#: Replicates from which an outlier's count is replaced, and from which a group's outliers are judged.
REPLACE_FROM, JUDGE_FROM = 7, 3


@dataclass(frozen=True)
class Design:
    """Size factors and group numbers of the samples, in one order; the contrast is group ``treat`` over group ``control``."""

    factors: np.ndarray
    groups: np.ndarray
    control: int
    treat: int

    @property
    def indicator(self) -> np.ndarray:
        return (self.groups[:, None] == np.unique(self.groups)[None]).astype(float)

    @property
    def columns(self) -> int:
        return len(np.unique(self.groups))


@dataclass(frozen=True)
class Trend:
    """Dispersion over the mean: slope / mean + base; the variance of the logarithms about it, and the prior's, that without sampling noise."""

    slope: float
    base: float
    spread: float
    prior: float

    def at(self, mean: np.ndarray) -> np.ndarray:
        return np.maximum(self.slope / np.maximum(mean, 1e-300) + self.base, LEAST_DISPERSION)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after seven steps up."""
    x = np.asarray(x, float)
    steps = sum(np.log(x + k) for k in range(7))
    y = x + 7
    i = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.91893853320467274178 + (1 / 12 - i * (1 / 360 - i * (1 / 1260 - i / 1680))) / y - steps


def trigamma(x: float) -> float:
    total = 0.0
    while x < 10:
        total, x = total + 1 / (x * x), x + 1
    i = 1 / (x * x)
    return total + 1 / x + i / 2 + i / x * (1 / 6 - i * (1 / 30 - i * (1 / 42 - i / 30)))


def two_sided(z: np.ndarray) -> np.ndarray:
    from math import erfc

    return np.array([erfc(abs(v) / sqrt(2)) if np.isfinite(v) else np.nan for v in z])


def f_upper(x: float, a: float, b: float) -> float:
    """P(F > x) with a and b degrees of freedom, by the incomplete beta's continued fraction."""
    if x <= 0:
        return 1.0
    p, q, z = b / 2, a / 2, b / (b + a * x)
    flip = z > (p + 1) / (p + q + 2)
    if flip:
        p, q, z = q, p, 1 - z
    c = 1.0
    d = h = 1 / (1 - (p + q) * z / (p + 1))
    for m in range(1, 400):
        turn = 1.0
        for t in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
            d, c = 1 / (1 + t * d), 1 + t / c
            turn = c * d
            h *= turn
        if abs(turn - 1) < 1e-15:
            break
    share = h * exp(lgamma(p + q) - lgamma(p) - lgamma(q) + p * log(z) + q * log(1 - z)) / p
    return 1 - share if flip else share


def f_quantile(upper: float, a: float, b: float) -> float:
    lo, hi = 0.0, 1.0
    while f_upper(hi, a, b) > upper:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f_upper(mid, a, b) > upper else (lo, mid)
    return (lo + hi) / 2


def likelihood(counts: np.ndarray, mu: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """log likelihood of each row, without what doesn't hang on mu or alpha."""
    r = 1 / alpha[:, None]
    return (log_gamma(counts + r) - log_gamma(r) - (counts + r) * np.log1p(mu * alpha[:, None]) + counts * (np.log(mu) + np.log(alpha)[:, None])).sum(1)


def group_means(counts: np.ndarray, design: Design) -> np.ndarray:
    """Means that the groups' normalised averages give, at least LEAST_MEAN."""
    x = design.indicator
    q = (counts / design.factors) @ x / x.sum(0)
    return np.maximum(q @ x.T * design.factors, LEAST_MEAN)


def dispersions(counts: np.ndarray, mu: np.ndarray, design: Design, prior: np.ndarray | None = None, variance: float = 0.0) -> np.ndarray:
    """The dispersion of each row that maximises the Cox-Reid adjusted likelihood, with a log-normal prior where one is given.

    A grid over the logarithm brackets the maximum, golden sections narrow it.
    """
    x = design.indicator

    def value(a: np.ndarray) -> np.ndarray:
        alpha = np.exp(a)
        weights = 1 / (1 / mu + alpha[:, None])
        found = likelihood(counts, mu, alpha) - 0.5 * np.log(weights @ x).sum(1)
        return found if prior is None else found - (a - np.log(prior)) ** 2 / (2 * variance)

    grid = np.linspace(log(LEAST_DISPERSION), log(max(10.0, counts.shape[1])), 60)
    best = np.argmax(np.stack([value(np.full(len(counts), g)) for g in grid], axis=1), axis=1)
    lo, hi = grid[np.maximum(best - 1, 0)], grid[np.minimum(best + 1, len(grid) - 1)]
    golden = (sqrt(5) - 1) / 2
    a, b = hi - golden * (hi - lo), lo + golden * (hi - lo)
    fa, fb = value(a), value(b)
    for _ in range(40):
        left = fa > fb
        lo, hi = np.where(left, lo, a), np.where(left, b, hi)
        a, b = hi - golden * (hi - lo), lo + golden * (hi - lo)
        fa, fb = value(a), value(b)
    return np.exp((lo + hi) / 2)


def means(counts: np.ndarray, alpha: np.ndarray, design: Design) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of each group's normalised mean by iterated weighted least squares, and the weights at the end.

    A group without counts goes down until the likelihood stands still or 30 below.
    """
    x = design.indicator
    eta = np.log((counts / design.factors) @ x / x.sum(0) + 0.1)
    last = np.full(len(counts), -np.inf)
    open_ = np.ones(len(counts), bool)
    for _ in range(100):
        mu = np.maximum(np.exp(eta) @ x.T * design.factors, LEAST_MEAN)
        w = mu / (1 + alpha[:, None] * mu)
        z = np.log(mu / design.factors) + (counts - mu) / mu
        eta = np.where(open_[:, None], np.clip((w * z) @ x / (w @ x + 1e-6), -30, 30), eta)
        now = likelihood(counts, np.maximum(np.exp(eta) @ x.T * design.factors, LEAST_MEAN), alpha)
        open_ &= np.abs(now - last) > 1e-10 * (np.abs(now) + 0.1)
        last = now
        if not open_.any():
            break
    mu = np.maximum(np.exp(eta) @ x.T * design.factors, LEAST_MEAN)
    return eta, mu / (1 + alpha[:, None] * mu)


def _trimmed(values: np.ndarray, share: float) -> np.ndarray:
    cut = int(values.shape[1] * share)
    return np.sort(values, axis=1)[:, cut : values.shape[1] - cut].mean(1)


def robust_dispersions(counts: np.ndarray, design: Design) -> np.ndarray:
    """By moments, from each group's trimmed variance about its trimmed mean; the largest group's counts."""
    normal = counts / design.factors
    found = []
    for g in np.unique(design.groups):
        v = normal[:, design.groups == g]
        n = v.shape[1]
        if n < JUDGE_FROM:
            continue
        share, scale = (1 / 3, 2.04) if n <= 3.5 else (1 / 4, 1.86) if n <= 23.5 else (1 / 8, 1.51)
        found.append(scale * _trimmed((v - _trimmed(v, share)[:, None]) ** 2, share))
    if not found:
        share, scale = (1 / 3, 2.04) if normal.shape[1] <= 3.5 else (1 / 4, 1.86) if normal.shape[1] <= 23.5 else (1 / 8, 1.51)
        found = [scale * _trimmed((normal - _trimmed(normal, share)[:, None]) ** 2, share)]
    mean = normal.mean(1)
    return np.maximum((np.max(found, axis=0) - mean) / np.maximum(mean, 1e-300) ** 2, ROBUST_FLOOR)


def cooks(counts: np.ndarray, eta: np.ndarray, weights: np.ndarray, design: Design) -> np.ndarray:
    """Cook's distance of every count."""
    x = design.indicator
    mu = np.maximum(np.exp(eta) @ x.T * design.factors, LEAST_MEAN)
    hat = weights / np.maximum((weights @ x) @ x.T, 1e-300)
    spread = mu + robust_dispersions(counts, design)[:, None] * mu * mu
    return (counts - mu) ** 2 / spread * hat / np.maximum(1 - hat, 1e-12) ** 2 / design.columns


def _tested(counts: np.ndarray, design: Design, trend: Trend) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Dispersion, fold change and Wald test of each row, with the groups' means and weights behind them."""
    mu = group_means(counts, design)
    rowwise, toward = dispersions(counts, mu, design), trend.at((counts / design.factors).mean(1))
    above = np.log(rowwise) > np.log(toward) + 2 * sqrt(trend.spread)
    alpha = np.where(above, rowwise, dispersions(counts, mu, design, toward, trend.prior))
    eta, weights = means(counts, alpha, design)
    names = list(np.unique(design.groups))
    t, c = names.index(design.treat), names.index(design.control)
    total = np.maximum(weights @ design.indicator, 1e-300)
    lfc = (eta[:, t] - eta[:, c]) / log(2)
    se = np.sqrt(1 / total[:, t] + 1 / total[:, c]) / log(2)
    return {"dispersion": alpha, "lfc": lfc, "lfc_se": se, "stat": lfc / se, "pvalue": two_sided(lfc / se)}, eta, weights


def fit(counts: np.ndarray, design: Design, trend: Trend) -> dict[str, np.ndarray]:
    """dispersion, lfc, lfc_se, stat, pvalue, and outlier: whether a count keeps its row from being tested.

    The shrunk dispersion gives way to the row's own where that lies two deviations over the trend. A count whose
    Cook's distance passes F's 99th percentile, in a group of JUDGE_FROM or more, is replaced by the trimmed mean and
    the row fitted again if its group has REPLACE_FROM, else the row gets no p, unless three counts are larger still.
    """
    out, eta, weights = _tested(counts, design, trend)
    out["outlier"] = np.zeros(len(counts), bool)
    free = counts.shape[1] - design.columns
    size = np.array([(design.groups == g).sum() for g in design.groups])
    if free <= 0 or not (size >= JUDGE_FROM).any():
        return out
    far = (cooks(counts, eta, weights, design) > f_quantile(0.01, design.columns, free)) & (size >= JUDGE_FROM)
    replace, left = far & (size >= REPLACE_FROM), far & (size < REPLACE_FROM)
    worst = np.where(left, counts, -1).max(1)
    out["outlier"] = left.any(1) & ((counts > worst[:, None]).sum(1) < 3)
    rows = np.flatnonzero(replace.any(1))
    if len(rows):
        middle = _trimmed(counts[rows] / design.factors, 0.2)[:, None] * design.factors
        again = _tested(np.where(replace[rows], np.floor(middle), counts[rows]), design, trend)[0]
        for name, values in again.items():
            out[name][rows] = values
    out["pvalue"] = np.where(out["outlier"], np.nan, out["pvalue"])
    return out


def lowess(x: np.ndarray, y: np.ndarray, share: float = 0.2, rounds: int = 3) -> np.ndarray:
    """Locally weighted lines with robust weights."""
    n = len(x)
    near, robust, fitted = max(2, int(share * n + 1e-7)), np.ones(n), y.astype(float)
    for turn in range(rounds + 1):
        for i in range(n):
            d = np.abs(x - x[i])
            h = np.sort(d)[near - 1]
            w = np.where(d <= 0.001 * h, 1.0, (1 - np.minimum(d / h, 1) ** 3) ** 3) * (d < 0.999 * h) * robust if h > 0 else (d == 0) * robust
            if w.sum() <= 0:
                fitted[i] = y[i]
                continue
            w = w / w.sum()
            mx, my = (w * x).sum(), (w * y).sum()
            sxx = (w * (x - mx) ** 2).sum()
            fitted[i] = my + ((w * (x - mx) * (y - my)).sum() / sxx * (x[i] - mx) if sxx > 1e-12 * (x[-1] - x[0]) ** 2 else 0.0)
        residual = np.abs(y - fitted)
        scale = 6 * np.median(residual)
        if turn == rounds or scale < 1e-7 * residual.mean() or scale == 0:
            break
        robust = np.where(residual <= 0.001 * scale, 1.0, np.where(residual > 0.999 * scale, 0.0, (1 - np.minimum(residual / scale, 1) ** 2) ** 2))
    return fitted
