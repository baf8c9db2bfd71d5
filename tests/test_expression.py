"""Differential expression against plain loops over genes: scalar likelihoods, sorted lists, no batches."""

from math import erfc, exp, lgamma, log, sqrt

import numpy as np
import pytest

from spliceframe.operators import expression
from spliceframe.operators import negative_binomial as nb

SAMPLES = [(f"s{k}", "control" if k < 4 else "treat") for k in range(8)]


def simulated(genes=220, seed=3):
    r = np.random.default_rng(seed)
    mean = np.exp(r.normal(4, 1.4, genes))
    shift = np.where(np.arange(genes) % 6 == 0, 2.5, 0.0)
    size = np.array([0.6, 1.0, 1.4, 0.9, 1.2, 0.8, 1.1, 1.0])
    mu = mean[:, None] * size * np.where(np.arange(8) >= 4, 2.0 ** shift[:, None], 1.0)
    alpha = (0.05 + 2 / mean)[:, None] * np.exp(r.normal(0, 0.4, (genes, 1)))
    counts = r.negative_binomial(1 / alpha, 1 / (1 + alpha * mu))
    counts[5] = 0
    counts[7] = [0, 0, 0, 0, 40, 35, 60, 28]
    counts[11, 2] = 90_000
    return counts


@pytest.fixture(scope="module")
def counts():
    return simulated()


def best(f, lo, hi):
    """Where f is largest, by ever finer grids."""
    for _ in range(9):
        grid = [lo + (hi - lo) * k / 40 for k in range(41)]
        k = max(range(41), key=lambda k: f(grid[k]))
        lo, hi = grid[max(k - 1, 0)], grid[min(k + 1, 40)]
    return (lo + hi) / 2


def loglik(row, mu, alpha):
    return sum(lgamma(k + 1 / alpha) - lgamma(1 / alpha) - (k + 1 / alpha) * log(1 + m * alpha) + k * (log(m) + log(alpha)) for k, m in zip(row, mu))


def brute(counts):
    n = counts.shape[1]
    full = counts[(counts > 0).all(1)]
    logs = np.log(full)
    factors = np.round(np.exp(np.median(logs - logs.mean(1)[:, None], axis=0)), 6)
    halves = [range(4), range(4, 8)]
    genes = [g for g in range(len(counts)) if counts[g].any()]
    mean = {g: float(np.mean(counts[g] / factors)) for g in genes}

    def averaged(row):
        return [max(factors[j] * np.mean([row[i] / factors[i] for i in halves[j // 4]]), 0.5) for j in range(n)]

    def dispersion(row, prior=None, variance=1.0):
        mu = averaged(row)

        def value(a):
            alpha = exp(a)
            adjusted = loglik(row, mu, alpha) - 0.5 * sum(log(sum(1 / (1 / mu[j] + alpha) for j in h)) for h in halves)
            return adjusted - (0 if prior is None else (a - log(prior)) ** 2 / (2 * variance))

        return exp(best(value, log(1e-8), log(10)))

    own = {g: dispersion(counts[g]) for g in genes}
    used = [g for g in genes if own[g] >= 1e-6]
    x, y = np.array([1 / mean[g] for g in used]), np.array([own[g] for g in used])
    slope, base = 1.0, 0.1
    for _ in range(10):
        old = (slope, base)
        keep = (y / (slope * x + base) >= 1e-4) & (y / (slope * x + base) <= 15)
        for _ in range(50):
            w = 1 / (slope * x[keep] + base) ** 2
            a = np.array([[(w * x[keep] ** 2).sum(), (w * x[keep]).sum()], [(w * x[keep]).sum(), w.sum()]])
            slope, base = np.linalg.solve(a, [(w * x[keep] * y[keep]).sum(), (w * y[keep]).sum()])
        if log(slope / old[0]) ** 2 + log(base / old[1]) ** 2 < 1e-6:
            break
    lower = lambda v: sorted(v)[(len(v) + 1) // 2 - 1]
    off = np.log(y) - np.log(slope * x + base)
    spread = (lower(np.abs(off - lower(off))) * 1.4826) ** 2
    trigamma = sum(1 / (3 + k) ** 2 for k in range(2_000_000))  # of half the 6 free degrees
    prior = max(spread - trigamma, 0.25)
    cut = nb.f_quantile(0.01, 2, 6)
    found = {}
    for g in genes:
        row, toward = counts[g], slope / mean[g] + base
        alpha = own[g] if log(own[g]) > log(toward) + 2 * sqrt(spread) else dispersion(row, toward, prior)
        eta = []
        for h in halves:
            total = [row[j] for j in h]
            eta.append(best(lambda e: loglik(total, [max(factors[j] * exp(e), 0.5) for j in h], alpha), -8, 14))
        mu = [max(factors[j] * exp(eta[j // 4]), 0.5) for j in range(n)]
        weight = [m / (1 + alpha * m) for m in mu]
        sums = [sum(weight[j] for j in h) for h in halves]
        lfc, se = (eta[1] - eta[0]) / log(2), sqrt(1 / sums[0] + 1 / sums[1]) / log(2)
        normal = row / factors
        variance = 0.0
        for h in halves:
            v = np.array([normal[j] for j in h])
            middle = np.sort(v)[1:3].mean()
            variance = max(variance, 1.86 * np.sort((v - middle) ** 2)[1:3].mean())
        robust = max((variance - mean[g]) / mean[g] ** 2, 0.04)
        cooks = [(row[j] - mu[j]) ** 2 / (mu[j] + robust * mu[j] ** 2) * (hat := weight[j] / sums[j // 4]) / (1 - hat) ** 2 / 2 for j in range(n)]
        far = [row[j] for j in range(n) if cooks[j] > cut]
        outlier = bool(far) and sum(k > max(far) for k in row) < 3
        found[g] = (alpha, lfc, se, None if outlier else erfc(abs(lfc / se) / sqrt(2)))
    return factors, (slope, base, spread, prior), mean, found


def stepped(ps):
    order = sorted(range(len(ps)), key=lambda k: -ps[k])
    least, out = 1.0, [0.0] * len(ps)
    for place, k in enumerate(order):
        least = min(least, ps[k] * len(ps) / (len(ps) - place))
        out[k] = least
    return out


def test_fits_against_plain_loops(spark, counts):
    rows = [(f"g{g:03d}", s, int(counts[g, k])) for g in range(len(counts)) for k, (s, _) in enumerate(SAMPLES) if counts[g, k] or g == 5]
    matrix, sheet = spark.createDataFrame(rows, "gene_id string, sample_id string, n long"), spark.createDataFrame(SAMPLES, "sample_id string, grp string")
    got = {r["gene_id"]: r for r in expression.differential_expression(matrix, sheet).collect()}
    factors, shape, mean, want = brute(counts)
    assert len(got) == len(counts)
    nothing = got["g005"]
    assert nothing["base_mean"] is nothing["lfc"] is nothing["pvalue"] is nothing["padj"] is None and nothing["de_status"] == ""
    for g, (alpha, lfc, se, p) in want.items():
        r = got[f"g{g:03d}"]
        assert r["base_mean"] == pytest.approx(mean[g], rel=1e-9)
        assert r["dispersion"] == pytest.approx(alpha, rel=2e-3)
        if g == 7:
            assert r["lfc"] > 4 and r["pvalue"] is not None
        # means under the least fitted one leave the plain likelihood flat
        if min(np.mean(counts[g, h] / factors[h]) for h in (slice(0, 4), slice(4, 8))) > 3:
            assert (r["pvalue"] is None) == (p is None), g
            assert r["lfc"] == pytest.approx(lfc, abs=3e-3) and r["lfc_se"] == pytest.approx(se, rel=5e-3)
            assert p is None or r["pvalue"] == pytest.approx(p, rel=0.03, abs=1e-9)
    assert got["g011"]["pvalue"] is None and got["g007"]["de_status"] == "wald"
    # the adjusted p of exactly those over one mean, by the step-up rule
    adjusted = [r for r in got.values() if r["padj"] is not None]
    least = min(r["base_mean"] for r in adjusted)
    same = [r for r in got.values() if r["pvalue"] is not None and r["base_mean"] >= least]
    assert len(same) == len(adjusted)
    assert [r["padj"] for r in same] == pytest.approx(stepped([r["pvalue"] for r in same]))
    hits = {int(i[1:]) for i, r in got.items() if r["de_status"] == "wald"}
    truth = {g for g in range(len(counts)) if g % 6 == 0 and mean[g] > 20} | {7}
    assert len(truth & hits) > 0.8 * len(truth) and len(hits - truth - {g for g in range(0, len(counts), 6)}) <= 4


def test_filter_against_every_cut(spark):
    r = np.random.default_rng(8)
    rows = [(f"g{k}", float(m := np.exp(r.normal(2, 2))), float(r.uniform() ** (6 if m > 15 and k % 3 == 0 else 1))) for k in range(900)] + [("none", 0.0, None)]
    tested = spark.createDataFrame(rows, "gene_id string, mean double, pvalue double")
    theta = np.linspace(1 / 901, 0.95, 50)
    means_ = sorted(x[1] for x in rows)
    cuts = [means_[max(int(np.ceil(t * 901 - 1e-9)), 1) - 1] for t in theta]
    passed = []
    for c in cuts:
        ps = sorted(p for _, m, p in rows if p is not None and m >= c)
        passed.append(max((k + 1 for k, p in enumerate(ps) if p <= 0.05 * (k + 1) / len(ps)), default=0))
    passed = np.array(passed, float)
    smooth = nb.lowess(theta, passed)
    off = (passed - smooth)[passed > 0]
    want = cuts[int(np.flatnonzero(passed > smooth.max() - sqrt((off**2).mean()))[0])]
    assert passed.max() > 10 and expression._filter_cut(tested, 0.05) == want


def test_numbers_of_the_method():
    assert nb.f_quantile(0.01, 2, 4) == pytest.approx(18.0, rel=1e-6)
    assert nb.f_quantile(0.01, 2, 10) == pytest.approx(7.559432, rel=1e-6)
    assert nb.f_quantile(0.05, 5, 3) == pytest.approx(9.013455, rel=1e-6)
    assert nb.trigamma(3.0) == pytest.approx(0.3949340668482264, rel=1e-10)
    x = np.array([1e-3, 0.5, 1, 3.3, 50, 1e6])
    assert nb.log_gamma(x) == pytest.approx([lgamma(v) for v in x], rel=1e-10, abs=1e-10)
    line = np.linspace(0, 1, 50)
    assert nb.lowess(line, 3 * line + 1) == pytest.approx(3 * line + 1)


def test_outlier_of_a_large_group_is_replaced():
    r = np.random.default_rng(2)
    counts = r.negative_binomial(10, 10 / (10 + 100), (3, 16)).astype(float)
    spoiled = counts.copy()
    spoiled[0, 3] = 50_000
    d = nb.Design(np.ones(16), np.arange(16) // 8, 0, 1)
    shape = nb.Trend(1.0, 0.1, 0.3, 0.3)
    a, b = nb.fit(counts, d, shape), nb.fit(spoiled, d, shape)
    assert not b["outlier"].any() and abs(a["lfc"][0] - b["lfc"][0]) < 0.5
    assert (a["pvalue"][1:] == b["pvalue"][1:]).all()


def test_sheets_that_cannot_be_fitted(spark):
    matrix = spark.createDataFrame([("g", "a", 0), ("h", "b", 4)], "gene_id string, sample_id string, n long")
    with pytest.raises(ValueError, match="samples of control and treat"):
        expression.differential_expression(matrix, spark.createDataFrame([("a", "control"), ("b", "control")], "sample_id string, grp string"))
    with pytest.raises(ValueError, match="no size factor"):
        expression.differential_expression(matrix, spark.createDataFrame([("a", "control"), ("b", "treat")], "sample_id string, grp string"))
