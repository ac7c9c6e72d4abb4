"""Fits against finite differences and golden cases."""

import math

import numpy as np
import pytest

from medley.operators.posterior import InferenceOptions, Model, digamma, effective_size, fit_map, fit_nuts, fit_vi, infer, log_gamma, split_r_hat

TWIN_T = np.array([[1.0, 0, 0], [0, 0.5, 0.5]])
TWIN_M = np.array([[0.5, 0.5, 0], [0.5, 0.5, 0], [0, 0, 1.0]])


def test_log_gamma():
    x = np.array([1e-6, 0.3, 1.0, 7.5, 1e5])
    assert np.allclose(log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-13, atol=1e-12)


def test_digamma():
    assert np.allclose(digamma(np.array([1.0, 0.5, 30.0])), [-0.5772156649015329, -1.9635100260214235, 3.3844381326635493], atol=1e-12)


@pytest.mark.parametrize("likelihood", ["dirichlet_multinomial", "multinomial"])
@pytest.mark.parametrize("jacobian", [True, False])
@pytest.mark.parametrize("log_s", [0.1, math.log(2.0)])  # at 2 the diagonal entries of 0.3 and 0.4 are clamped
def test_gradients(likelihood, jacobian, log_s):
    rng = np.random.default_rng(1)
    o = InferenceOptions(likelihood=likelihood)
    m = Model(TWIN_T, np.array([[0.3, 0.6, 0.1], [0.2, 0.4, 0.4], [0.1, 0.1, 0.8]]), np.array([30.0, 40, 30]), o)
    x, z = rng.normal(size=4) * 0.3, np.array([0.9, 0.4])
    x[2] = log_s
    _, grad, d_z, _ = m.joint(x, z, jacobian)
    for i in range(4):
        e = np.zeros(4)
        e[i] = 1e-5
        assert grad[i] == pytest.approx((m.joint(x + e, z, jacobian)[0] - m.joint(x - e, z, jacobian)[0]) / 2e-5, abs=2e-4)
    for i in range(2):
        e = np.zeros(2)
        e[i] = 1e-5
        assert d_z[i] == pytest.approx((m.joint(x, z + e, jacobian)[0] - m.joint(x, z - e, jacobian)[0]) / 2e-5, abs=2e-4)


def test_confusion_is_clamped_and_renormalised():
    t, m, y = np.eye(3), np.array([[0.3, 0.7, 0], [0, 0.3, 0.7], [0.7, 0, 0.3]]), np.array([50.0, 30, 20])
    model = Model(t, m, y, InferenceOptions())
    for s in (0.5, 1.0, 1.5, 1.9, 3.0):
        plain = np.maximum((1 - s) * np.eye(3) + s * m, 0)
        plain /= plain.sum(1, keepdims=True)
        r = np.array([0.5, 0.3, 0.2])
        assert np.allclose(model.confused(r, s)[0], r @ plain)
    value = model.likelihood(np.array([0.2, 0.5, 0.3]), np.ones(3), 1.9, 3.0)[0]
    assert -1000 < value < 0


def test_effective_size():
    r = np.random.default_rng(3)
    x = np.zeros((4000, 2))
    x[:, 0] = r.normal(size=4000)
    for i in range(1, 4000):  # an autoregressive chain has n (1 - a) / (1 + a)
        x[i, 1] = 0.8 * x[i - 1, 1] + r.normal()
    n = effective_size(x)
    assert n[0] > 3200 and 300 < n[1] < 640
    assert effective_size(np.ones((10, 1)))[0] == 10


def test_gate_density_and_gradients():
    m = Model(TWIN_T, TWIN_M, np.array([1.0, 1, 1]), InferenceOptions(presence_temp=1.3))
    y = np.linspace(-60, 60, 200_001)
    dens = np.exp([m.gate(np.array([v]), 0.7)[0] for v in y[::100]])
    assert dens.sum() * (y[100] - y[0]) == pytest.approx(1, abs=1e-3)
    v, l = np.array([0.3]), np.array([-1.0])
    _, by_value, by_location = m.gate(v, l)
    assert by_value[0] == pytest.approx((m.gate(v + 1e-6, l)[0] - m.gate(v - 1e-6, l)[0]) / 2e-6, abs=1e-5)
    assert by_location[0] == pytest.approx((m.gate(v, l + 1e-6)[0] - m.gate(v, l - 1e-6)[0]) / 2e-6, abs=1e-5)


def test_map_tells_identical_references_apart():
    theta = np.array([0.05, 0.95])
    y = np.round(20_000 * theta @ TWIN_T @ TWIN_M)
    naive = y[0] / y.sum()
    fit, _, losses = fit_map(Model(TWIN_T, TWIN_M, y, InferenceOptions()), np.array([naive, 1 - naive]), InferenceOptions(mode="mle", presence=False, steps=2000))
    assert naive > 0.2
    assert abs(fit[0] - theta).max() < 0.03
    assert losses[-1] < losses[0]


def test_vi_gate_drops_the_absent_genome():
    t, m, theta = np.eye(4), 0.8 * np.eye(4) + 0.05, np.array([0.5, 0.3, 0.2, 0])
    y = np.round(20_000 * theta @ m)
    o = InferenceOptions(steps=2000, num_samples=200)
    start = np.maximum(y / y.sum(), 1e-4)
    gated, presence, _ = fit_vi(Model(t, m, y, o), start / start.sum(), o)
    free, _, _ = fit_vi(Model(t, m, y, o), start / start.sum(), InferenceOptions(steps=2000, num_samples=200, presence=False))
    assert (presence >= 0.5).tolist() == [True, True, True, False]
    assert gated.mean(0)[3] < 0.25 * max(free.mean(0)[3], 1e-3)
    assert abs(gated.mean(0) - theta).sum() < 0.1


def test_nuts_agrees_with_truth():
    t, m, theta = np.eye(3), 0.9 * np.eye(3) + 0.1 / 3, np.array([0.6, 0.3, 0.1])
    y = np.round(5_000 * theta @ m)
    o = InferenceOptions(mode="nuts", presence=False, warmup=150, num_samples=150)
    draws, _, _ = fit_nuts(Model(t, m, y, o), np.array([0.4, 0.3, 0.3]), o)
    assert abs(draws.mean(0) - theta).max() < 0.05
    assert (split_r_hat(draws) < 1.3).all()


def test_options_are_checked():
    with pytest.raises(ValueError):
        InferenceOptions(mode="nuts", presence=True)
    for bad in ({"mode": "other"}, {"alpha": 0.0}, {"steps": 0}, {"presence_prior": 1.0}, {"likelihood": "other"}):
        with pytest.raises(ValueError):
            InferenceOptions(**bad)


def test_map_gate_drops_the_absent_genome():
    t, m, theta = np.eye(4), 0.8 * np.eye(4) + 0.05, np.array([0.5, 0.3, 0.2, 0])
    y = np.round(20_000 * theta @ m)
    start = np.maximum(y / y.sum(), 1e-4)
    point, presence, _ = fit_map(Model(t, m, y, InferenceOptions()), start / start.sum(), InferenceOptions(mode="mle", steps=2000))
    assert (presence >= 0.5).tolist() == [True, True, True, False] and point[0, 3] < 1e-9 and abs(point[0] - theta).sum() < 0.1


def test_infer_runs_samples_in_parallel(spark):
    obs = spark.createDataFrame([(s, f"r{i}", n) for s, ns in (("a", (50, 30, 20)), ("b", (10, 10, 80))) for i, n in enumerate(ns)], "sample string, refseq string, n long")
    t = spark.createDataFrame([("g1", "r0", 1.0), ("g2", "r1", 0.5), ("g2", "r2", 0.5)], "genome string, refseq string, weight double")
    m = spark.createDataFrame([(f"r{i}", f"r{i}", 1.0) for i in range(3)], "src string, dst string, p double")
    fits = infer(obs, t, m, InferenceOptions(mode="mle", presence=False, steps=300))
    out, loss = fits.composition, fits.loss
    got = {(r.sample, r.genome_id): r for r in out.collect()}
    assert len(got) == 4 and got["a", "g1"].inferred_lo is None and got["a", "g1"].presence_prob is None
    assert got["a", "g1"].observed_rel_abundance == pytest.approx(0.5)
    assert got["a", "g1"].inferred_mean > 2 * got["b", "g1"].inferred_mean
    assert loss.where("sample = 'b'").count() == 300
    with pytest.raises(Exception, match="no mapped reads"):
        infer(obs.selectExpr("sample", "refseq", "0L as n"), t, m, InferenceOptions(mode="mle", presence=False, steps=5))
    chains = infer(obs, t, m, InferenceOptions(mode="nuts", presence=False, warmup=30, num_samples=40)).chains.collect()
    assert len(chains) == 4 and all(r.n_eff > 1 and r.r_hat > 0.5 for r in chains)
