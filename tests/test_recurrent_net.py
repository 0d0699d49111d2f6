import numpy as np

from tickforge.models import recurrent_net as N


def _scalar_cell(x, h, c, k, W, b, U):
    z = W @ x + b + U @ h
    H = len(h)
    sig = lambda t: 1 / (1 + np.exp(-t))
    i, f, o, g, u = (z[j * H:(j + 1) * H] for j in range(5))
    i, f, o, u, g = sig(i), sig(f), sig(o), sig(u), np.tanh(g)
    k = u * g + (1 - u) * k
    c = f * c + i * k
    return o * np.tanh(c), c, k


def test_forward_matches_scalar_recomputation():
    lay = N.Layout(input_size=3, hidden=4)
    flat = N.init_params(lay, 7)
    rng = np.random.default_rng(1)
    X = rng.normal(size=(5, 3, 3))
    got = N.forward(flat, lay, X)
    p = lay.unpack(flat)
    for bi in range(5):
        hs = {}
        for d, order in (("fw", [0, 1, 2]), ("bw", [2, 1, 0])):
            h = c = k = np.zeros(4)
            for t in order:
                h, c, k = _scalar_cell(X[bi, t], h, c, k, p[f"{d}_W"], p[f"{d}_b"], p[f"{d}_U"])
            hs[d] = h
        ref = p["fc_W"][0] @ np.concatenate([hs["fw"], hs["bw"]]) + p["fc_b"][0]
        assert np.isclose(got[bi], ref)


def test_gradient_matches_finite_differences():
    lay = N.Layout(input_size=2, hidden=3)
    flat = N.init_params(lay, 3)
    rng = np.random.default_rng(2)
    X = rng.normal(size=(4, 3, 2))
    y = rng.normal(size=4)
    _, g = N.loss_and_grad(flat, lay, X, y)
    eps = 1e-6
    for j in rng.choice(lay.size, 25, replace=False):
        e = np.zeros_like(flat); e[j] = eps
        lp, _ = N.loss_and_grad(flat + e, lay, X, y)
        lm, _ = N.loss_and_grad(flat - e, lay, X, y)
        assert np.isclose(g[j], (lp - lm) / (2 * eps), rtol=1e-4, atol=1e-8), j


def test_training_reduces_loss():
    lay = N.Layout(input_size=2, hidden=8)
    rng = np.random.default_rng(0)
    X = rng.uniform(size=(64, 3, 2))
    y = X[:, -1, 0] * 0.8 + 0.1
    flat = N.init_params(lay, 0)
    m = np.zeros_like(flat); v = np.zeros_like(flat)
    before = np.mean((N.forward(flat, lay, X) - y) ** 2)
    flat, m, v, step, _ = N.train_epochs(flat, m, v, 0, lay, X, y, 30, 16, 1e-2, rng)
    after = np.mean((N.forward(flat, lay, X) - y) ** 2)
    assert step == 30 * 4
    assert after < before / 4
