"""NumPy recurrent network: forward pass, back-propagation through time and Adam.

Cell (per time step, gates from ``x·Wᵀ + b + h·Uᵀ`` split as i, f, o, g, u)::

    i, f, o, u = σ(·)   g = tanh(·)
    k = u·g + (1 - u)·k'      c = f·c' + i·k      h = o·tanh(c)

The network runs one cell forward over the window and another backward,
concatenates both final ``h`` and maps them to one output with a linear
layer.  Parameters live in one flat float64 vector; ``Layout`` names the
slices.  Used inside pandas functions on Spark groups (one window batch at
a time), never on the driver.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

# Adam defaults and the gate order of the cell.
ADAM_BETA1 = 0.9
ADAM_BETA2 = 0.999
ADAM_EPS = 1e-8
GATES = ("i", "f", "o", "g", "u")


@dataclass(frozen=True)
class Layout:
    input_size: int
    hidden: int

    def shapes(self) -> list[tuple[str, tuple[int, ...]]]:
        F, H = self.input_size, self.hidden
        out = []
        for d in ("fw", "bw"):
            out += [(f"{d}_W", (5 * H, F)), (f"{d}_b", (5 * H,)), (f"{d}_U", (5 * H, H))]
        out += [("fc_W", (1, 2 * H)), ("fc_b", (1,))]
        return out

    @property
    def size(self) -> int:
        return int(sum(np.prod(s) for _, s in self.shapes()))

    def unpack(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, o = {}, 0
        for name, shape in self.shapes():
            n = int(np.prod(shape))
            out[name] = flat[o:o + n].reshape(shape)
            o += n
        return out


def symbol_seed(seed: int, symbol: str) -> int:
    return (int(seed) * 1_000_003 + zlib.crc32(symbol.encode())) % (2 ** 32)


def init_params(layout: Layout, seed: int) -> np.ndarray:
    """Uniform(±1/√fan_in) for weights and biases of every linear map."""
    rng = np.random.default_rng(seed)
    parts = []
    for name, shape in layout.shapes():
        fan_in = {"W": layout.input_size, "b": layout.input_size,
                  "U": layout.hidden}[name.split("_")[1]] if not name.startswith("fc") \
            else 2 * layout.hidden
        bound = 1.0 / np.sqrt(fan_in)
        parts.append(rng.uniform(-bound, bound, size=int(np.prod(shape))))
    return np.concatenate(parts)


def _sig(z):
    return 1.0 / (1.0 + np.exp(-z))


def _cell_forward(X, W, b, U, order):
    """Run one cell over ``X[:, order]``; the input projection of all steps
    is one matrix product."""
    B, H = X.shape[0], U.shape[1]
    XW = (X.reshape(-1, X.shape[2]) @ W.T + b).reshape(B, X.shape[1], -1)
    h = np.zeros((B, H)); c = np.zeros((B, H)); k = np.zeros((B, H))
    cache = []
    for t in order:
        z = XW[:, t] + h @ U.T
        s = _sig(z)
        i, f, o, u = s[:, :H], s[:, H:2 * H], s[:, 2 * H:3 * H], s[:, 4 * H:]
        g = np.tanh(z[:, 3 * H:4 * H])
        kn = u * g + (1.0 - u) * k
        cn = f * c + i * kn
        tc = np.tanh(cn)
        hn = o * tc
        cache.append((t, h, c, k, i, f, o, g, u, kn, tc))
        h, c, k = hn, cn, kn
    return h, cache


def _cell_backward(dh, cache, X, U):
    """Back-propagation through time; weight gradients are accumulated with
    one product over all steps."""
    B, H = dh.shape
    dc = np.zeros_like(dh); dk = np.zeros_like(dh)
    dzs, xs, hs = [], [], []
    for t, h_prev, c_prev, k_prev, i, f, o, g, u, kn, tc in reversed(cache):
        do = dh * tc
        dct = dc + dh * o * (1.0 - tc * tc)
        dkt = dk + dct * i
        dz = np.concatenate([dct * kn * i * (1 - i), dct * c_prev * f * (1 - f),
                             do * o * (1 - o), dkt * u * (1 - g * g),
                             dkt * (g - k_prev) * u * (1 - u)], axis=1)
        dzs.append(dz); xs.append(X[:, t]); hs.append(h_prev)
        dh = dz @ U
        dc = dct * f
        dk = dkt * (1.0 - u)
    DZ = np.concatenate(dzs, axis=0)
    dW = DZ.T @ np.concatenate(xs, axis=0)
    dU = DZ.T @ np.concatenate(hs, axis=0)
    return dW, DZ.sum(0), dU


def forward(flat: np.ndarray, layout: Layout, X: np.ndarray, keep: bool = False):
    """Predictions for ``X`` of shape (batch, seq_len, input_size)."""
    p = layout.unpack(flat)
    L = X.shape[1]
    hf, cf = _cell_forward(X, p["fw_W"], p["fw_b"], p["fw_U"], range(L))
    hb, cb = _cell_forward(X, p["bw_W"], p["bw_b"], p["bw_U"], range(L - 1, -1, -1))
    hcat = np.concatenate([hf, hb], axis=1)
    out = hcat @ p["fc_W"].T + p["fc_b"]
    if keep:
        return out[:, 0], (p, hcat, cf, cb)
    return out[:, 0]


def loss_and_grad(flat: np.ndarray, layout: Layout, X: np.ndarray, y: np.ndarray):
    """Mean squared error of the batch and its gradient (flat)."""
    pred, (p, hcat, cf, cb) = forward(flat, layout, X, keep=True)
    err = pred - y
    loss = float(np.mean(err * err))
    dout = (2.0 / len(y)) * err[:, None]
    g = {"fc_W": dout.T @ hcat, "fc_b": dout.sum(0)}
    dh = dout @ p["fc_W"]
    H = layout.hidden
    g["fw_W"], g["fw_b"], g["fw_U"] = _cell_backward(dh[:, :H], cf, X, p["fw_U"])
    g["bw_W"], g["bw_b"], g["bw_U"] = _cell_backward(dh[:, H:], cb, X, p["bw_U"])
    flat_g = np.concatenate([g[name].ravel() for name, _ in layout.shapes()])
    return loss, flat_g


def adam_step(flat, m, v, step, grad, lr):
    """One Adam update in place semantics of the common deep-learning form
    (bias-corrected moments, ``eps`` added after the square root)."""
    step = step + 1
    m = ADAM_BETA1 * m + (1 - ADAM_BETA1) * grad
    v = ADAM_BETA2 * v + (1 - ADAM_BETA2) * grad * grad
    bc1 = 1 - ADAM_BETA1 ** step
    bc2 = 1 - ADAM_BETA2 ** step
    denom = np.sqrt(v) / np.sqrt(bc2) + ADAM_EPS
    flat = flat - (lr / bc1) * m / denom
    return flat, m, v, step


def minibatch_count(n: int, batch_size: int, max_steps: int) -> int:
    """Steps of an epoch: batches of ``batch_size``, larger ones where that
    would take more than ``max_steps``."""
    return max(1, min(-(-n // batch_size), max_steps))


def minibatch_of(widx: np.ndarray, seed: int, epoch: int, batches: int) -> np.ndarray:
    """Minibatch of each window in an epoch: a seeded hash of its number, so
    that every task that holds some windows deals them alike."""
    z = np.asarray(widx, np.int64).astype(np.uint64)
    z = z + np.uint64((0x9E3779B97F4A7C15 * (1 + epoch) + seed * 0xD1B54A32D192ED03) % 2 ** 64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z ^= z >> np.uint64(31)
    return (z % np.uint64(batches)).astype(np.int64)


def gradient_sum(flat, layout, X, y, at_once: int = 8192):
    """(windows, sum of squared errors, sum of their gradients), in pieces."""
    loss, grad = 0.0, np.zeros(layout.size)
    for k in range(0, len(y), at_once):
        own, g = loss_and_grad(flat, layout, X[k:k + at_once], y[k:k + at_once])
        size = len(y[k:k + at_once])
        loss += own * size
        grad += g * size
    return len(y), loss, grad


def train_batches(flat, m, v, step, layout, X, y, epochs, lr, batches):
    """Minibatch Adam over the index arrays of ``batches(epoch)``; returns the
    state and the mean batch loss of each epoch.  Empty batches are no step."""
    losses = []
    for e in range(epochs):
        total, steps = 0.0, 0
        for idx in batches(e):
            if len(idx) == 0:
                continue
            loss, g = loss_and_grad(flat, layout, X[idx], y[idx])
            flat, m, v, step = adam_step(flat, m, v, step, g, lr)
            total += loss
            steps += 1
        losses.append(total / max(steps, 1))
    return flat, m, v, step, losses


def train_epochs(flat, m, v, step, layout, X, y, epochs, batch_size, lr, rng):
    """Shuffled minibatch Adam; returns state and the mean batch loss of each
    epoch.  ``rng`` is a generator, or a function ``epoch -> generator``
    (0-based epoch within this call) for per-epoch seeding."""
    def batches(e):
        order = (rng(e) if callable(rng) else rng).permutation(len(y))
        return (order[s:s + batch_size] for s in range(0, len(y), batch_size))
    return train_batches(flat, m, v, step, layout, X, y, epochs, lr, batches)


def online_update(flat, m, v, step, layout, x_window, y_value, lr):
    """Predict one window, then learn from its observed target (one Adam
    step).  Returns (prediction before the update, loss, new state)."""
    X = x_window[None, :, :]
    pred = float(forward(flat, layout, X)[0])
    loss, g = loss_and_grad(flat, layout, X, np.array([y_value]))
    flat, m, v, step = adam_step(flat, m, v, step, g, lr)
    return pred, loss, (flat, m, v, step)
