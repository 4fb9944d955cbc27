"""A small bidirectional LSTM and Adam in numpy, for models that are trained on the driver and run inside tasks."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


def init_bilstm(rng: np.random.Generator, inputs: int, hidden: int, outputs: int) -> dict[str, np.ndarray]:
    """Parameters: input, recurrent and bias weights of both directions (gates i, f, o, g) and the output layer."""
    out: dict[str, np.ndarray] = {}
    for d in "fb":
        out[f"W{d}"] = rng.normal(0, 1 / np.sqrt(inputs), (inputs, 4 * hidden)).astype(np.float32)
        out[f"U{d}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden)).astype(np.float32)
        out[f"b{d}"] = np.zeros(4 * hidden, np.float32)
        out[f"b{d}"][hidden : 2 * hidden] = 1.0
    out["V"] = rng.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, outputs)).astype(np.float32)
    out["c"] = np.zeros(outputs, np.float32)
    return out


def backwards(lengths: np.ndarray, steps: int) -> np.ndarray:
    """Per row, the step read at each step when the sequence is read from its end; padding stays behind."""
    at = np.arange(steps)[None, :]
    return np.where(at < lengths[:, None], lengths[:, None] - 1 - at, at)


def _run(gates: np.ndarray, recurrent: np.ndarray, keep: bool):
    rows, steps, width = gates.shape
    n = width // 4
    h = np.zeros((rows, n), np.float32)
    c = np.zeros((rows, n), np.float32)
    out = np.empty((rows, steps, n), np.float32)
    held = []
    for t in range(steps):
        z = gates[:, t] + h @ recurrent
        s = _sigmoid(z[:, : 3 * n])
        g = np.tanh(z[:, 3 * n :])
        before = (h, c)
        c = s[:, n : 2 * n] * c + s[:, :n] * g
        tc = np.tanh(c)
        h = s[:, 2 * n :] * tc
        out[:, t] = h
        if keep:
            held.append((s, g, tc, *before))
    return out, held


def forward(params: dict, x: np.ndarray, lengths: np.ndarray, keep: bool = False):
    """Output scores (rows, steps, outputs) of padded sequences ``x`` (rows, steps, inputs), and what ``backward`` needs."""
    rows, steps, _ = x.shape
    turn = backwards(lengths, steps)
    row = np.arange(rows)[:, None]
    states, held = [], []
    for d in "fb":
        read = x if d == "f" else x[row, turn]
        gates = (read.reshape(rows * steps, -1) @ params[f"W{d}"] + params[f"b{d}"]).reshape(rows, steps, -1)
        out, kept = _run(gates, params[f"U{d}"], keep)
        states.append(out if d == "f" else out[row, turn])
        held.append((read, out, kept))
    both = np.concatenate(states, axis=2)
    return both @ params["V"] + params["c"], (both, held, turn)


def backward(params: dict, cache, dscores: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of all parameters for the gradient of the scores (zero on padding)."""
    both, held, turn = cache
    rows, steps, _ = dscores.shape
    row = np.arange(rows)[:, None]
    flat = dscores.reshape(rows * steps, -1)
    grads = {"V": both.reshape(rows * steps, -1).T @ flat, "c": flat.sum(0)}
    dboth = dscores @ params["V"].T
    n = dboth.shape[2] // 2
    for k, d in enumerate("fb"):
        read, out, kept = held[k]
        dout = dboth[:, :, k * n : (k + 1) * n]
        if d == "b":
            dout = dout[row, turn]
        u = params[f"U{d}"]
        dgates = np.empty((rows, steps, 4 * n), np.float32)
        du = np.zeros_like(u)
        dh, dc = np.zeros((rows, n), np.float32), np.zeros((rows, n), np.float32)
        for t in range(steps - 1, -1, -1):
            s, g, tc, h0, c0 = kept[t]
            i, f, o = s[:, :n], s[:, n : 2 * n], s[:, 2 * n :]
            dh = dh + dout[:, t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate(
                [dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1
            )
            dgates[:, t] = dz
            du += h0.T @ dz
            dh, dc = dz @ u.T, dc * f
        flat_gates = dgates.reshape(rows * steps, -1)
        grads[f"W{d}"] = read.reshape(rows * steps, -1).T @ flat_gates
        grads[f"U{d}"] = du
        grads[f"b{d}"] = flat_gates.sum(0)
    return grads


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float = 0.01, clip: float = 5.0):
        self.params, self.rate, self.clip, self.step = params, rate, clip, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def update(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale = min(1.0, self.clip / (size + 1e-9))
        for k, g in grads.items():
            g = g * scale
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            m, v = self.m[k] / (1 - 0.9**self.step), self.v[k] / (1 - 0.999**self.step)
            self.params[k] -= (self.rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
