"""A gated recurrent layer in numpy, and Adam; shared by the models that are trained here."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def gru_forward(inputs: np.ndarray, u: np.ndarray, h: np.ndarray, fresh: np.ndarray | None = None, keep: bool = False):
    """States after each step (T, B, H). ``inputs`` (T, B, 3H) are the projected inputs (update, reset, new gate).

    ``fresh`` (T, B) marks steps that begin from the zero state. With ``keep``, also what the backward pass needs."""
    size = u.shape[0]
    states = np.empty((*inputs.shape[:2], size), np.float32)
    kept = []
    for t in range(len(inputs)):
        if fresh is not None:
            h = np.where(fresh[t][:, None], np.float32(0), h)
        g, v = inputs[t], h @ u
        zr = sigmoid(g[:, :2 * size] + v[:, :2 * size])
        z, r = zr[:, :size], zr[:, size:]
        n = np.tanh(g[:, 2 * size:] + r * v[:, 2 * size:])
        if keep:
            kept.append((h, z, r, n, v[:, 2 * size:]))
        h = n + z * (h - n)
        states[t] = h
    return (states, kept) if keep else states


def gru_backward(d_states: np.ndarray, u: np.ndarray, kept: list, fresh: np.ndarray | None = None):
    """Gradients of the projected inputs (T, B, 3H) and of ``u``; truncated at the first step."""
    d_inputs = np.empty((*d_states.shape[:2], u.shape[1]), np.float32)
    d_u = np.zeros_like(u)
    carry = np.zeros_like(d_states[0])
    for t in range(len(d_states) - 1, -1, -1):
        h, z, r, n, v = kept[t]
        d = d_states[t] + carry
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (h - n) * z * (1 - z)
        dr = dn * v * r * (1 - r)
        d_inputs[t] = np.concatenate([dz, dr, dn], axis=1)
        dv = np.concatenate([dz, dr, dn * r], axis=1)
        d_u += h.T @ dv
        carry = d * z + dv @ u.T
        if fresh is not None:
            carry = np.where(fresh[t][:, None], np.float32(0), carry)
    return d_inputs, d_u


def sum_rows(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum ``values`` by row number into an array of ``n`` rows."""
    out = np.zeros((n, values.shape[1]), np.float32)
    if len(rows):
        order = np.argsort(rows, kind="stable")
        sorted_rows = rows[order]
        at = np.flatnonzero(np.diff(sorted_rows, prepend=-1))
        out[sorted_rows[at]] = np.add.reduceat(values[order], at, axis=0)
    return out


class Adam:
    """Adam over a dict of arrays, with the gradient's norm clipped."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float, clip: float = 1.0):
        self.weights, self.rate, self.clip, self.t = weights, rate, clip, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.t += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in gradients.values())))
        scale = np.float32(min(1.0, self.clip / (norm + 1e-12)))
        rate = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in gradients.items():
            g = g * scale
            self.m[k] += np.float32(0.1) * (g - self.m[k])
            self.v[k] += np.float32(0.001) * (g * g - self.v[k])
            self.weights[k] -= np.float32(rate) * self.m[k] / (np.sqrt(self.v[k]) + np.float32(1e-8))
