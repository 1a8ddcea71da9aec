"""A long short-term memory layer in numpy over padded sequences."""

from __future__ import annotations

import numpy as np

from fleetspark.llm.gru import sigmoid


def lstm_forward(inputs: np.ndarray, u: np.ndarray, real: np.ndarray, keep: bool = False):
    """States (T, B, H) for projected inputs (T, B, 4H: input, forget, output gate, cell); steps that are not
    ``real`` (T, B) leave the zero state."""
    size = u.shape[0]
    h = c = np.zeros((inputs.shape[1], size), np.float32)
    states, kept = np.empty((*inputs.shape[:2], size), np.float32), []
    for t in range(len(inputs)):
        v = inputs[t] + h @ u
        s = sigmoid(v[:, :3 * size])
        i, f, o, g = s[:, :size], s[:, size:2 * size], s[:, 2 * size:], np.tanh(v[:, 3 * size:])
        before, c = (h, c), (f * c + i * g) * real[t][:, None]
        tc = np.tanh(c)
        if keep:
            kept.append((*before, i, f, o, g, tc))
        h = o * tc
        states[t] = h
    return (states, kept) if keep else states


def lstm_backward(d_states: np.ndarray, u: np.ndarray, kept: list, real: np.ndarray):
    """Gradients of the projected inputs and of ``u``."""
    d_inputs, d_u = np.empty((*d_states.shape[:2], u.shape[1]), np.float32), np.zeros_like(u)
    carry_h = carry_c = np.zeros_like(d_states[0])
    for t in range(len(d_states) - 1, -1, -1):
        h, c, i, f, o, g, tc = kept[t]
        dh = d_states[t] + carry_h
        dc = (carry_c + dh * o * (1 - tc * tc)) * real[t][:, None]
        d = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        d_inputs[t] = d
        d_u += h.T @ d
        carry_h, carry_c = d @ u.T, dc * f
    return d_inputs, d_u
