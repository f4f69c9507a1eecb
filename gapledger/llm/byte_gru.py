"""A bidirectional gated recurrent network over bytes, trained by backpropagation through time.

Segments (byte strings) go in; every byte position gets a probability per label.
Forward and backward directions are two networks of the same form; the second reads
each segment from its end. A position's logits are a linear map of both states.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN = 8
#: Segments are cut into pieces of at most so many bytes; each piece is read in full.
PIECE = 48


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def padded(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (row per segment, zero-filled) and lengths."""
    lengths = np.fromiter(map(len, segments), np.int64, len(segments))
    width = int(lengths.max(initial=1))
    data = np.zeros((len(segments), width), np.uint8)
    data[np.arange(width) < lengths[:, None]] = np.frombuffer(b"".join(segments), np.uint8)
    return data, lengths


def reversed_rows(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each row's first ``length`` entries from last to first, along axis 1."""
    at = lengths[:, None] - 1 - np.arange(data.shape[1])
    shape = at.shape + (1,) * (data.ndim - 2)
    rows = np.take_along_axis(data, np.maximum(at, 0).reshape(shape), axis=1)
    return np.where((at >= 0).reshape(shape), rows, 0)


@dataclass
class Direction:
    """One direction. Columns of ``x``, ``u`` and the biases: update, reset, candidate."""

    x: np.ndarray  # 256 x 3H: input of each byte value, bias included
    u: np.ndarray  # H x 3H
    b: np.ndarray  # H: bias of the candidate's recurrent part
    out: np.ndarray  # H x labels

    @classmethod
    def start(cls, rng: np.random.Generator, hidden: int, labels: int) -> Direction:
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return cls(
            draw(256, 3 * hidden, scale=0.3), draw(hidden, 3 * hidden, scale=hidden**-0.5),
            np.zeros(hidden, np.float32), draw(hidden, labels, scale=hidden**-0.5),
        )

    def arrays(self) -> list[np.ndarray]:
        return [self.x, self.u, self.b, self.out]

    def step(self, codes: np.ndarray, h: np.ndarray):
        size = h.shape[1]
        given, carried = self.x[codes], h @ self.u
        gates = _sigmoid(given[:, : 2 * size] + carried[:, : 2 * size])
        z, r = gates[:, :size], gates[:, size:]
        inner = carried[:, 2 * size :] + self.b
        n = np.tanh(given[:, 2 * size :] + r * inner)
        return n + z * (h - n), (z, r, inner, n)

    def logits(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Rows must come longest first, so that the active ones are always the first."""
        found = np.zeros((*data.shape, self.out.shape[1]), np.float32)
        h = np.zeros((len(data), self.u.shape[0]), np.float32)
        for t in range(data.shape[1]):
            active = int(np.searchsorted(-lengths, -t, side="left"))
            h = self.step(data[:active, t], h[:active])[0]
            found[:active, t] = h @ self.out
        return found

    def forward(self, data: np.ndarray, mask: np.ndarray):
        """States after each position, and what ``backward`` needs."""
        h, states, kept = np.zeros((len(data), self.u.shape[0]), self.u.dtype), [], []
        for t in range(data.shape[1]):
            new, parts = self.step(data[:, t], h)
            kept.append((h, parts))
            h = np.where(mask[:, t, None], new, h)
            states.append(h)
        return np.stack(states, 1), kept

    def backward(self, data, mask, states, kept, d_logits) -> list[np.ndarray]:
        """Gradients of ``arrays()``, back through time from the last position."""
        size = self.u.shape[0]
        g_x, g_u, g_b = np.zeros_like(self.x), np.zeros_like(self.u), np.zeros_like(self.b)
        g_out = np.einsum("bth,btl->hl", states, d_logits)
        d_states = d_logits @ self.out.T
        d_h = np.zeros((len(data), size), self.u.dtype)
        for t in reversed(range(data.shape[1])):
            before, (z, r, inner, n) = kept[t]
            d_h = d_h + d_states[:, t]
            live = mask[:, t, None]
            d_new = np.where(live, d_h, 0)
            d_n = d_new * (1 - z) * (1 - n * n)
            d_z = d_new * (before - n) * z * (1 - z)
            d_r = d_n * inner * r * (1 - r)
            d_inner = d_n * r
            d_carried = np.concatenate([d_z, d_r, d_inner], 1)
            np.add.at(g_x, data[:, t], np.concatenate([d_z, d_r, d_n], 1))
            g_u += before.T @ d_carried
            g_b += d_inner.sum(0)
            d_h = np.where(live, d_new * z + d_carried @ self.u.T, d_h)
        return [g_x, g_u, g_b, g_out]


@dataclass
class ByteGRU:
    labels: list[str]
    ahead: Direction
    back: Direction
    bias: np.ndarray

    @classmethod
    def start(cls, labels: list[str], hidden: int = HIDDEN, seed: int = 0) -> ByteGRU:
        rng = np.random.default_rng(seed)
        ahead, back = (Direction.start(rng, hidden, len(labels)) for _ in range(2))
        return cls(labels, ahead, back, np.zeros(len(labels), np.float32))

    def arrays(self) -> list[np.ndarray]:
        return [*self.ahead.arrays(), *self.back.arrays(), self.bias]

    def loss_and_gradients(self, segments: list[bytes], truth: np.ndarray, weight: np.ndarray):
        """Weighted mean over positions of the cross-entropy, and its gradients."""
        data, lengths = padded(segments)
        mask = np.arange(data.shape[1]) < lengths[:, None]
        turned = reversed_rows(data, lengths)
        states, kept = self.ahead.forward(data, mask)
        back_states, back_kept = self.back.forward(turned, mask)
        logits = states @ self.ahead.out + reversed_rows(back_states @ self.back.out, lengths) + self.bias
        p = np.exp(logits - logits.max(-1, keepdims=True))
        p /= p.sum(-1, keepdims=True)
        share = mask * weight[:, None]
        share = (share / share.sum())[..., None].astype(self.bias.dtype)
        hit = np.arange(len(self.labels)) == truth[:, None, None]
        loss = -(share * hit * np.log(np.maximum(p, 1e-12))).sum()
        d = (p - hit) * share
        gradients = self.ahead.backward(data, mask, states, kept, d)
        gradients += self.back.backward(turned, mask, back_states, back_kept, reversed_rows(d, lengths))
        return float(loss), [*gradients, d.sum((0, 1))]

    def train(
        self, segments: list[bytes], truth: np.ndarray, weight: np.ndarray, steps: int = 300, batch: int = 256,
        rate: float = 0.01, seed: int = 0,
    ) -> ByteGRU:
        """Adam over batches drawn with probability in proportion to ``weight``."""
        rng = np.random.default_rng(seed)
        share = weight / weight.sum()
        mean = [np.zeros_like(a) for a in self.arrays()]
        square = [np.zeros_like(a) for a in self.arrays()]
        for i in range(1, steps + 1):
            pick = rng.choice(len(segments), batch, p=share)
            _, gradients = self.loss_and_gradients([segments[j] for j in pick], truth[pick], np.ones(batch))
            now = rate * min(1.0, 2 * (1 - i / (steps + 1)))
            for a, g, m, s in zip(self.arrays(), gradients, mean, square, strict=True):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                a -= (now * (m / (1 - 0.9**i)) / (np.sqrt(s / (1 - 0.99**i)) + 1e-7)).astype(a.dtype)
        return self

    def position_probabilities(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities (segment, position, label), zero beyond a segment's end, and lengths.

        ``segments`` must come longest first.
        """
        data, lengths = padded(segments)
        logits = self.ahead.logits(data, lengths)
        logits += reversed_rows(self.back.logits(reversed_rows(data, lengths), lengths), lengths)
        logits += self.bias
        p = np.exp(logits - logits.max(-1, keepdims=True))
        p /= p.sum(-1, keepdims=True)
        return p * (np.arange(data.shape[1]) < lengths[:, None])[..., None], lengths

    def segment_sums(self, segments: list[bytes], batch: int = 4096) -> np.ndarray:
        """Per segment: the sum over its positions of their probabilities, in the given order."""
        sums = np.zeros((len(segments), len(self.labels)), np.float32)
        order = sorted(range(len(segments)), key=lambda i: -len(segments[i]))
        # Memory goes with positions times labels.
        batch = max(1, batch * 200 // max(200, len(self.labels)))
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            sums[part] = self.position_probabilities([segments[i] for i in part])[0].sum(1)
        return sums
