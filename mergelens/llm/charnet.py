"""A small character convolutional network in numpy, for strings of a fixed width."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Codes: 0 padding, 1 any sign beyond printable ASCII, 2.. printable ASCII from the space on.
CODES = 97


@dataclass(frozen=True)
class NetSettings:
    width: int = 96
    embedding: int = 8
    taps: int = 5
    filters: int = 24
    rounds: int = 6
    batch: int = 64
    rate: float = 0.005
    decay: float = 1e-4
    seed: int = 7


def codes(texts: list[str], width: int) -> np.ndarray:
    """Rows of character codes, padded at the right; longer texts are not accepted."""
    out = np.zeros((len(texts), width), np.int64)
    for row, text in enumerate(texts):
        raw = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        out[row, : len(raw)] = np.where((raw >= 32) & (raw < 127), raw - 30, 1)
    return out


class CharNet:
    """Embedding, one convolution, ReLU, the maximum over candidate and over context, one layer.

    ``inside`` marks the places of the candidate; its maximum and that of the places around it
    are separate inputs of the last layer, so that a keyword and a value are told apart.
    """

    def __init__(self, settings: NetSettings = NetSettings()):
        self.settings = settings
        random = np.random.default_rng(settings.seed)
        s = settings
        self.parts = {
            "embedding": random.normal(0, 0.3, (CODES, s.embedding)),
            "filters": random.normal(0, (s.taps * s.embedding) ** -0.5, (s.taps * s.embedding, s.filters)),
            "shift": np.zeros(s.filters),
            "last": random.normal(0, (2 * s.filters) ** -0.5, 2 * s.filters),
            "bias": np.zeros(1),
        }

    def _forward(self, rows: np.ndarray, inside: np.ndarray):
        s, p = self.settings, self.parts
        padded = np.pad(rows, ((0, 0), (s.taps // 2, s.taps // 2)))
        taps = np.stack([padded[:, t : t + s.width] for t in range(s.taps)], 2)
        seen = p["embedding"][taps].reshape(len(rows), s.width, -1)
        signal = np.maximum(seen @ p["filters"] + p["shift"], 0)
        both = [np.where(m[:, :, None], signal, -1.0) for m in (inside, ~inside)]
        places = [x.argmax(1) for x in both]
        pooled = np.concatenate([np.maximum(x.max(1), 0) for x in both], 1)
        logits = np.clip(pooled @ p["last"] + p["bias"][0], -30, 30)
        return taps, seen, places, pooled, 1 / (1 + np.exp(-logits))

    def score(self, rows: np.ndarray, inside: np.ndarray) -> np.ndarray:
        found = [
            self._forward(rows[i : i + 512], inside[i : i + 512])[-1] for i in range(0, len(rows), 512)
        ]
        return np.concatenate(found) if found else np.zeros(0)

    def train(self, rows: np.ndarray, inside: np.ndarray, labels: np.ndarray) -> None:
        """Adam on the logistic loss, in an order drawn from the seed."""
        s, p = self.settings, self.parts
        random = np.random.default_rng(s.seed + 1)
        first = {k: np.zeros_like(v) for k, v in p.items()}
        second = {k: np.zeros_like(v) for k, v in p.items()}
        step = 0
        for _ in range(s.rounds):
            order = random.permutation(len(rows))
            for start in range(0, len(rows), s.batch):
                pick = order[start : start + s.batch]
                slopes = self._slopes(rows[pick], inside[pick], labels[pick])
                step += 1
                for k, slope in slopes.items():
                    slope = slope + s.decay * p[k]
                    first[k] = 0.9 * first[k] + 0.1 * slope
                    second[k] = 0.999 * second[k] + 0.001 * slope**2
                    size = first[k] / (1 - 0.9**step)
                    p[k] -= s.rate * size / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)

    def _slopes(self, rows, inside, labels):
        s, p = self.settings, self.parts
        taps, seen, places, pooled, guess = self._forward(rows, inside)
        error = (guess - labels) / len(rows)
        to_pooled = (error[:, None] * p["last"]) * (pooled > 0)
        here = np.arange(len(rows))[:, None]
        to_filters = np.zeros_like(p["filters"])
        to_embedding = np.zeros_like(p["embedding"])
        for half, place in enumerate(places):
            flow = to_pooled[:, half * s.filters : (half + 1) * s.filters]
            window = seen[here, place]
            to_filters += np.einsum("nfe,nf->ef", window, flow)
            back = (flow[:, :, None] * p["filters"].T[None]).reshape(-1, s.embedding)
            np.add.at(to_embedding, taps[here, place].reshape(-1), back)
        to_shift = to_pooled[:, : s.filters].sum(0) + to_pooled[:, s.filters :].sum(0)
        return {
            "embedding": to_embedding,
            "filters": to_filters,
            "shift": to_shift,
            "last": error @ pooled,
            "bias": np.array([error.sum()]),
        }
