"""A log-bilinear language model in numpy, trained by noise-contrastive estimation.

The model predicts a token's class from the two before it: a predicted vector is
the sum of the context's vectors, each scaled per dimension by its position, and
a class scores its own vector times that plus a bias.  Training never sums over
classes: a batch's tokens are told from ``NOISE`` draws of the unigram law.
Scoring does: scores of all classes for a batch of contexts are one matrix
product, normalised exactly, each different context of a batch once.

``WithinClasses`` goes on inside a class that holds many words: its own words and
one rest are told apart by the same predicted vector, with a vector and a bias each.
Noise and normaliser are the class's, so a word costs its class's size, not the
vocabulary's.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DIM, CONTEXT, NOISE, BATCH = 16, 2, 32, 4096
OWN_NOISE, OWN_BATCH, OWN_RATE, OWN_BIAS_RATE = 64, 512, 0.3, 0.03
SIZE = np.float32(1 / 64)  # gradients per 64 tokens


@dataclass
class LogBilinear:
    context: np.ndarray  # (classes + 1, DIM); the last row stands before a text
    position: np.ndarray  # (CONTEXT, DIM)
    target: np.ndarray  # (classes, DIM)
    bias: np.ndarray  # (classes,)

    @classmethod
    def start(cls, unigram: np.ndarray, seed: int = 42) -> LogBilinear:
        """Small random vectors, and the unigram law as bias: at first every context predicts that."""
        rng, n = np.random.default_rng(seed), len(unigram)
        return cls(rng.normal(0, 0.3, (n + 1, DIM)).astype(np.float32), np.ones((CONTEXT, DIM), np.float32),
                   rng.normal(0, 0.3, (n, DIM)).astype(np.float32), np.log(unigram).astype(np.float32))

    seen: list[np.ndarray] | None = None  # Adagrad's sums, with which training goes on
    within: WithinClasses | None = None

    def hidden(self, before: np.ndarray) -> np.ndarray:
        """Predicted vectors after the contexts ``before`` (n, CONTEXT)."""
        return self.context[before[:, 0]] * self.position[0] + self.context[before[:, 1]] * self.position[1]

    def distinct(self, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(predicted vectors of the different contexts, which of them is each row's)."""
        code, which = np.unique(before[:, 0].astype(np.int64) * len(self.context) + before[:, 1], return_inverse=True)
        return self.hidden(np.stack(np.divmod(code, len(self.context)), 1)), which

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.context, self.position, self.target, self.bias)])

    @classmethod
    def from_flat(cls, flat: np.ndarray, classes: int) -> LogBilinear:
        sizes = [(classes + 1, DIM), (CONTEXT, DIM), (classes, DIM), (classes,)]
        out, at = [], 0
        for shape in sizes:
            n = int(np.prod(shape))
            out.append(flat[at:at + n].reshape(shape).astype(np.float32))
            at += n
        return cls(*out)

    def log_probabilities(self, before: np.ndarray, token: np.ndarray, chunk: int = 4096) -> np.ndarray:
        """Natural log of P(token | before), normalised; ``before`` is (n, CONTEXT), nearest first."""
        hidden, which = self.distinct(before)
        total = np.empty(len(hidden), np.float32)
        for at in range(0, len(hidden), chunk):
            scores = hidden[at:at + chunk] @ self.target.T
            scores += self.bias
            top = scores.max(1, keepdims=True)
            scores -= top
            np.exp(scores, out=scores)
            total[at:at + chunk] = np.log(scores.sum(1)) + top[:, 0]
        out = np.empty(len(token))
        for at in range(0, len(token), 1 << 18):
            part, w = token[at:at + (1 << 18)], which[at:at + (1 << 18)]
            out[at:at + (1 << 18)] = (np.einsum("nd,nd->n", hidden[w], self.target[part]) + self.bias[part] - total[w])
        return out


def _add_rows(gradient: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, their summed gradients)."""
    order = np.argsort(rows, kind="stable")
    sorted_rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
    return sorted_rows[first], np.add.reduceat(gradient[order], first, axis=0)


def train(model: LogBilinear, before: np.ndarray, token: np.ndarray, unigram: np.ndarray, rate: float = 0.1,
          epochs: int = 1, seed: int = 42) -> LogBilinear:
    """Noise-contrastive estimation by Adagrad over the tokens in order; a pure function of its arguments."""
    rng = np.random.default_rng(seed)
    m = LogBilinear(model.context.copy(), model.position.copy(), model.target.copy(), model.bias.copy())
    state = m.seen = ([x.copy() for x in model.seen] if model.seen else
                      [np.full_like(x, 0.1) for x in (m.context, m.position, m.target, m.bias)])
    share = np.cumsum(unigram)
    share /= share[-1]
    log_noise = np.log(unigram * NOISE).astype(np.float32)

    def step(param: np.ndarray, seen: np.ndarray, rows: np.ndarray, g: np.ndarray) -> None:
        seen[rows] += g * g
        param[rows] -= rate * g / np.sqrt(seen[rows])

    for _ in range(epochs):
        for at in range(0, len(token), BATCH):
            t, (one, two) = token[at:at + BATCH], before[at:at + BATCH].T
            noise = np.searchsorted(share, rng.random(NOISE)).astype(np.int64)
            a, b = m.context[one], m.context[two]
            hidden = a * m.position[0] + b * m.position[1]
            own, other = m.target[t], m.target[noise]
            g_own = -1 / (1 + np.exp(np.einsum("nd,nd->n", hidden, own) + m.bias[t] - log_noise[t]))
            g_other = 1 / (1 + np.exp(-(hidden @ other.T + m.bias[noise] - log_noise[noise])))
            g_hidden = g_own[:, None] * own + g_other @ other
            rows = np.concatenate([t, noise])
            g_target = np.concatenate([g_own[:, None] * hidden, g_other.T @ hidden])
            g_bias = np.concatenate([g_own, g_other.sum(0)])
            rows, g = _add_rows(np.concatenate([g_target, g_bias[:, None]], 1) * SIZE, rows)
            step(m.target, state[2], rows, g[:, :-1])
            step(m.bias, state[3], rows, g[:, -1])
            rows, g = _add_rows(np.concatenate([g_hidden * m.position[0], g_hidden * m.position[1]]) * SIZE,
                                np.concatenate([one, two]))
            step(m.context, state[0], rows, g)
            g = np.stack([(g_hidden * a).sum(0), (g_hidden * b).sum(0)]) * SIZE
            step(m.position, state[1], np.arange(CONTEXT), g)
    return m


@dataclass
class WithinClasses:
    """Outcomes of the classes, class by class: vectors and biases."""

    first: np.ndarray  # (classes + 1,): where each class's outcomes begin
    target: np.ndarray  # (outcomes, DIM)
    bias: np.ndarray  # (outcomes,)

    @classmethod
    def start(cls, first: np.ndarray, law: np.ndarray) -> WithinClasses:
        """Before training every context predicts ``law``, the outcomes' shares of their class."""
        return cls(first, np.zeros((len(law), DIM), np.float32), np.log(law).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.target.ravel(), self.bias])

    @classmethod
    def from_flat(cls, flat: np.ndarray, first: np.ndarray) -> WithinClasses:
        n = int(first[-1])
        return cls(first, flat[:n * DIM].reshape(n, DIM).astype(np.float32), flat[n * DIM:].astype(np.float32))

    def log_shares(self, hidden: np.ndarray, klass: np.ndarray, outcome: np.ndarray, which: np.ndarray | None = None,
                   chunk: int = 512) -> np.ndarray:
        """Natural log of P(outcome | class, context), normalised over the class's outcomes.

        ``which`` says whose vector of ``hidden`` is each row's (else they stand row by
        row); a vector's normaliser of a class is computed once.
        """
        which = np.arange(len(klass)) if which is None else which
        pairs, place = np.unique(klass.astype(np.int64) * len(hidden) + which, return_inverse=True)
        of, at = np.divmod(pairs, len(hidden)) if len(hidden) else (pairs, pairs)
        total = np.empty(len(pairs), np.float32)
        for k, rows in _by_class(of, len(self.first) - 1, chunk):
            a, b = self.first[k], self.first[k + 1]
            scores = hidden[at[rows]] @ self.target[a:b].T
            scores += self.bias[a:b]
            top = scores.max(1, keepdims=True)
            scores -= top
            np.exp(scores, out=scores)
            total[rows] = np.log(scores.sum(1)) + top[:, 0]
        out = np.empty(len(klass), np.float32)
        for a in range(0, len(klass), 1 << 18):
            part = slice(a, a + (1 << 18))
            out[part] = (np.einsum("nd,nd->n", hidden[which[part]], self.target[outcome[part]]) + self.bias[outcome[part]]
                         - total[place[part]])
        return out


def _by_class(klass: np.ndarray, classes: int, most: int):
    """(class, rows of it), at most ``most`` at a time."""
    order = np.argsort(klass, kind="stable")
    cuts = np.searchsorted(klass[order], np.arange(classes + 1))
    for k in np.flatnonzero(np.diff(cuts)):
        for at in range(cuts[k], cuts[k + 1], most):
            yield k, order[at:min(at + most, cuts[k + 1])]


def train_within(model: WithinClasses, hidden: np.ndarray, klass: np.ndarray, outcome: np.ndarray, law: np.ndarray,
                 seen: np.ndarray | None = None, seed: int = 42) -> tuple[WithinClasses, np.ndarray]:
    """Noise-contrastive estimation inside each class by Adagrad, whose sums ``seen`` are handed on.

    A batch's outcomes are told from ``OWN_NOISE`` draws of their class's law; ``hidden`` stays as it is.
    """
    rng = np.random.default_rng(seed)
    m = WithinClasses(model.first, model.target.copy(), model.bias.copy())
    seen = np.full((len(law), DIM + 1), 0.1, np.float32) if seen is None else seen.copy()
    total = np.concatenate([[0.0], np.cumsum(law)])
    log_noise = np.log(law * OWN_NOISE).astype(np.float32)
    for k, rows in _by_class(klass, len(m.first) - 1, OWN_BATCH):
        a, b = m.first[k], m.first[k + 1]
        h, own = hidden[rows], outcome[rows]
        drawn = np.searchsorted(total[a + 1:b + 1], total[a] + rng.random(OWN_NOISE) * (total[b] - total[a]))
        noise = a + np.minimum(drawn, b - a - 1)
        g_own = -1 / (1 + np.exp(np.einsum("nd,nd->n", h, m.target[own]) + m.bias[own] - log_noise[own]))
        g_other = 1 / (1 + np.exp(-(h @ m.target[noise].T + m.bias[noise] - log_noise[noise])))
        g = np.concatenate([np.concatenate([g_own[:, None] * h, g_other.T @ h]),
                            np.concatenate([g_own, g_other.sum(0)])[:, None]], 1)
        at, g = _add_rows(g.astype(np.float32) * SIZE, np.concatenate([own, noise]))
        seen[at] += g * g
        g /= np.sqrt(seen[at])
        m.target[at] -= OWN_RATE * g[:, :-1]
        m.bias[at] -= OWN_BIAS_RATE * g[:, -1]
    return m, seen
