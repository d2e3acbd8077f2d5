"""A linear-chain conditional random field over numbered features; sequences are worked on side by side.

Tokens of all sequences stand one behind the other, with one row of feature
numbers each. Sequences are taken in descending order of length, so that those
that reach step t are always the first ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Steps of the fit, their first size and the penalty on weights.
STEPS, RATE, PENALTY = 160, 0.25, 0.02


@dataclass
class Sequences:
    """Where sequences begin, longest first, and how many of them reach each step."""

    begins: np.ndarray
    reach: np.ndarray

    @classmethod
    def of(cls, begins: np.ndarray, sizes: np.ndarray) -> Sequences:
        begins, sizes = begins[sizes > 0], sizes[sizes > 0]
        by = np.argsort(-sizes, kind="stable")
        steps = np.arange(int(sizes.max(initial=0)))
        return cls(begins[by], np.searchsorted(-sizes[by], -steps, "left"))


@dataclass
class Chain:
    """Weights of features (row 0: unknown ones, all zero) and of pairs of neighbouring tags. `allowed` and `first` tell
    which tags may follow each other, and which may begin."""

    weights: np.ndarray
    pairs: np.ndarray
    allowed: np.ndarray
    first: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        """What each token's features say for each tag."""
        total = self.weights[features[:, 0]]
        for k in range(1, features.shape[1]):
            total = total + self.weights[features[:, k]]
        return total

    def decode(self, features: np.ndarray, sequences: Sequences) -> np.ndarray:
        """The tags of the best path of each sequence (Viterbi); of equal ones that of lesser tags."""
        said = self.scores(features).astype(np.float32)
        pairs = np.where(self.allowed, self.pairs, -np.inf).astype(np.float32)
        n_tags, reach = len(pairs), sequences.reach
        back = np.zeros((len(said), n_tags), np.uint8)
        tags = np.zeros(len(said), np.uint8)
        last = np.zeros(len(sequences.begins), np.uint8)
        best = np.where(self.first, said[sequences.begins], -np.inf).astype(np.float32) if len(reach) else said[:0]
        for t in range(1, len(reach) + 1):
            n = reach[t] if t < len(reach) else 0
            last[n : len(best)] = best[n:].argmax(axis=1)
            if not n:
                break
            at, before = sequences.begins[:n] + t, best[:n]
            top, which = before[:, :1] + pairs[0], np.zeros((n, n_tags), np.uint8)
            for j in range(1, n_tags):
                other = before[:, j : j + 1] + pairs[j]
                more = other > top
                top[more], which[more] = other[more], j
            best, back[at] = top + said[at], which
        for t in reversed(range(len(reach))):
            at = sequences.begins[: reach[t]] + t
            tags[at] = last[: reach[t]]
            last[: reach[t]] = back[at, last[: reach[t]]]
        return tags


def _expected(chain: Chain, features: np.ndarray, sequences: Sequences) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of tags at each token, and expected numbers of pairs of tags."""
    said = chain.scores(features)
    said = np.exp(said - said.max(axis=1, keepdims=True))
    step = np.where(chain.allowed, np.exp(chain.pairs), 0)
    ahead, behind, pairs = np.zeros_like(said), np.ones_like(said), np.zeros_like(step)
    scale = np.ones(len(said))
    for t, n in enumerate(sequences.reach):
        at = sequences.begins[:n] + t
        now = said[at] * (chain.first if t == 0 else ahead[at - 1] @ step)
        scale[at] = now.sum(axis=1)
        ahead[at] = now / scale[at][:, None]
    for t in reversed(range(1, len(sequences.reach))):
        at = sequences.begins[: sequences.reach[t]] + t
        now = said[at] * behind[at] / scale[at][:, None]
        pairs += ahead[at - 1].T @ now
        behind[at - 1] = now @ step.T
    return ahead * behind, pairs * step


def fit(features: np.ndarray, tags: np.ndarray, sequences: Sequences, n_features: int, allowed: np.ndarray, first: np.ndarray) -> Chain:
    """The chain that makes the labelled `tags` likeliest, less a penalty on squared weights: full gradients with Adam's steps, the size of which falls to 0."""
    n_tags = len(allowed)
    chain = Chain(np.zeros((n_features, n_tags)), np.zeros((n_tags, n_tags)), allowed, first)
    if not len(tags):
        return chain
    is_tag = np.eye(n_tags)[tags]
    later = np.ones(len(tags), bool)
    later[sequences.begins] = False
    after = np.flatnonzero(later)
    seen_pairs = is_tag[after - 1].T @ is_tag[after]
    # Tokens by feature, once for all steps.
    orders = [np.argsort(f, kind="stable") for f in features.T]
    groups = [np.flatnonzero(np.append(True, np.diff(f[by]) != 0)) for f, by in zip(features.T, orders)]
    means = [np.zeros_like(chain.weights), np.zeros_like(chain.pairs)]
    squares = [np.zeros_like(chain.weights), np.zeros_like(chain.pairs)]
    for k in range(1, STEPS + 1):
        likely, pairs = _expected(chain, features, sequences)
        wrong = likely - is_tag
        gradient = PENALTY * chain.weights
        for f, by, group in zip(features.T, orders, groups):
            gradient[f[by[group]]] += np.add.reduceat(wrong[by], group)
        for x, g, mean, square in zip((chain.weights, chain.pairs), (gradient, pairs - seen_pairs + PENALTY * chain.pairs), means, squares):
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            x -= RATE * (1 - (k - 1) / STEPS) * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    chain.weights[0] = 0
    return chain
