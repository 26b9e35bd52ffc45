"""A linear-chain conditional random field on sequences of any length.

A sequence's positions carry lists of feature numbers; a label's score at a position is the
sum of its weights for them, and neighbouring labels add a transition score. Training
maximises the conditional likelihood by mini-batches (Adam), with expectations from
forward-backward; prediction returns the marginals of forward-backward. All sequences of a
batch advance together, one position at a time, so the work per position is a few array
operations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 256  # positions of a block; the result does not depend on it
MOST_LABELS = 32  # with more labels a block's matrix costs more than single steps


@dataclass
class Chain:
    weights: np.ndarray  # features x labels
    moves: np.ndarray  # label x label
    starts: np.ndarray  # label


def scores(chain: Chain, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The label scores of each position, whose features are the next ``counts[i]`` numbers."""
    out = np.zeros((len(counts), chain.weights.shape[1]), np.float32)
    some = np.flatnonzero(counts)
    if len(some):
        at = (np.cumsum(counts) - counts)[some]
        out[some] = np.add.reduceat(chain.weights[features], at, axis=0)
    return out


def marginals(chain: Chain, emission: np.ndarray, lengths: np.ndarray, expect: bool = False):
    """The probability of each label at each position.

    ``lengths`` are those of the sequences, in order, all above 0. With ``expect`` also the
    expected number of moves between labels and of starts.

    A long sequence is worked on in blocks that advance together. What a block does to the
    message that enters it is a matrix, so the messages at the borders of the blocks are known
    before the blocks are run, and the result is that of one chain.
    """
    n, labels = emission.shape
    local = np.exp(emission - emission.max(axis=1, keepdims=True)).astype(np.float64)
    move = np.exp(chain.moves.astype(np.float64))
    start = np.exp(chain.starts.astype(np.float64))
    begin = np.cumsum(lengths) - lengths
    if expect or labels > MOST_LABELS or not len(lengths) or lengths.max() <= BLOCK:
        first, last = np.tile(start, (len(lengths), 1)), np.ones((len(lengths), labels))
        both, moved = _run(local, move, begin, lengths, first, last, expect)
        return (both, moved, both[begin].sum(axis=0)) if expect else both

    parts = -(-lengths // BLOCK)
    size = np.full(int(parts.sum()), BLOCK, np.int64)
    final = np.cumsum(parts) - 1
    size[final] = lengths - BLOCK * (parts - 1)
    head = np.cumsum(size) - size
    first, last = np.tile(start, (len(size), 1)), np.ones((len(size), labels))
    several = np.flatnonzero(np.repeat(parts > 1, parts))
    through = np.zeros((len(size), labels, labels))
    through[several] = _through(local, move, head[several], size[several])
    order = np.argsort(-parts, kind="stable")
    block, count = (final - parts + 1)[order], parts[order]
    longest = int(count[0])
    active = np.searchsorted(-count, -np.arange(longest), "left")  # sequences of more than i blocks
    for i in range(1, longest):
        at = block[: active[i]] + i
        first[at] = _unit(np.einsum("ij,ijk->ik", first[at - 1], through[at - 1]) @ move)
    for i in range(longest - 1, 0, -1):
        at = block[: active[i]] + i
        last[at - 1] = _unit(np.einsum("ijk,ik->ij", through[at], last[at]) @ move.T)
    return _run(local, move, head, size, first, last, False)[0]


def _unit(a: np.ndarray) -> np.ndarray:
    return a / a.sum(axis=-1, keepdims=True)


def _through(local: np.ndarray, move: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each block the weights of all paths from its first to its last label, up to a factor."""
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    out = local[begin][:, None, :] * np.eye(local.shape[1])
    active = np.searchsorted(-size, -np.arange(int(size[0])), "left")
    for t in range(1, int(size[0])):
        k = active[t]
        now = (out[:k] @ move) * local[begin[:k] + t][:, None, :]
        out[:k] = now / now.sum(axis=(1, 2), keepdims=True)
    back = np.empty_like(out)
    back[order] = out
    return back


def _run(local, move, begin, size, first, last, expect):
    """Marginals of sequences that ``first`` enters and ``last`` follows, and with ``expect`` moves."""
    n, labels = local.shape
    order = np.argsort(-size, kind="stable")
    begin, size, first, last = begin[order], size[order], first[order], last[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")  # sequences longer than t
    ahead = np.empty((n, labels))
    scale = np.empty(n)
    for t in range(longest):
        if t == 0:
            at = begin
            a = local[at] * first
        else:
            at = begin[: active[t]] + t
            a = (ahead[at - 1] @ move) * local[at]
        s = a.sum(axis=1)
        scale[at] = s
        ahead[at] = a / s[:, None]
    back = np.ones((n, labels))
    back[begin + size - 1] = last
    moved = np.zeros((labels, labels))
    for t in range(longest - 1, 0, -1):
        at = begin[: active[t]] + t
        late = local[at] * back[at] / scale[at][:, None]
        back[at - 1] = late @ move.T
        if expect:
            moved += (ahead[at - 1].T @ late) * move
    both = ahead * back
    both /= both.sum(axis=1, keepdims=True)
    return both, moved


def train(
    features: np.ndarray,
    counts: np.ndarray,
    labels: np.ndarray,
    lengths: np.ndarray,
    n_features: int,
    n_labels: int,
    epochs: int = 4,
    batch: int = 8_000,
    rate: float = 0.1,
    decay: float = 1e-5,
    seed: int = 7,
) -> Chain:
    """Weights for labelled sequences; ``batch`` is in positions."""
    chain = Chain(
        np.zeros((n_features, n_labels), np.float32),
        np.zeros((n_labels, n_labels), np.float32),
        np.zeros(n_labels, np.float32),
    )
    if not len(lengths):
        return chain
    random = np.random.default_rng(seed)
    feature_at = np.concatenate([[0], np.cumsum(counts)])
    begin = np.concatenate([[0], np.cumsum(lengths)])
    per_batch = max(1, int(batch * len(lengths) / max(1, lengths.sum())))
    parts = ("weights", "moves", "starts")
    first = {p: np.zeros_like(getattr(chain, p)) for p in parts}
    second = {p: np.zeros_like(getattr(chain, p)) for p in parts}
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(lengths))
        for low in range(0, len(order), per_batch):
            chosen = order[low : low + per_batch]
            rows = _ranges(begin[chosen], lengths[chosen])
            own = features[_ranges(feature_at[rows], counts[rows])]
            gold = labels[rows]
            emission = scores(chain, own, counts[rows])
            both, moved, started = marginals(chain, emission, lengths[chosen], expect=True)
            gap = both
            gap[np.arange(len(gold)), gold] -= 1
            heads = np.zeros(len(gold), bool)
            heads[np.cumsum(lengths[chosen]) - lengths[chosen]] = True
            inner = np.flatnonzero(~heads)
            np.subtract.at(moved, (gold[inner - 1], gold[inner]), 1)
            started -= np.bincount(gold[heads], minlength=n_labels)
            spread = np.repeat(gap, counts[rows], axis=0)
            slope = {
                "weights": np.stack(
                    [np.bincount(own, weights=spread[:, i], minlength=n_features) for i in range(n_labels)], axis=1
                ),
                "moves": moved,
                "starts": started,
            }
            step += 1
            for p in parts:
                value = getattr(chain, p)
                g = (slope[p] / len(gold) + decay * value).astype(np.float32)
                first[p] += 0.1 * (g - first[p])
                second[p] += 0.01 * (g * g - second[p])
                m, v = first[p] / (1 - 0.9**step), second[p] / (1 - 0.99**step)
                value -= rate * m / (np.sqrt(v) + 1e-8)
    return chain


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers begin[i] ... begin[i] + size[i] - 1, for all i in turn."""
    total = int(size.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(size)
    return np.arange(total) - np.repeat(ends - size - begin, size)
