"""Exact forward and backward recursions of K-state chains over many sequences at once.

Sequences are cut into segments. The product of a segment's step matrices carries the message
across it, so all segments advance together and a very long sequence costs a few more array
operations instead of one Python step per token.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Carrying a message across a segment costs more than a step inside, so most texts have just one.
SEGMENT = 512


@dataclass
class Segments:
    """Segments in order of falling size; ``nth`` counts them within their sequence."""

    first: np.ndarray
    size: np.ndarray
    nth: np.ndarray
    follows: np.ndarray  # row of the segment before, -1 for the first
    active: np.ndarray  # active[t]: segments with more than t tokens


def segments(lengths: np.ndarray, most: int = SEGMENT) -> Segments:
    """Cuts sequences of the given lengths, all over 0, that lie one after the other."""
    parts = -(-lengths // most)
    sequence = np.repeat(np.arange(len(lengths)), parts)
    nth = np.arange(len(sequence)) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = np.cumsum(lengths) - lengths
    first = starts[sequence] + nth * most
    size = np.minimum(most, lengths[sequence] - nth * most)
    order = np.argsort(-size, kind="stable")
    row = np.empty(len(order), np.int64)
    row[order] = np.arange(len(order))
    follows = np.where(nth > 0, np.concatenate([[0], row[:-1]]) if len(row) else row, -1)
    longest = int(size.max(initial=0))
    size = size[order]
    active = np.searchsorted(-size, -np.arange(longest), "left")
    return Segments(first[order], size, nth[order], follows[order], active)


def _transfer(cut: Segments, emit: np.ndarray, move: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scaled product of the step matrices of the given segments, without the step into them."""
    states = len(move)
    out = np.zeros((len(cut.size), states, states))
    if not len(rows):
        return out
    first, size = cut.first[rows], cut.size[rows]
    held = emit[first][:, :, None] * np.eye(states)
    for t in range(1, int(size[0])):
        n = int(np.searchsorted(-size, -t, "left"))
        step = (held[:n].reshape(-1, states) @ move).reshape(n, states, states)
        step *= emit[first[:n] + t][:, None, :]
        if t % 16 == 0:
            step /= step.sum((1, 2), keepdims=True)
        held[:n] = step
    out[rows] = held / held.sum((1, 2), keepdims=True)
    return out


def _by_place(cut: Segments) -> list[np.ndarray]:
    """Rows of the first segments, of the second ones, and so on."""
    order = np.argsort(cut.nth, kind="stable")
    return np.split(order, np.cumsum(np.bincount(cut.nth))[:-1]) if len(order) else []


def _long(cut: Segments) -> np.ndarray:
    """Rows of all segments whose sequence has several."""
    several = np.zeros(len(cut.size), bool)
    later = cut.follows >= 0
    several[later] = True
    several[cut.follows[later]] = True
    return np.flatnonzero(several)


def forward(
    emit: np.ndarray, lengths: np.ndarray, start: np.ndarray, move: np.ndarray, ends: bool = False
):
    """Filtered state probabilities and log likelihood of each token given those before.

    ``emit`` has one positive row of emission weights per token, the sequences one after the
    other. With ``ends`` the cut and its transfers are returned too, for ``posterior``.
    """
    cut = segments(lengths)
    through = _transfer(cut, emit, move, _long(cut))
    into = np.tile(start, (len(cut.size), 1))
    for rows in _by_place(cut)[1:]:
        before = cut.follows[rows]
        message = np.einsum("bk,bkl->bl", into[before], through[before]) @ move
        into[rows] = message / message.sum(1, keepdims=True)
    alpha = np.empty_like(emit)
    logs = np.empty(len(emit))
    state = into
    for t, n in enumerate(cut.active.tolist()):
        at = cut.first[:n] + t
        state = (state if t == 0 else state[:n] @ move) * emit[at]
        norm = state.sum(1)
        state = state / norm[:, None]
        alpha[at] = state
        logs[at] = np.log(norm)
    return (alpha, logs, cut, through) if ends else (alpha, logs)


def posterior(emit: np.ndarray, lengths: np.ndarray, start: np.ndarray, move: np.ndarray):
    """Log likelihoods, state marginals of each token, and expected moves between states."""
    alpha, logs, cut, through = forward(emit, lengths, start, move, ends=True)
    states = len(move)
    back = np.ones((len(cut.size), states))
    for rows in reversed(_by_place(cut)[1:]):
        message = np.einsum("bkl,bl->bk", through[rows], back[rows]) @ move.T
        back[cut.follows[rows]] = message / message.sum(1, keepdims=True)
    gamma = np.empty_like(emit)
    scale = np.exp(logs)
    moves = np.zeros((states, states))
    active = cut.active.tolist()
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = cut.first[:n] + t
        if t + 1 < len(active):
            m = active[t + 1]
            lower = back[:m] * emit[at[:m] + 1]
            lower = lower @ move.T
            back[:m] = lower / lower.sum(1, keepdims=True)
        own = alpha[at] * back[:n]
        total = own.sum(1, keepdims=True)
        gamma[at] = own / total
        came = slice(None) if t else cut.follows[:n] >= 0
        weight = emit[at[came]] * back[:n][came]
        # The step into a token weighs what its likelihood and its marginals add up to.
        weight /= (scale[at][:, None] * total)[came]
        moves += alpha[at[came] - 1].T @ weight
    return logs, gamma, moves * move
