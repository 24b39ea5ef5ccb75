"""A skip-chain conditional random field in numpy: loopy message passing, and gradients of its weights.

Nodes have a label of LABELS; 0 is "none". Edges join neighbours (kind 0), equal nodes (1) and similar
ones (2) of one document; many documents can lie side by side in one graph, as no edge joins them.
"""

from __future__ import annotations

import numpy as np

#: Kinds of personal data in the order of reports, after "none".
LABELS = ("none", "email", "ip", "card", "phone")
K, EDGES, ROUNDS = len(LABELS), 3, 16
_NEVER = -1e6


def prior(features: int, bias: int, failed: dict[int, int]) -> np.ndarray:
    """Weights before learning: few nodes have a label, a node whose pattern failed has not its label, linked nodes agree."""
    unary, edges = np.zeros((features, K)), np.zeros((EDGES, K, K))
    unary[bias, 1:] = -2
    for feature, label in failed.items():
        unary[feature, label] = -4
    edges[1:] = np.diag([1.0] + [5.0] * (K - 1))
    return np.r_[unary.ravel(), edges.ravel()]


def _log_sum(x: np.ndarray, axis) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top


def _gathered(n: int, to: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(to, x[:, k], n) for k in range(x.shape[1])], axis=1)


def beliefs(unary: np.ndarray, edges: np.ndarray, potentials: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of nodes (n, K) and edges (m, K, K) after `rounds` of damped parallel messages.

    edges: rows of node, node, kind. Exact on graphs without loops that are no longer than the rounds reach. A
    document's result does not depend on which others share the graph.
    """
    u, v, kind = edges.T
    m, n = len(u), len(unary)
    source, to, back = np.r_[u, v], np.r_[v, u], np.r_[np.arange(m, 2 * m), np.arange(m)]
    pot = np.concatenate([potentials[kind], potentials[kind].transpose(0, 2, 1)])
    message = np.zeros((2 * m, K))
    for i in range(rounds):
        total = unary + _gathered(n, to, message)
        new = _log_sum((total[source] - message[back])[:, :, None] + pot, 1)[:, 0]
        new -= _log_sum(new, 1)
        message = new if i < 4 else (new + message) / 2
    total = unary + _gathered(n, to, message)
    joint = (total[u] - message[m:])[:, :, None] + (total[v] - message[:m])[:, None, :] + potentials[kind]
    return np.exp(total - _log_sum(total, 1)), np.exp(joint - _log_sum(joint, (1, 2)))


def scores(weights: np.ndarray, features: np.ndarray, fixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unary scores, with labels that are fixed (-1: free) made certain, and edge potentials."""
    at = len(weights) - EDGES * K * K
    unary = weights[:at].reshape(-1, K)[features].sum(axis=1)
    known = np.flatnonzero(fixed >= 0)
    unary[known] = _NEVER
    unary[known, fixed[known]] = 0
    return unary, weights[at:].reshape(EDGES, K, K)


def gradient(weights: np.ndarray, features: np.ndarray, edges: np.ndarray, labels: np.ndarray, fixed: np.ndarray) -> np.ndarray:
    """Of the log-likelihood of the labels given those that are fixed: what is seen less what is expected.

    A label of -1 is not known: such a node and its edges say nothing. The last feature fills rows up and has no weight.
    """
    unary, potentials = scores(weights, features, fixed)
    node, pair = beliefs(unary, edges, potentials)
    known = labels >= 0
    node = (np.eye(K)[labels] - node) * known[:, None]
    pair = np.eye(K)[labels[edges[:, 0]]][:, :, None] * np.eye(K)[labels[edges[:, 1]]][:, None, :] - pair
    pair *= (known[edges[:, 0]] & known[edges[:, 1]])[:, None, None]
    at = len(weights) - EDGES * K * K
    own, across = np.zeros((at // K, K)), np.zeros((EDGES, K, K))
    np.add.at(own, features.ravel(), np.repeat(node, features.shape[1], axis=0))
    own[-1] = 0
    np.add.at(across, edges[:, 2], pair)
    return np.r_[own.ravel(), across.ravel()]
