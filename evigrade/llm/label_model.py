"""A generative model of noisy voters, and a linear classifier on its posteriors.

A vote is 0 (abstains), 1 (clean) or 2 (toxic).  Given the class, voters are
independent but for cliques of voters that the data show to be correlated;
a clique has one joint table.  Expectation maximisation runs over counts of
vote patterns, a table bounded by 3 ** voters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Mutual information given the class, in nats, above which two voters count as correlated.
CORRELATED = 0.01
#: Voters of a clique at most: its table has 3 ** CLIQUE states, each worth the rows that tell of it.
CLIQUE = 3
#: Rows that the belief in voters is worth.
BELIEF = 40.0


@dataclass
class LabelModel:
    cliques: list[list[int]]
    prior: float
    tables: list[np.ndarray]
    """For each clique an array [class, joint state]."""

    def _states(self, votes: np.ndarray) -> list[np.ndarray]:
        out = []
        for clique in self.cliques:
            state = np.zeros(len(votes), np.int64)
            for voter in clique:
                state = 3 * state + votes[:, voter]
            out.append(state)
        return out

    def _log_joint(self, votes: np.ndarray) -> np.ndarray:
        """Log-probability of each row of votes with class 0 and with class 1."""
        out = np.repeat(np.log([[1 - self.prior], [self.prior]]), len(votes), 1)
        for table, state in zip(self.tables, self._states(votes)):
            out += np.log(table[:, state])
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability of class 1 for each row of votes."""
        clean, toxic = self._log_joint(votes)
        return 1 / (1 + np.exp(np.clip(clean - toxic, -50, 50)))

    def accuracy(self, voter: int) -> float:
        """How often a voter that doesn't abstain is right, by the model."""
        for clique, table in zip(self.cliques, self.tables):
            if voter in clique:
                shape = (2,) + (3,) * len(clique)
                axes = tuple(1 + i for i, v in enumerate(clique) if v != voter)
                own = table.reshape(shape).sum(axes)
                weight = np.array([1 - self.prior, self.prior])[:, None] * own
                said = weight[:, 1:].sum()
                return float((weight[0, 1] + weight[1, 2]) / said) if said else 0.5
        raise IndexError(voter)


def _maximise(model: LabelModel, votes: np.ndarray, counts: np.ndarray, p: np.ndarray) -> None:
    model.prior = float(np.clip((counts * p).sum() / counts.sum(), 1e-4, 1 - 1e-4))
    model.tables = []
    for clique, state in zip(model.cliques, model._states(votes)):
        n = 3 ** len(clique)
        table = np.stack([np.bincount(state, counts * w, n) for w in (1 - p, p)]) + _believed(clique)
        model.tables.append(table / table.sum(1, keepdims=True))


def _believed(clique: list[int]) -> np.ndarray:
    """Pseudo-counts [class, joint state]: a voter that speaks is right four times of five."""
    single = np.array([[0.4, 0.32, 0.08], [0.4, 0.08, 0.32]])
    joint = np.ones((2, 1))
    for _ in clique:
        joint = (joint[:, :, None] * single[:, None, :]).reshape(2, -1)
    return BELIEF * joint


def _expectation_maximisation(votes, counts, cliques, p, rounds=60) -> tuple[LabelModel, np.ndarray]:
    model = LabelModel(cliques, 0.5, [])
    for _ in range(rounds):
        _maximise(model, votes, counts, p)
        now = model.posterior(votes)
        if np.abs(now - p).max() < 1e-6:
            break
        p = now
    return model, p


def conditional_information(votes: np.ndarray, counts: np.ndarray, p: np.ndarray, i: int, j: int) -> float:
    """Mutual information of two voters given the class."""
    total, information = counts.sum(), 0.0
    for w in (1 - p, p):
        joint = np.bincount(3 * votes[:, i] + votes[:, j], counts * w, 9).reshape(3, 3) + 1e-9
        share = joint.sum() / total
        joint /= joint.sum()
        information += share * (joint * np.log(joint / joint.sum(1, keepdims=True) / joint.sum(0))).sum()
    return float(information)


def fit_label_model(votes: np.ndarray, counts: np.ndarray, label: int | None = None) -> LabelModel:
    """votes: distinct patterns [pattern, voter] of 0, 1, 2; counts: rows of each.

    label: a voter that stands for people's labels.  Rows where it speaks give the
    first estimates and show which other voters are correlated given the class, so
    the class is what the labels speak of; it is part of no clique.  Without
    such rows the estimates start from a majority vote.
    """
    votes = np.asarray(votes, np.int64)
    counts = np.asarray(counts, np.float64)
    voters = [v for v in range(votes.shape[1]) if v != label]
    single = [[v] for v in range(votes.shape[1])]
    told = votes[:, label] > 0 if label is not None else np.zeros(len(votes), bool)
    if told.any():
        p = np.where(votes[told, label] == 2, 0.97, 0.03)
        seen, weight = votes[told], counts[told]
    else:
        balance = (votes == 2).sum(1) - 0.5 * (votes == 1).sum(1)
        _, p = _expectation_maximisation(votes, counts, single, np.where(balance > 0, 0.9, 0.05))
        seen, weight = votes, counts
    pairs = [(conditional_information(seen, weight, p, i, j), i, j) for i in voters for j in voters if j < i]
    cliques = [list(c) for c in single]
    for information, i, j in sorted(pairs, reverse=True):
        if information < CORRELATED:
            break
        a, b = (next(c for c in cliques if v in c) for v in (i, j))
        if a is not b and len(a) + len(b) <= CLIQUE:
            cliques.remove(b)
            a += b
    first = LabelModel(cliques, 0.5, [])
    _maximise(first, seen, weight, p)
    return _expectation_maximisation(votes, counts, cliques, first.posterior(votes))[0]


def fit_linear(
    rows: np.ndarray, columns: np.ndarray, n: int, width: int, dense: np.ndarray, target: np.ndarray,
    ridge: float = 1.0, rounds: int = 400,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression on soft targets; sparse 0/1 features (rows, columns) and dense ones.

    Accelerated gradient descent with a ridge penalty.  Every coordinate has its own
    step, from a bound of its curvature, so rare features settle as fast as common
    ones.  Dense features are standardised; their scaling is folded into the
    returned weights: (sparse, dense, bias).
    """
    if not n:
        return np.zeros(width), np.zeros(dense.shape[1]), 0.0
    mean, scale = dense.mean(0), dense.std(0) + 1e-9
    z = (dense - mean) / scale
    weight = np.bincount(rows, minlength=n) + np.abs(z).sum(1) + 1
    curve_w = 0.25 * np.bincount(columns, weight[rows], width) + ridge
    curve_v = 0.25 * (np.abs(z) * weight[:, None]).sum(0) + ridge
    curve_b = 0.25 * weight.sum()
    w, v, b = np.zeros(width), np.zeros(dense.shape[1]), 0.0
    previous = (w, v, b)
    for t in range(rounds):
        k = t / (t + 3)
        sw, sv, sb = (x + k * (x - y) for x, y in zip((w, v, b), previous))
        logit = np.bincount(rows, sw[columns], n) + z @ sv + sb
        error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target
        previous = (w, v, b)
        w = sw - (np.bincount(columns, error[rows], width) + ridge * sw) / curve_w
        v = sv - (z.T @ error + ridge * sv) / curve_v
        b = sb - error.sum() / curve_b
    return w, v / scale, float(b - (v / scale * mean).sum())
