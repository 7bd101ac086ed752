"""Learners: how one series is fitted inside a task.

A learner is the user's replacement point. It needs a ``name`` and the three methods
below, all on plain arrays. A learner may also offer ``fit_panel`` (all series as one
Spark job), ``fit_many`` (a list of short series at once, where that is faster) or ``fit_large``
(a Spark job for series too long for one task). Simplest for long series are the four methods of
``MergeableLearner``: many tasks then share one series.
"""

from __future__ import annotations

import io
from dataclasses import dataclass
from typing import Any, Protocol

import numpy as np

from tidecast.session import MAX_TASK_ROWS

# Bins of missing values and of rows that fill up a series, above all others.
MISSING, FILL = 32_001, 32_002
# Values of features that short series fill when they are fitted together: what a core's cache holds.
CELLS_TOGETHER = 32_768


class Learner(Protocol):
    name: str

    def fit(self, X: np.ndarray, y: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Model bytes and one importance per feature."""

    def load(self, blob: bytes) -> Any: ...

    def predict(self, model: Any, X: np.ndarray) -> np.ndarray: ...


class MergeableLearner(Learner, Protocol):
    """A learner that keeps a state instead of rows. A state is one array of doubles."""

    def start(self, features: int) -> np.ndarray:
        """The state of no rows."""

    def add(self, state: np.ndarray, X: np.ndarray, y: np.ndarray) -> np.ndarray: ...

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The state of the rows of both."""

    def finish(self, state: np.ndarray) -> tuple[bytes, np.ndarray]:
        """What ``fit`` gives for all the rows."""


def share(values: np.ndarray) -> np.ndarray:
    """Scaled to sum 1; all zero stays all zero."""
    total = values.sum()
    return values / total if total > 0 else np.zeros_like(values)


@dataclass(frozen=True)
class Linear:
    """Least squares with intercept; see ``operators.linear`` for the fit of all series."""

    name: str = "linear"

    def fit(self, X, y):
        keep = ~(np.isnan(X).any(axis=1) | np.isnan(y))
        X, y = X[keep].astype(float), y[keep].astype(float)
        if not len(y):
            raise ValueError("no complete row")
        center = X.mean(axis=0)
        coef = np.linalg.lstsq(X - center, y - y.mean(), rcond=None)[0]
        blob = np.concatenate([[y.mean() - center @ coef], coef]).tobytes()
        return blob, share(np.abs(coef) * X.std(axis=0))

    def load(self, blob):
        return np.frombuffer(blob)

    def predict(self, model, X):
        return model[0] + X.astype(float) @ model[1:]

    def fit_panel(self, df, spec):
        from tidecast.operators.linear import fit_linear

        return fit_linear(df, spec)


@dataclass(frozen=True)
class Boosted:
    """Gradient-boosted regression trees on squared error, grown level by level.

    Fixed values: the defaults are those of the usual public library.
    """

    rounds: int = 100
    depth: int = 6
    eta: float = 0.3
    l2: float = 1.0
    min_gain: float = 1e-6
    min_child: float = 1.0
    max_bin: int = 256
    name: str = "gbt"

    def __post_init__(self):
        if not 1 <= self.max_bin <= 32_000:
            raise ValueError("max_bin must be from 1 to 32000, as bins are stored in 16 bits")
        if not 1 <= self.depth <= 15:
            raise ValueError("depth must be from 1 to 15, as nodes are stored in 16 bits")
        if self.rounds < 1:
            raise ValueError("rounds must be at least 1")

    def cuts(self, x: np.ndarray) -> np.ndarray:
        """Ascending thresholds of one feature: its quantiles above the minimum."""
        x = x[~np.isnan(x)]
        if not len(x):
            return np.empty(0, dtype=x.dtype)
        x.sort()
        at = np.ceil(np.arange(1, self.max_bin + 1) / self.max_bin * len(x)).astype(int) - 1
        values = np.unique(x[at])
        return values[values > x[0]]

    def best_splits(self, g, bins, counts, totals, missing):
        """Best split of every node of several series: feature (-1 for none), bin, where missing values go, gain.

        ``g`` and ``bins`` are (feature, series, row), each series ordered by node, then by bin. ``counts``
        and ``totals`` are the rows and the gradient sum of each node, (series, node). ``missing`` tells
        whether any value is MISSING. Gains are taken only where a bin ends, as no cut lies elsewhere.
        """
        width, every = len(g), counts.size
        span = g[0].size
        at = np.arange(every).repeat(counts.ravel())
        left_g = g.cumsum(axis=2).reshape(width, span)
        left_g -= (totals.cumsum(axis=1) - totals).ravel().take(at)
        counts, totals = counts.ravel(), totals.ravel()
        left_h = np.arange(1.0, span + 1) - (counts.cumsum() - counts).take(at)
        right_h = counts.take(at) - left_h
        least = max(self.min_child - 0.5, 0.5)
        g, bins = g.reshape(width, span), bins.reshape(width, span)
        may_cut = np.empty(bins.shape, dtype=bool)
        np.not_equal(bins[:, 1:], bins[:, :-1], out=may_cut[:, :-1])
        may_cut[:, -1] = False
        if missing:
            is_missing = bins == MISSING
            may_cut &= ~is_missing & (right_h > 0.5)
        else:
            may_cut &= np.minimum(left_h, right_h) > least
        place = may_cut.ravel().nonzero()[0]
        feature = place // span
        row = place - feature * span
        node = at.take(row)
        group = feature * every + node
        left_g, left_h = left_g.ravel().take(place), left_h.take(row)
        total_g, total_h = totals.take(node), counts.take(node).astype(float)

        def gain(lg, lh):
            rg, rh = total_g - lg, total_h - lh
            value = lg * lg / (lh + self.l2) + rg * rg / (rh + self.l2)
            return np.where(np.minimum(lh, rh) > least, value, -np.inf) if missing else value

        score, miss_left = gain(left_g, left_h), None
        if missing:
            there = counts.nonzero()[0]
            start = (counts.cumsum() - counts)[there]
            lost_g, lost_h = np.zeros((2, width, every))
            lost_g[:, there] = np.add.reduceat(np.where(is_missing, g, 0.0), start, axis=1)
            lost_h[:, there] = np.add.reduceat(is_missing.astype(float), start, axis=1)
            other = gain(left_g + lost_g.ravel().take(group), left_h + lost_h.ravel().take(group))
            miss_left = other > score
            score = np.maximum(score, other)
        score = (score - (totals * totals / (counts + self.l2)).take(node)).astype(np.float32)
        top, best = np.full(width * every, -np.inf, dtype=np.float32), np.zeros(every, dtype=np.intp)
        if len(place):
            starts = np.append(0, (group[1:] != group[:-1]).nonzero()[0] + 1)
            top[group.take(starts)] = np.maximum.reduceat(score, starts)
        top = top.reshape(width, every).max(axis=0)
        # Of equal ones the first feature and its first bin: assigned last.
        hits = (score == top.take(node)).nonzero()[0][::-1]
        best[node.take(hits)] = hits
        ok = top > self.min_gain
        best = best * ok
        if not len(place):
            none = np.zeros(every, dtype=np.intp)
            return none - 1, none, none > 0, none * 0.0
        left = ok & miss_left.take(best) if missing else np.zeros(every, dtype=bool)
        return np.where(ok, feature.take(best), -1), bins.ravel().take(place.take(best)), left, np.where(ok, top, 0.0)

    def fit(self, X, y):
        return self.fit_many([(X, y)])[0]

    def fit_many(self, series):
        """What ``fit`` gives for each (X, y), bit by bit. Short series of like length share the array work."""
        known = [(X[keep], y[keep].astype(float)) for X, y, keep in ((X, y, ~np.isnan(y)) for X, y in series)]
        if not all(len(y) for _, y in known):
            raise ValueError("no row with a target")
        fitted = [None] * len(known)
        width = known[0][0].shape[1] if known else 0
        waiting = sorted(range(len(known)), key=lambda i: -len(known[i][1]))
        while waiting:
            longest = len(known[waiting[0]][1])
            most = max(1, CELLS_TOGETHER // (longest * max(1, width)))
            together = [i for i in waiting[:most] if 2 * len(known[i][1]) >= longest]
            waiting = waiting[len(together) :]
            with np.errstate(divide="ignore", invalid="ignore"):
                for i, found in zip(together, self._fit_together([known[i] for i in together])):
                    fitted[i] = found
        return fitted

    def _fit_together(self, series):
        """Trees of several series, level by level for all at once. Rows that fill up a shorter series
        lie in a last node of their own, which is left out of all results."""
        count, width = len(series), series[0][0].shape[1]
        rows = np.array([len(y) for _, y in series])
        longest = rows.max()
        span = count * longest
        cuts = [[self.cuts(X[:, f].copy()) for f in range(width)] for X, _ in series]
        bins = np.full((width, count, longest), FILL, dtype=np.int16)
        target, pred = np.zeros((2, count, longest))
        for s, (X, y) in enumerate(series):
            target[s, : len(y)], pred[s, : len(y)] = y, y.mean()
            for f in range(width):
                found = np.searchsorted(cuts[s][f], X[:, f], side="right")
                bins[f, s, : len(y)] = np.where(np.isnan(X[:, f]), MISSING, found)
        missing = bool((bins == MISSING).any())
        lane = np.arange(width)[:, None, None] * span + np.arange(count)[:, None] * longest
        by_bin = bins.argsort(axis=2, kind="stable") + lane
        flat, bins_by_bin = bins.ravel(), bins.ravel().take(by_bin)
        by_bin %= span
        target, pred = target.ravel(), pred.ravel()
        row, owner = np.arange(span), np.arange(count).repeat(longest)
        filling = (np.arange(longest) >= rows[:, None]).ravel().astype(np.uint16)
        inner, leaves = 2**self.depth - 1, 2**self.depth
        small = np.uint8 if leaves < 512 else np.uint16
        feat = np.full((count, self.rounds, inner), -1, dtype=np.int16)
        cut = np.zeros((count, self.rounds, inner), dtype=np.int32)
        miss = np.zeros((count, self.rounds, inner), dtype=bool)
        value = np.zeros((count, self.rounds, leaves), dtype=np.float32)
        gains = np.zeros((count, self.rounds, inner))

        def sums(at, nodes, weights=None):
            return np.bincount(at, weights, minlength=count * nodes).reshape(count, nodes)

        for t in range(self.rounds):
            g = pred - target
            order, in_order, node, grows = by_bin, bins_by_bin, filling, np.ones(count, dtype=bool)
            for d in range(self.depth):
                nodes = 2**d + 1
                at = node + owner * nodes
                best = self.best_splits(g.take(order), in_order, sums(at, nodes), sums(at, nodes, g), missing)
                if not grows.all():  # a series without a split has ended its tree
                    ended = ~grows.repeat(nodes)
                    best[0][ended], best[2][ended], best[3][ended] = -1, False, 0.0
                level = slice(2**d - 1, 2 ** (d + 1) - 1)
                for held, new in zip((feat, cut, miss, gains), best):
                    held[:, t, level] = new.reshape(count, nodes)[:, :-1]
                own_f = best[0].take(at)
                own = flat.take(own_f * span + row, mode="wrap")
                right = own > best[1].take(at)
                if missing:
                    right = np.where(own == MISSING, ~best[2].take(at), right)
                node = 2 * node + (right & (own_f >= 0))
                grows = (best[0].reshape(count, nodes) >= 0).any(axis=1)
                if not grows.any():
                    node = node * 2 ** (self.depth - d - 1)
                    break
                if d < self.depth - 1:
                    by_node = node.astype(small).take(order).argsort(axis=2, kind="stable")
                    by_node += lane
                    order, in_order = order.take(by_node), in_order.take(by_node)
            at = node + owner * (leaves + 1)
            leaf = (-self.eta * sums(at, leaves + 1, g) / (sums(at, leaves + 1) + self.l2)).astype(np.float32)
            leaf[:, -1] = 0
            value[:, t] = leaf[:, :-1]
            pred = pred + leaf.take(at)
        return [
            (self.pack(y.mean(), feat[s], cut[s], miss[s], value[s], cuts[s]), self.importances(feat[s], gains[s], width))
            for s, (_, y) in enumerate(series)
        ]

    def importances(self, feat, gains, width):
        """Mean gain per split of each feature, as a share."""
        used = feat >= 0
        total = np.bincount(feat[used], gains[used], minlength=width)
        return share(total / np.maximum(np.bincount(feat[used], minlength=width), 1))

    def pack(self, base, feat, cut, miss, value, cuts):
        """Bytes of the trees, with cut numbers turned into thresholds (left when below)."""
        edges = [np.append(np.asarray(c, dtype=np.float32), np.float32(np.inf)) for c in cuts]
        threshold = np.full(feat.shape, np.inf, dtype=np.float32)
        for f, values in enumerate(edges):
            mine = feat == f
            threshold[mine] = values[np.minimum(cut[mine], len(values) - 1)]
        out = io.BytesIO()
        np.savez(out, base=np.float64(base), feat=feat, threshold=threshold, miss=miss, value=value)
        return out.getvalue()

    def load(self, blob):
        with np.load(io.BytesIO(blob), allow_pickle=False) as stored:
            return {k: stored[k] for k in stored.files}

    def predict(self, model, X):
        feat, threshold, miss, value = (model[k] for k in ("feat", "threshold", "miss", "value"))
        trees, inner = feat.shape
        feat, threshold, miss = feat.ravel(), threshold.ravel(), miss.ravel()
        first_node = np.arange(trees)[:, None] * inner
        depth = int(np.log2(value.shape[1]))
        out = np.empty(len(X))
        for first in range(0, len(X), 512):
            part = X[first : first + 512].astype(np.float32)
            first_value = np.arange(len(part)) * part.shape[1]
            unknown = np.isnan(part).any()
            node = np.zeros((trees, len(part)), dtype=np.int64)
            for _ in range(depth):
                at = node + first_node
                f = feat.take(at)
                x = part.take(f + first_value, mode="wrap")
                right = x >= threshold.take(at)
                if unknown:
                    right = np.where(np.isnan(x), ~miss.take(at), right)
                node = 2 * node + 1 + (right & (f >= 0))
            leaf = node - inner + np.arange(trees)[:, None] * (inner + 1)
            out[first : first + len(part)] = model["base"] + value.take(leaf).sum(axis=0, dtype=float)
        return out

    def fit_large(self, df, spec, max_task_rows=MAX_TASK_ROWS):
        from tidecast.operators.boosting import fit_boosted

        return fit_boosted(df, spec, self, max_task_rows)


@dataclass(frozen=True)
class Ridge:
    """Least squares with intercept and a penalty on slopes, from moments that can be merged.

    The state is the number of complete rows, the means and the sums of products about the means
    of features and target. Features count in units of their standard deviation.
    """

    penalty: float = 0.0
    name: str = "ridge"

    def fit(self, X, y):
        return self.finish(self.add(self.start(X.shape[1]), X, y))

    def start(self, features):
        return np.zeros(1 + (features + 1) + (features + 1) ** 2)

    def _parts(self, state):
        width = int(round((np.sqrt(4 * len(state) - 3) - 1) / 2))
        return state[0], state[1 : 1 + width], state[1 + width :].reshape(width, width)

    def add(self, state, X, y):
        rows = np.column_stack([X, y]).astype(float)
        rows = rows[~np.isnan(rows).any(axis=1)]
        if not len(rows):
            return state
        mean = rows.mean(axis=0)
        about = rows - mean
        return self.merge(state, np.concatenate([[len(rows)], mean, (about.T @ about).ravel()]))

    def merge(self, a, b):
        (n, mean_a, about_a), (m, mean_b, about_b) = self._parts(a), self._parts(b)
        if not n or not m:
            return b if not n else a
        apart = mean_b - mean_a
        about = about_a + about_b + np.outer(apart, apart) * (n * m / (n + m))
        return np.concatenate([[n + m], mean_a + apart * (m / (n + m)), about.ravel()])

    def finish(self, state):
        n, mean, about = self._parts(state)
        if not n:
            raise ValueError("no complete row")
        spread = np.sqrt(np.diag(about)[:-1] / n)
        unit = np.where(spread > 0, spread, 1.0)
        scaled = about[:-1, :-1] / np.outer(unit, unit) / n
        wanted = about[:-1, -1] / unit / n
        coef = np.linalg.pinv(scaled + self.penalty * np.eye(len(unit)), hermitian=True) @ wanted / unit
        blob = np.concatenate([[mean[-1] - mean[:-1] @ coef], coef]).tobytes()
        return blob, share(np.abs(coef) * spread)

    def load(self, blob):
        return np.frombuffer(blob)

    def predict(self, model, X):
        return model[0] + X.astype(float) @ model[1:]
