"""Decision trees grown level by level, many at once.

All grid points that differ only in depth, least rows of a split or number of
trees share their trees: those limits are applied when a tree is read. What is
left are *stems*, and one pass over the rows advances the current level of every
tree of every stem and fold. A task adds up a histogram per node; histograms of
a node meet in one executor, which picks the split; the driver gets one row per
node. A node with few rows is sent to one task that grows all below it with the
same code, so passes are as many as large levels. A table that is small as a
whole goes to its trees' tasks at once.

Numbers are cut at all their values up to 255, at quantiles beyond. Extremely
randomised trees have no bins: every node draws its cut points from its own
range. Draws depend on seed, tree, node and feature alone, so a tree is the same
however its rows were spread.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablewright.operators.design import TEST, batches
from tablewright.session import map_arrow, ship

DEEPEST = 64
MAX_BINS = 255
SUMMARY = 2048  # points that stand for a column within a task, if it has more values
LOCAL_ROWS = 8192  # of a node that one task grows on
LOCAL_CELLS = 1 << 20  # rows x features of a table that goes to the tasks whole
HIST_BYTES = 64 << 20
SLICE_CELLS = 1 << 22
FAMILIES = 24  # trees of a stem are grown in so many tasks at most, if the table is small
NOTHING = 1e-10


# --- features ---------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Fill:
    """What a training subset puts in place of missing values, and the features that vary in it."""

    numbers: np.ndarray
    modes: tuple[int, ...]
    live: np.ndarray


def fills(enc, moments, t: int) -> Fill:
    if enc.sparse:
        return Fill(np.zeros(0), (), np.ones(enc.n_features, bool))
    sums = moments.train("sums", t).sum(axis=0)
    p, at = enc.n_numbers, 1 + enc.n_numbers + len(enc.missing_numbers)
    gone = np.zeros(p)
    gone[list(enc.missing_numbers)] = sums[1 + p : at]
    here = sums[0] - gone
    modes, live, words = [], [here > 0], at
    for vocab in enc.vocab:
        counts = sums[words : words + len(vocab)]
        modes.append(int(np.argmax(counts)) if len(vocab) else -1)
        live.append(counts > 0)
        words += len(vocab)
    return Fill(np.where(here > 0, sums[1 : 1 + p] / np.maximum(here, 1), 0.0), tuple(modes), np.concatenate(live))


def matrix(enc, batch, fill: Fill) -> np.ndarray:
    """Features of encoded rows: numbers, then a flag per category; nothing is learned but the fill."""
    if enc.sparse:
        return batch._dense()[:, 1:]
    p, u = enc.n_numbers, batch.u
    at = 1 + p + len(enc.missing_numbers)
    words = sum(map(len, enc.vocab))
    x = np.concatenate([u[:, 1 : 1 + p], u[:, at : at + words]], axis=1)
    for i, j in enumerate(enc.missing_numbers):
        x[:, j] += u[:, 1 + p + i] * fill.numbers[j]
    starts = np.cumsum([p, *map(len, enc.vocab)])
    for i, j in enumerate(enc.missing_categories):
        if fill.modes[j] >= 0:
            x[:, starts[j] + fill.modes[j]] += u[:, at + words + i]
    return x


def _summary(values: np.ndarray, weights: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values with their weights; beyond ``points`` of them, values at even steps of the weight."""
    v, inner = np.unique(values, return_inverse=True)
    w = np.bincount(inner, weights, len(v))
    if len(v) > points:
        end = np.cumsum(w)
        at = np.unique(np.searchsorted(end, np.linspace(0, end[-1], points + 1)[1:], "left").clip(0, len(v) - 1))
        v, w = v[at], np.diff(end[at], prepend=0)
    return v, w


def cut_points(rows: DataFrame, enc, filled: list[Fill]) -> list[np.ndarray]:
    """Ascending cuts of every feature: between all values of one with up to ``MAX_BINS``, else at quantiles."""
    n_numbers = enc.n_features if enc.sparse else enc.n_numbers
    d = n_numbers if enc.sparse else n_numbers + sum(map(len, enc.vocab))
    cuts = [np.array([0.5]) for _ in range(d)]
    if not n_numbers:
        return cuts
    missing = set() if enc.sparse else set(enc.missing_numbers)

    def summarise(it):
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches(enc, it):
            for part in slices(b, d):
                x = matrix(enc, part, filled[-1])
                for j in range(n_numbers):
                    v, w = x[:, j], np.ones(part.n)
                    if j in missing:
                        here = part.u[:, 1 + n_numbers + enc.missing_numbers.index(j)] == 0
                        v, w = v[here], w[here]
                    if j in held:
                        v, w = np.append(held[j][0], v), np.append(held[j][1], w)
                    held[j] = _summary(v, w, SUMMARY)
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v, _ in held.values()]), pa.array([w.tobytes() for _, w in held.values()])], ["feature", "v", "w"])

    def merge(t: pa.Table) -> pa.Table:
        j = t.column("feature")[0].as_py()
        v, w = (np.concatenate([np.frombuffer(x, float) for x in t.column(c).to_pylist()]) for c in ("v", "w"))
        more = [f.numbers[j] for f in filled] if j in missing else []
        v, _ = _summary(np.append(v, more), np.append(w, np.full(len(more), 1e-9)), MAX_BINS)
        return pa.table([pa.array([j], pa.int32()), pa.array([((v[1:] + v[:-1]) / 2).tobytes()], pa.binary())], ["feature", "cuts"])

    ship(rows.sparkSession)
    found = map_arrow(rows.where(F.col("fold") != TEST), summarise, "feature int, v binary, w binary")
    for r in found.groupBy("feature").applyInArrow(merge, "feature int, cuts binary").collect():
        cuts[r["feature"]] = np.frombuffer(r["cuts"], float)
    return cuts


def slices(batch, d: int):
    step = max(1, SLICE_CELLS // max(1, d))
    for a in range(0, batch.n, step):
        if a == 0 and batch.n <= step:
            yield batch
        else:
            yield batch.pick((np.arange(batch.n) >= a) & (np.arange(batch.n) < a + step))


# --- stems and trees -----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Stem:
    """The trees that some grid points share. ``rate`` > 0: boosting, ``n_trees`` rounds of a tree per score."""

    classify: bool
    n_classes: int
    subset: int
    n_trees: int = 1
    criterion: str = "gini"
    random: bool = False
    max_features: int | None = None
    max_depth: int = DEEPEST
    min_split: int = 2
    min_leaf: int = 1
    bootstrap: bool = False
    rate: float = 0.0
    subsample: float = 1.0
    patience: int = 0
    seed: int = 42

    @property
    def scores(self) -> int:
        """Trees of a boosting round."""
        return self.n_classes if self.classify and self.n_classes > 2 else 1


def mix(x: np.ndarray | int, salt: int) -> np.ndarray:
    """64 well-mixed bits."""
    with np.errstate(over="ignore"):
        z = np.asarray(x, np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def uniform(bits: np.ndarray) -> np.ndarray:
    return (bits >> np.uint64(11)).astype(float) * 2.0**-53


POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 16)]))
#: The draw that the first 16 bits give alone, or 255.
POISSON_BITS = np.searchsorted(POISSON, np.arange(1 << 16) * 2.0**-16).astype(np.uint8)
POISSON_BITS[POISSON_BITS != np.searchsorted(POISSON, np.arange(1, (1 << 16) + 1) * 2.0**-16 - 2.0**-53)] = 255


def poisson(bits: np.ndarray) -> np.ndarray:
    """Draws with mean 1: most are told by the first bits."""
    out = POISSON_BITS[(bits >> np.uint64(48)).astype(np.int64)]
    open_ = np.flatnonzero(out == 255)
    out[open_] = np.searchsorted(POISSON, uniform(bits[open_]))
    return out.astype(float)


def row_weights(stem: Stem, tree: int, keys: np.ndarray) -> np.ndarray:
    """How often a tree sees a row: a Poisson draw for bootstrap, a share of the rows for boosting."""
    if stem.bootstrap:
        return poisson(mix(keys, stem.seed * 1000003 + tree + 1))
    if stem.subsample < 1:
        return (uniform(mix(keys, stem.seed * 1000003 + tree // stem.scores + 1)) < stem.subsample).astype(float)
    return np.ones(len(keys))


def validation_rows(keys: np.ndarray) -> np.ndarray:
    """A tenth of the rows decides when boosting stops."""
    return uniform(mix(keys, 77)) < 0.1


@dataclass
class Tree:
    """Nodes by number; the right child follows the left one."""

    feature: list[int] = field(default_factory=list)  # -1: leaf
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    key: list[int] = field(default_factory=list)
    n: list[float] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)

    def add(self, depth: int, key: int, n: float, value: np.ndarray) -> int:
        for c, v in zip((self.feature, self.threshold, self.left, self.depth, self.key, self.n, self.value), (-1, 0.0, -1, depth, key, n, value)):
            c.append(v)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, threshold: float, sides: list[tuple[float, np.ndarray]]) -> int:
        """The number of the left child."""
        self.feature[node], self.threshold[node], self.left[node] = feature, threshold, len(self.feature)
        for side, (n, value) in enumerate(sides):
            self.add(self.depth[node] + 1, int(mix(self.key[node], 2 + side)), n, value)
        return self.left[node]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return (np.array(self.feature, np.int32), np.array(self.threshold), np.array(self.left, np.int32), np.array(self.depth, np.int32),
                np.array(self.n), np.array(self.value))


def grafted(top: tuple, below: list[tuple[int, tuple]]) -> tuple:
    """Arrays of a tree whose nodes are taken by the roots of other trees; both as arrays, nothing is kept per node."""
    if not below:
        return top
    top = tuple(a.copy() for a in top)
    parts, shift = [[a] for a in top], len(top[0])
    for node, other in below:
        left = np.where(other[2] >= 0, other[2] - 1 + shift, -1).astype(top[2].dtype)
        for i, a in enumerate(other):
            if i == 3:
                parts[i].append(a[1:])  # a node keeps its depth
                continue
            a = left if i == 2 else a
            top[i][node] = a[0]
            parts[i].append(a[1:])
        shift += len(left) - 1
    return tuple(np.concatenate(p) for p in parts)


def root(stem: Stem, tree: int) -> Tree:
    t = Tree()
    t.add(0, int(mix(tree, stem.seed)), np.inf, np.zeros(max(1, stem.n_classes if stem.classify and not stem.rate else 1)))
    return t


def reach(arrays, x: np.ndarray, max_depth: int = DEEPEST, min_split: float = 0) -> np.ndarray:
    """The node that every row ends in, if nodes at ``max_depth`` or below ``min_split`` rows aren't split."""
    feature, threshold, left, depth, n, _ = arrays
    at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while True:
        f = feature[at]
        go = (f >= 0) & (depth[at] < max_depth) & (n[at] >= min_split)
        if not go.any():
            return at
        at = np.where(go, left[at] + (x[rows, f] > threshold[at]), at)


# --- splits -------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Bins:
    """Bins of all features side by side. ``marks``: values of the target that absolute errors are counted by."""

    cuts: list[np.ndarray]
    live: np.ndarray
    marks: np.ndarray | None = None

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum([0, *(len(c) + 1 for c in self.cuts)])

    def codes(self, x: np.ndarray) -> np.ndarray:
        return np.stack([a + np.searchsorted(c, x[:, j], "left") for j, (a, c) in enumerate(zip(self.starts, self.cuts))], 1).astype(np.int32)


def width(stem: Stem, bins: Bins) -> int:
    """Sums that a node keeps."""
    if stem.rate:
        return 4
    return stem.n_classes if stem.classify else 2 * (len(bins.marks) + 1) if stem.criterion == "absolute_error" else 3


def channels(stem: Stem, bins: Bins, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray | None, list[np.ndarray]]:
    """Index among the sums, or None, and the weights that go there (or to each sum)."""
    if stem.rate:
        r, h = y.T
        return None, [w, w * r, w * r * r, w * h]
    if stem.classify:
        return y.astype(np.int64), [w]
    if stem.criterion == "absolute_error":
        return np.searchsorted(bins.marks, y, "left"), [w, w * y]
    return None, [w, w * y, w * y * y]


def sums(stem: Stem, bins: Bins, place: np.ndarray, size: int, y: np.ndarray, w: np.ndarray, times: int = 1) -> np.ndarray:
    """Sums per place: [size, width]; ``times``: places per row, row by row."""
    index, weights = channels(stem, bins, y, w)
    n = width(stem, bins)
    if times > 1:
        weights = [np.repeat(v, times) for v in weights]
        index = None if index is None else np.repeat(index, times)
    if index is None:
        return np.stack([np.bincount(place, v, size) for v in weights], 1)
    each = n // len(weights)
    return np.concatenate([np.bincount(place * each + index, v, size * each).reshape(size, each) for v in weights], 1)


def count(stem: Stem, s: np.ndarray) -> np.ndarray:
    if stem.classify and not stem.rate:
        return s.sum(-1)
    return s[..., : s.shape[-1] // 2].sum(-1) if stem.criterion == "absolute_error" and not stem.rate else s[..., 0]


def _median(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Median and sum of absolute errors from counts and sums by the target's marks."""
    q = s.shape[-1] // 2
    c, v = s[..., :q], s[..., q:]
    below, total = np.cumsum(c, -1), np.cumsum(v, -1)
    n = below[..., -1:]
    mean = np.divide(v, c, out=np.zeros_like(v), where=c > 0)
    lo, hi = ((below >= n / 2 - NOTHING).argmax(-1)[..., None], (below > n / 2 + NOTHING).argmax(-1)[..., None])
    take = lambda a, i: np.take_along_axis(a, i, -1)[..., 0]
    middle = (take(mean, lo) + take(mean, hi)) / 2
    le, sum_le = take(below, lo), take(total, lo)
    error = middle * le - sum_le + (total[..., -1] - sum_le) - middle * (n[..., 0] - le)
    return middle, np.maximum(error, 0)


def purity(stem: Stem, s: np.ndarray) -> np.ndarray:
    """The more, the purer: minus the impurity times the rows, up to what all splits of a node share."""
    if stem.rate or not stem.classify and stem.criterion != "absolute_error":
        return np.divide(s[..., 1] ** 2, s[..., 0], out=np.zeros(s.shape[:-1]), where=s[..., 0] > 0)
    if stem.criterion == "absolute_error":
        return -_median(s)[1]
    n = s.sum(-1)
    if stem.criterion == "entropy":
        return (s * np.log(np.maximum(s, 1e-300))).sum(-1) - n * np.log(np.maximum(n, 1e-300))
    return np.divide((s * s).sum(-1), n, out=np.zeros(n.shape), where=n > 0)


def leaf(stem: Stem, s: np.ndarray) -> np.ndarray:
    """Values of nodes [.., classes or 1]."""
    n = count(stem, s)[..., None]
    if stem.rate:
        if not stem.classify:
            return np.divide(s[..., 1:2], n, out=np.zeros(n.shape), where=n > 0)
        k = stem.scores
        return np.divide(s[..., 1:2] * ((k - 1) / k if k > 1 else 1.0), s[..., 3:4], out=np.zeros(n.shape), where=s[..., 3:4] > 1e-150)
    if stem.classify:
        return np.divide(s, n, out=np.zeros(s.shape), where=n > 0)
    if stem.criterion == "absolute_error":
        return _median(s)[0][..., None]
    return np.divide(s[..., 1:2], n, out=np.zeros(n.shape), where=n > 0)


def is_pure(stem: Stem, s: np.ndarray) -> np.ndarray:
    if stem.classify and not stem.rate:
        return s.max(-1) >= s.sum(-1)
    if stem.criterion == "absolute_error" and not stem.rate:
        return (s[..., : s.shape[-1] // 2] > 0).sum(-1) <= 1
    return s[..., 2] - np.divide(s[..., 1] ** 2, s[..., 0], out=np.zeros(s.shape[:-1]), where=s[..., 0] > 0) <= 1e-12 * np.maximum(s[..., 2], 1e-300)


def open_nodes(stem: Stem, depth: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Which nodes with these sums may be split."""
    n = count(stem, s)
    return (depth < stem.max_depth) & (n >= max(stem.min_split, 2 * stem.min_leaf)) & ~is_pure(stem, s)


def chosen_features(stem: Stem, keys: np.ndarray, varies: np.ndarray) -> np.ndarray:
    """Of the features that vary in a node, the first ``max_features`` in the node's own order."""
    if stem.max_features is None or stem.max_features >= varies.shape[1]:
        return varies
    order = uniform(mix(keys[:, None] ^ mix(np.arange(varies.shape[1]), 5)[None], stem.seed))
    order = np.where(varies, order, 2.0)
    return varies & (order <= np.sort(order, 1)[:, stem.max_features - 1 : stem.max_features])


def best_cut(stem: Stem, bins: Bins, keys: np.ndarray, hist: np.ndarray) -> list[tuple[int, float, np.ndarray, np.ndarray] | None]:
    """For each node of ``hist`` [nodes, bins, sums]: feature, threshold, sums left and right; the first of equal cuts."""
    starts = bins.starts
    per = np.diff(starts)
    total = hist[:, : starts[1]].sum(1)
    left = np.cumsum(hist, 1)
    left -= np.repeat(np.concatenate([np.zeros((len(hist), 1, hist.shape[2])), left[:, starts[1:-1] - 1]], 1), per, axis=1)
    right = total[:, None] - left
    n_left, n_right = count(stem, left), count(stem, right)
    fits = (n_left >= stem.min_leaf) & (n_right >= stem.min_leaf)
    varies = np.logical_or.reduceat((n_left > NOTHING) & (n_right > NOTHING), starts[:-1], axis=1) & bins.live
    fits &= np.repeat(chosen_features(stem, keys, varies), per, axis=1)
    gain = np.where(fits, purity(stem, left) + purity(stem, right), -np.inf)
    top = gain.max(1, keepdims=True)
    at = (gain >= top - NOTHING * np.abs(top)).argmax(1)
    feature = np.searchsorted(starts, at, "right") - 1
    return [(int(f), float(bins.cuts[f][c - starts[f]]), left[i, c], right[i, c]) if np.isfinite(top[i, 0]) else None for i, (c, f) in enumerate(zip(at, feature))]


def draw_cuts(stem: Stem, bins: Bins, keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features [nodes, k] in order (-1: none) and a threshold of each, drawn between the node's least and greatest value."""
    picked = chosen_features(stem, keys, (hi > lo) & bins.live)
    k = max(1, int(picked.sum(1).max(initial=0)))
    feature = np.where(np.arange(k) < picked.sum(1)[:, None], np.argsort(~picked, 1, kind="stable")[:, :k], -1)
    u = uniform(mix(keys[:, None] ^ mix(np.maximum(feature, 0), 9), stem.seed))
    take = lambda a: np.take_along_axis(a, np.maximum(feature, 0), 1)
    low, high = take(lo), take(hi)
    cut = low + u * (high - low)
    return feature, np.where(cut >= high, low, cut)


def best_drawn(stem: Stem, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, total: np.ndarray) -> list:
    """The best of the drawn cuts; ``left`` [nodes, k, sums]."""
    right = total[:, None] - left
    fits = (feature >= 0) & (count(stem, left) >= stem.min_leaf) & (count(stem, right) >= stem.min_leaf)
    gain = np.where(fits, purity(stem, left) + purity(stem, right), -np.inf)
    top = gain.max(1, keepdims=True)
    at = (gain >= top - NOTHING * np.abs(top)).argmax(1)
    return [(int(feature[i, j]), float(cut[i, j]), left[i, j], right[i, j]) if np.isfinite(top[i, 0]) else None for i, j in enumerate(at)]


def ranges(x: np.ndarray, slot: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of every feature in every slot."""
    lo, hi = np.full((size, x.shape[1]), np.inf), np.full((size, x.shape[1]), -np.inf)
    order = np.argsort(slot, kind="stable")
    begin = np.flatnonzero(np.diff(slot[order], prepend=-1))
    if len(begin):
        here = slot[order][begin]
        lo[here], hi[here] = np.minimum.reduceat(x[order], begin), np.maximum.reduceat(x[order], begin)
    return lo, hi


def histogram(stem: Stem, bins: Bins, codes: np.ndarray, y: np.ndarray, w: np.ndarray, slot: np.ndarray, size: int) -> np.ndarray:
    total = int(bins.starts[-1])
    out = np.zeros((size * total, width(stem, bins)))
    step = max(1, SLICE_CELLS // max(1, codes.shape[1]))
    for a in range(0, len(codes), step):
        place = (slot[a : a + step, None] * total + codes[a : a + step]).ravel()
        out += sums(stem, bins, place, size * total, y[a : a + step], w[a : a + step], codes.shape[1])
    return out.reshape(size, total, -1)


def left_sums(stem: Stem, bins: Bins, x, y, w, slot, feature, cut) -> np.ndarray:
    size, k = feature.shape
    out = np.zeros((size, k, width(stem, bins)))
    rows = np.arange(len(x))
    for j in range(k):
        f = feature[slot, j]
        go = (f >= 0) & (x[rows, f] <= cut[slot, j])
        out[:, j] = sums(stem, bins, slot[go], size, y[go], w[go])
    return out


def grow(stem: Stem, bins: Bins, x: np.ndarray, codes: np.ndarray | None, y: np.ndarray, w: np.ndarray, depth: int, key: int) -> Tree:
    """The whole tree below a node whose rows are all here."""
    tree = Tree()
    seen = w > 0
    x, codes, y, w = x[seen], None if codes is None else codes[seen], y[seen], w[seen]
    if stem.criterion == "absolute_error" and not stem.rate and not stem.classify:
        bins = replace(bins, marks=np.unique(y)[:-1])
    total = sums(stem, bins, np.zeros(len(y), np.int64), 1, y, w)
    tree.add(depth, key, float(count(stem, total)[0]), leaf(stem, total)[0])
    active = [0] if open_nodes(stem, np.array([depth]), total)[0] else []
    node = np.zeros(len(y), np.int64)
    whole = {0: total[0]}
    while active:
        slot_of = np.full(len(tree.feature), -1)
        slot_of[active] = np.arange(len(active))
        rows = np.flatnonzero(slot_of[node] >= 0)
        slot, keys = slot_of[node[rows]], np.array([tree.key[i] for i in active], np.uint64)
        found: list = []
        if stem.random:
            feature, cut = draw_cuts(stem, bins, keys, *ranges(x[rows], slot, len(active)))
            left = left_sums(stem, bins, x[rows], y[rows], w[rows], slot, feature, cut)
            found = best_drawn(stem, feature, cut, left, np.array([whole[i] for i in active]))
        else:
            step = max(1, HIST_BYTES // (8 * int(bins.starts[-1]) * width(stem, bins)))
            if width(stem, bins) > 64:
                step = 1  # a node has few of the target's values: it counts by its own
            for a in range(0, len(active), step):
                mine = rows[(slot >= a) & (slot < a + step)]
                part = bins if step > 1 or bins.marks is None else replace(bins, marks=np.unique(y[mine])[:-1])
                hist = histogram(stem, part, codes[mine], y[mine], w[mine], slot_of[node[mine]] - a, min(step, len(active) - a))
                found += best_cut(stem, part, keys[a : a + step], hist)
        following = []
        for i, split in zip(active, found):
            if split is None:
                continue
            f, threshold, *sides = split
            sides = np.array(sides)
            first = tree.split(i, f, threshold, list(zip(count(stem, sides).tolist(), leaf(stem, sides))))
            may = open_nodes(stem, np.full(2, tree.depth[first]), sides)
            for s in range(2):
                if may[s]:
                    following.append(first + s)
                    whole[first + s] = sides[s]
        feature, threshold, left = np.array(tree.feature), np.array(tree.threshold), np.array(tree.left)
        at = node[rows]
        go = left[at] >= 0
        rows, at = rows[go], at[go]
        node[rows] = left[at] + (x[rows, feature[at]] > threshold[at])
        active = following
    return tree


# --- boosting ---------------------------------------------------------------------------------------------------

def starting_scores(stem: Stem, y_sums: np.ndarray) -> np.ndarray:
    """``y_sums``: rows per class, or (rows, sum)."""
    if not stem.classify:
        return np.array([y_sums[1] / max(y_sums[0], 1)])
    share = np.maximum(y_sums / max(y_sums.sum(), 1), 1e-12)
    return np.log(share) if stem.scores > 1 else np.array([np.log(share[1] / share[0])])


def probabilities(scores: np.ndarray) -> np.ndarray:
    if scores.shape[1] == 1:
        p = 1 / (1 + np.exp(-scores))
        return np.concatenate([1 - p, p], 1)
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def residuals(stem: Stem, scores: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """Residual and curvature [rows, 2] of the one softmax (or squared) objective for score ``k``."""
    if not stem.classify:
        return np.stack([y - scores[:, 0], np.ones(len(y))], 1)
    p = probabilities(scores)[:, k if stem.scores > 1 else 1]
    return np.stack([(y == (k if stem.scores > 1 else 1)) - p, p * (1 - p)], 1)


def loss(stem: Stem, scores: np.ndarray, y: np.ndarray, w: np.ndarray | float = 1.0) -> float:
    """Sum over rows, each ``w`` times."""
    if not stem.classify:
        return float((w * (y - scores[:, 0]) ** 2).sum())
    return float(-(w * np.log(np.maximum(probabilities(scores)[np.arange(len(y)), y.astype(int)], 1e-300))).sum())


def add_scores(stem: Stem, arrays: list, x: np.ndarray, scores: np.ndarray) -> np.ndarray:
    for i, a in enumerate(arrays):
        scores[:, i % stem.scores] += stem.rate * a[5][reach(a, x), 0]
    return scores


def stalled(stem: Stem, losses: list[float]) -> bool:
    """No round of the last ``patience`` was better than all before by 1e-4."""
    return bool(stem.patience) and len(losses) > stem.patience and min(losses[-stem.patience :]) > min(losses[: -stem.patience]) - 1e-4


def boost(stem: Stem, bins: Bins, x, codes, y, keys) -> tuple[np.ndarray, list[Tree]]:
    """All rounds where all rows are here."""
    held = validation_rows(keys) if stem.patience else np.zeros(len(y), bool)
    own = ~held
    start = starting_scores(stem, np.bincount(y[own].astype(int), minlength=stem.n_classes) if stem.classify else np.array([own.sum(), y[own].sum()]))
    scores, trees, losses = np.tile(start, (len(y), 1)), [], []
    for t in range(stem.n_trees):
        new = []
        for k in range(stem.scores):
            number = t * stem.scores + k
            w = row_weights(stem, number, keys) * own
            new.append(grow(stem, bins, x, codes, residuals(stem, scores, y, k), w, 0, int(mix(number, stem.seed))))
        scores = add_scores(stem, [n.arrays() for n in new], x, scores)
        trees += new
        if held.any():
            losses.append(loss(stem, scores[held], y[held]) / held.sum())
            if stalled(stem, losses):
                break
    return start, trees
