"""Tree models: stems of a grid, their growth over the rows, and scorers that read them.

``fit`` grows all stems together. Small tables go whole to the stems' tasks;
large ones are passed over level by level (see ``grower``), every pass for all
stems, folds and trees. Fitted trees are scorers like the linear ones, so one
pass scores a whole grid.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablewright.operators import grower as g
from tablewright.operators.design import TEST
from tablewright.operators.grower import DEEPEST, Bins, Fill, Stem, Tree
from tablewright.operators.scoring import KEYS, TIMES
from tablewright.session import map_arrow, materialize

TREES = ("DecisionTree", "RandomForest", "ExtraTrees", "GradientBoosting")
PASS_BYTES = 256 << 20  # histograms of a task
SHARE = 2048  # equal rows that are one row of a pass at most, about
MOST_EQUAL = 64
ONCE = 32  # draws of trees kept per row behind the groups, at most
DRAWN = "__drawn"
REFRESH = 3  # boosting rounds after which the rows' scores are kept
PATIENCE = 5  # boosting rounds without gain
SHARED = ("max_depth", "min_samples_split", "n_estimators")  # applied when trees are read


def stem_of(model: str, p: dict[str, Any], classify: bool, n_classes: int, subset: int, n_features: int) -> Stem:
    """The stem a grid point needs by itself."""
    depth = DEEPEST if p.get("max_depth") is None else int(p["max_depth"])
    split, rows = int(p.get("min_samples_split", 2)), int(p.get("min_samples_leaf", 1))
    base = Stem(classify, n_classes if classify else 1, subset, max_depth=depth, min_split=split, min_leaf=rows)
    some = {"sqrt": max(1, int(np.sqrt(n_features))), "log2": max(1, int(np.log2(max(2, n_features)))), None: None}
    if model == "DecisionTree":
        kind = p.get("criterion", "gini" if classify else "squared_error")
        return replace(base, criterion="squared_error" if kind == "friedman_mse" else kind)
    if model == "GradientBoosting":
        return replace(base, criterion="squared_error", n_trees=int(p["n_estimators"]), rate=float(p["learning_rate"]),
                       subsample=float(p.get("subsample", 1.0)), patience=PATIENCE)
    base = replace(base, n_trees=int(p["n_estimators"]), criterion="gini" if classify else "squared_error")
    if model == "ExtraTrees":
        return replace(base, random=True, max_features=some["sqrt"] if classify else None)
    if model == "RandomForest":
        return replace(base, bootstrap=True, max_features=some[p.get("max_features")])
    raise ValueError(f"unknown tree model {model}")


def joint_stems(stems: Sequence[Stem]) -> tuple[list[Stem], list[int]]:
    """Stems that serve several points, and which one serves each.

    Depth and least rows of a split only stop a tree earlier, and a smaller forest
    is the beginning of a larger one. Boosting shares the number of rounds alone.
    """
    joint: dict[tuple, Stem] = {}
    which = []
    for s in stems:
        open_ = replace(s, n_trees=0) if s.rate else replace(s, n_trees=0, max_depth=0, min_split=0)
        old = joint.get(open_)
        joint[open_] = s if old is None else replace(
            s, n_trees=max(s.n_trees, old.n_trees), max_depth=max(s.max_depth, old.max_depth), min_split=min(s.min_split, old.min_split))
        which.append(open_)
    names = list(joint)
    return [joint[n] for n in names], [names.index(w) for w in which]


@dataclass
class Forest:
    """The trees of a stem, in order; ``start``: scores that boosting begins with."""

    stem: Stem
    fill: Fill
    trees: list[tuple]
    start: np.ndarray | None = None


@dataclass
class TreeScorer:
    """A forest as a grid point reads it."""

    forest: Forest
    enc: Any
    max_depth: int
    min_split: int
    n_trees: int

    def predict(self, batch) -> np.ndarray:
        out = [self._slice(part) for part in g.slices(batch, self.enc.width)]
        return np.concatenate(out) if out else np.zeros(0)

    def _slice(self, batch) -> np.ndarray:
        f, x = self.forest, g.matrix(self.enc, batch, self.forest.fill)
        trees = f.trees[: self.n_trees * f.stem.scores if f.stem.rate else self.n_trees]
        if f.stem.rate:
            scores = g.add_scores(f.stem, trees, x, np.tile(f.start, (batch.n, 1)))
            return g.probabilities(scores).argmax(1).astype(float) if f.stem.classify else scores[:, 0]
        total = sum(t[5][g.reach(t, x, self.max_depth, self.min_split)].astype(float) for t in trees)
        return total.argmax(1).astype(float) if f.stem.classify else total[:, 0] / len(trees)


def compact(tree: Tree) -> tuple:
    feature, threshold, left, depth, n, value = tree.arrays()
    return feature, threshold, left, depth.astype(np.int16), n.astype(np.float32), value.astype(np.float32) if value.shape[1] > 1 else value


# --- equal rows ---------------------------------------------------------------------------------------------

def draws(stems: Sequence[Stem]) -> bool:
    """Whether trees see rows by their hashes: in bootstraps, in shares of the rows, in those held out."""
    return any(s.bootstrap or s.subsample < 1 or s.rate for s in stems)


def equal_rows(rows: DataFrame, keys: Sequence[str], drawn: bool = True) -> DataFrame:
    """Encoded rows that differ in nothing but their keys as one row with ``KEYS``, the hashes that trees draw them by.

    A group of more than ``SHARE`` rows is dealt out in shares of about that size.
    Where no tree draws rows, a group is one row with ``TIMES``, added up before the shuffle.
    """
    spark = rows.sparkSession
    values = [c for c in ("fold", "y", "num", "cat", "indices", "values") if c in rows.columns]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    if not drawn:
        return rows.where(F.col("fold") != TEST).groupBy(*values).agg(F.count(F.lit(1)).alias(TIMES)).repartition(parts)
    names = list(keys) or [c for c in rows.columns if c != "fold"]
    h = F.xxhash64(*values)
    own = rows.where(F.col("fold") != TEST).select(*values, F.xxhash64(*names).alias("key"), h.alias("h"))
    large = own.groupBy("h").count().where(F.col("count") > SHARE)
    dealt = own.join(F.broadcast(large), "h", "left").withColumn(
        "share", F.when(F.col("count").isNull(), 0).otherwise(F.pmod("key", F.ceil(F.col("count") / SHARE))))
    by = [*values, "share"]
    return dealt.repartition(parts, *by).groupBy(*by).agg(F.collect_list("key").alias(KEYS)).drop("share")


def draw_once(groups: DataFrame, stems: Sequence[Stem]) -> DataFrame:
    """Groups with how often each tree of the bootstraps sees them (``DRAWN``) and ``TIMES`` in place of their rows' hashes.

    Passes then cost by groups, not by rows. Draws depend on seed and tree alone, so stems share them.
    """
    which = drawn_trees(stems)
    names = [c for c in groups.columns if c != KEYS]
    kinds = {f.name: f.dataType.simpleString() for f in groups.schema}

    def run(it):
        for rb in it:
            if not rb.num_rows:
                continue
            behind = Keys(rb)
            w = np.stack([behind.weights(s, t) for s, t in which], 1).astype(np.uint16)
            at = pa.array(np.arange(0, w.size * 2 + 1, w.shape[1] * 2, dtype=np.int32))
            blob = pa.Array.from_buffers(pa.binary(), len(w), [None, at.buffers()[1], pa.py_buffer(w.tobytes())])
            yield pa.RecordBatch.from_arrays([*(rb.column(c) for c in names), pa.array(behind.counts.astype(np.int64)), blob], [*names, TIMES, DRAWN])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in names), f"{TIMES} long", f"{DRAWN} binary"])
    return map_arrow(groups, run, schema)


def drawn_trees(stems: Sequence[Stem]) -> list[tuple[Stem, int]]:
    """The different draws of bootstraps, in order: a stem that has it and the tree."""
    seen: dict[tuple, tuple[Stem, int]] = {}
    for s in stems:
        for t in range(s.n_trees if s.bootstrap else 0):
            seen.setdefault((s.seed, t), (s, t))
    return list(seen.values())


class Keys:
    """The hashes of the rows behind each row of a batch, or what was made of them, and how often trees see them."""

    def __init__(self, rb: pa.RecordBatch, stems: Sequence[Stem] = ()):
        self._held = None
        if TIMES in rb.schema.names:
            self.counts = rb.column(TIMES).to_numpy().astype(float)
            self.made: dict = {False: self.counts}
            if DRAWN in rb.schema.names:
                which = drawn_trees(stems)
                blob = rb.column(DRAWN)
                at = np.frombuffer(blob.buffers()[1], np.int32, len(blob) + 1, blob.offset * 4)
                w = np.frombuffer(blob.buffers()[2], np.uint16, len(blob) * len(which), at[0]).reshape(len(blob), -1).T.astype(float)
                self.made |= {(s.seed, t, True, s.subsample, False): w[i] for i, (s, t) in enumerate(which)}
            return
        column = rb.column(KEYS)
        self.flat = column.flatten().to_numpy().view(np.uint64)
        at = column.offsets.to_numpy().astype(np.int64)
        self.starts, self.counts = at[:-1] - at[0], np.diff(at).astype(float)
        self.made = {}

    def held_out(self) -> np.ndarray:
        if self._held is None:
            self._held = g.validation_rows(self.flat)
        return self._held

    def add(self, weights: np.ndarray) -> np.ndarray:
        return np.add.reduceat(weights, self.starts) if len(self.starts) else np.zeros(0)

    def weights(self, stem: Stem, tree: int) -> np.ndarray:
        """How often a tree sees the rows; draws depend on the seed and the tree alone, so folds share them."""
        held = bool(stem.rate and stem.patience)
        if not stem.bootstrap and stem.subsample >= 1:
            which = held
        else:
            which = (stem.seed, tree if stem.bootstrap else tree // stem.scores, stem.bootstrap, stem.subsample, held)
        if which not in self.made:
            if which is False:
                self.made[which] = self.counts
            else:
                w = g.row_weights(stem, tree, self.flat)
                self.made[which] = self.add(w * ~self.held_out() if held else w)
        return self.made[which]


# --- whole tables -------------------------------------------------------------------------------------------

def _joined(enc, parts: list[pa.RecordBatch]):
    return enc.batch(pa.Table.from_batches(parts).combine_chunks().to_batches()[0])


def _grow_whole(rows: DataFrame, enc, stems: list[Stem], filled: dict[int, Fill], bins: dict[int, Bins]) -> list[tuple[np.ndarray | None, list[tuple]]]:
    """Every family of trees in a task that gets all rows of its subset; the size was checked."""
    units = [(i, a, min(s.n_trees, a + step)) for i, s in enumerate(stems) for step in [s.n_trees if s.rate else -(-s.n_trees // g.FAMILIES)]
             for a in range(0, s.n_trees, step)]
    shared = rows.sparkSession.sparkContext.broadcast((enc, stems, filled, bins, units))
    subset = F.array(*[F.lit(stems[i].subset) for i, _, _ in units])
    all_units = F.sequence(F.lit(0), F.lit(len(units) - 1))
    sent = rows.where(F.col("fold") != TEST).withColumn("unit", F.explode(F.filter(all_units, lambda u: F.get(subset, u) != F.col("fold"))))

    def run(it):
        enc, stems, filled, bins, units = shared.value

        def done(unit, parts):
            i, a, b = units[unit]
            stem, batch = stems[i], _joined(enc, parts)
            keys = np.concatenate([p.column("key").to_numpy() for p in parts]).view(np.uint64)
            x, own = g.matrix(enc, batch, filled[stem.subset]), bins[stem.subset]
            codes = None if stem.random else own.codes(x)
            if stem.rate:
                start, trees = g.boost(stem, own, x, codes, batch.y, keys)
            else:
                start, trees = None, [g.grow(stem, own, x, codes, batch.y, g.row_weights(stem, t, keys), 0, int(g.mix(t, stem.seed))) for t in range(a, b)]
            blob = pickle.dumps((start, [compact(t) for t in trees]))
            return pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([a], pa.int32()), pa.array([blob], pa.binary())], ["stem", "first", "blob"])

        unit, parts = None, []
        for rb in it:
            u = rb.column("unit").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(u)) + 1).tolist(), len(u)]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                if parts and u[a] != unit:
                    yield done(unit, parts)
                    parts = []
                unit = int(u[a])
                parts.append(rb.slice(a, b - a))
        if parts:
            yield done(unit, parts)

    dealt = sent.repartition(min(len(units), 256), "unit").sortWithinPartitions("unit", "key")
    out: list[tuple[np.ndarray | None, list[tuple]]] = [(None, []) for _ in stems]
    for r in sorted(map_arrow(dealt, run, "stem int, first int, blob binary").collect(), key=lambda r: (r["stem"], r["first"])):
        start, trees = pickle.loads(r["blob"])
        out[r["stem"]] = (start, out[r["stem"]][1] + trees)
    shared.unpersist()
    return out


# --- level by level --------------------------------------------------------------------------------------------

@dataclass
class Growing:
    """A tree that is not finished: ``open`` nodes wait for a split, ``fresh`` ones come from the last, ``small`` ones wait for a task of their own."""

    stem: int
    number: int
    tree: Tree
    open: list[int]
    fresh: list[int] = field(default_factory=list)
    small: list[int] = field(default_factory=list)
    below: list[tuple[int, tuple]] = field(default_factory=list)  # finished trees of small nodes, as arrays

    def compact(self) -> tuple:
        return g.grafted(compact(self.tree), self.below)


class Levels:
    """Passes over groups of equal rows (see ``equal_rows``) that take trees a level further."""

    def __init__(self, rows: DataFrame, enc, stems: list[Stem], filled: dict[int, Fill], bins: dict[int, Bins]):
        self.rows, self.enc, self.stems, self.filled, self.bins = rows, enc, stems, filled, bins
        self.spark = rows.sparkSession
        self.done: list[list[tuple]] = [[] for _ in stems]
        self.start: list[np.ndarray | None] = [None] * len(stems)
        self.kept: list[DataFrame] = []  # the rows with the scores of the first rounds
        self.rounds = 0  # that these scores hold
        self.parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _each(self, growing: list[Growing], work, finish, nodes: str):
        """Rows of a pass: ``work(tree number, growing tree, x, y, w, slot of each row)`` for all rows in its nodes."""
        trees = [t.tree.arrays() for t in growing]
        keys = [np.array([t.tree.key[i] for i in getattr(t, nodes)], np.uint64) for t in growing]
        shared = self.spark.sparkContext.broadcast((self.enc, self.stems, self.filled, self.bins, growing, trees, keys, *self._scoring()))
        scores_of = self._scores

        def run(it):
            enc, stems, filled, bins, growing, trees, keys, scoring = shared.value[0], *shared.value[1:7], shared.value[7:]
            held: dict = {}
            for rb in it:
                if not rb.num_rows:
                    continue
                step = max(1, g.SLICE_CELLS // max(1, enc.width))
                for a in range(0, rb.num_rows, step):
                    part = rb.slice(a, step)
                    every, behind = enc.batch(part), Keys(part, stems)
                    for t in sorted({stems[x.stem].subset for x in growing}):
                        mine = every.fold != t
                        if not mine.any():
                            continue
                        batch = every.pick(mine)
                        x = g.matrix(enc, batch, filled[t])
                        scores: dict[int, np.ndarray] = {}
                        codes = None
                        for i, own in enumerate(growing):
                            stem = stems[own.stem]
                            if stem.subset != t:
                                continue
                            y, w = batch.y, behind.weights(stem, own.number)[mine]
                            if stem.rate:
                                if own.stem not in scores:
                                    scores[own.stem] = scores_of(stems, scoring, own.stem, x, part, mine)
                                    if stem.patience:
                                        out = behind.add(behind.held_out().astype(float))[mine]
                                        some = out > 0
                                        if some.any():
                                            lost = held.setdefault(("loss", own.stem), np.zeros(2))
                                            lost += [g.loss(stem, scores[own.stem][some], y[some], out[some]), out.sum()]
                                y = g.residuals(stem, scores[own.stem], y, own.number % stem.scores)
                            at = g.reach(trees[i], x)
                            names = getattr(own, nodes)
                            slot_of = np.full(len(trees[i][0]), -1)
                            slot_of[names] = np.arange(len(names))
                            rows = np.flatnonzero((slot_of[at] >= 0) & (w > 0))
                            if not len(rows):
                                continue
                            if codes is None and not stem.random:
                                codes = bins[t].codes(x)
                            work(held, i, own, stem, bins[t], x[rows], None if stem.random else codes[rows], y[rows], w[rows], slot_of[at[rows]], keys[i])
            out = finish(held)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.binary())],
                                                 ["tree", "node", "blob"])

        return map_arrow(self.rows, run, "tree int, node int, blob binary"), shared

    def _scoring(self) -> tuple:
        """(trees since the scores were kept, what boosting starts from, whether scores are kept)."""
        recent = [d[self.rounds * s.scores :] if s.rate else [] for s, d in zip(self.stems, self.done)]
        return recent, self.start, self.rounds > 0

    @staticmethod
    def _scores(stems: list[Stem], scoring: tuple, i: int, x: np.ndarray, part: pa.RecordBatch, mine: np.ndarray) -> np.ndarray:
        """Scores of stem ``i`` for the picked rows of a batch; ``scores`` holds those of all boosting stems side by side."""
        recent, start, kept = scoring
        stem = stems[i]
        if not kept:
            begun = np.tile(start[i], (len(x), 1))
        else:
            width = [s.scores if s.rate else 0 for s in stems]
            at, column = sum(width[:i]), part.column("scores")
            begun = column.flatten().to_numpy().reshape(part.num_rows, sum(width))[mine, at : at + width[i]]
        return g.add_scores(stem, recent[i], x, begun.copy())

    def keep_scores(self, rounds: int) -> None:
        """Rows take their scores after ``rounds`` rounds along, so that later passes read the newer trees only."""
        shared = self.spark.sparkContext.broadcast((self.enc, self.stems, self.filled, *self._scoring()))
        scores_of, names = self._scores, [c for c in self.rows.columns if c != "scores"]
        kinds = {f.name: f.dataType.simpleString() for f in self.rows.schema}

        def run(it):
            enc, stems, filled, scoring = shared.value[0], *shared.value[1:3], shared.value[3:]
            width = [s.scores if s.rate else 0 for s in stems]
            for rb in it:
                if not rb.num_rows:
                    continue
                every, out = enc.batch(rb), np.zeros((rb.num_rows, sum(width)))
                for t in sorted({s.subset for s in stems if s.rate}):
                    mine = every.fold != t
                    if mine.any():
                        x = g.matrix(enc, every.pick(mine), filled[t])
                        for i, s in enumerate(stems):
                            if s.rate and s.subset == t:
                                out[mine, sum(width[:i]) : sum(width[: i + 1])] = scores_of(stems, scoring, i, x, rb, mine)
                at = pa.array(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*(rb.column(c) for c in names), pa.ListArray.from_arrays(at, pa.array(out.ravel()))], [*names, "scores"])

        schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in names), "scores array<double>"])
        self.rows, self.rounds = map_arrow(self.rows, run, schema).persist(), rounds
        self.rows.count()
        self.kept.append(self.rows)
        if len(self.kept) > 1:
            self.kept.pop(0).unpersist()

    def close(self) -> None:
        for k in self.kept:
            k.unpersist()

    def _meeting(self, partial: DataFrame, shared, meet):
        """All parts of a (tree, node) in one place: ``meet(growing tree, stem, bins, node, blobs)``, one result each."""

        def run(it):
            _, stems, _, bins, growing = shared.value[:5]
            key, blobs = None, []

            def done():
                tree, node = key
                if tree < 0:
                    result = sum(np.frombuffer(b, float) for b in blobs)
                else:
                    stem = stems[growing[tree].stem]
                    result = meet(growing[tree], stem, bins[stem.subset], node, blobs)
                return pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([node], pa.int32()), pa.array([pickle.dumps(result)], pa.binary())], ["tree", "node", "blob"])

            for rb in it:
                for k, blob in zip(zip(rb.column("tree").to_pylist(), rb.column("node").to_pylist()), rb.column("blob").to_pylist()):
                    if key is not None and k != key:
                        yield done()
                        blobs = []
                    key = k
                    blobs.append(blob)
            if key is not None:
                yield done()

        dealt = partial.repartition(self.parts, "tree", "node").sortWithinPartitions("tree", "node")
        return map_arrow(dealt, run, "tree int, node int, blob binary"), shared

    def _met(self, partial: DataFrame, shared, meet) -> list[tuple[int, int, Any]]:
        """What the driver needs of every open node, at once."""
        met, shared = self._meeting(partial, shared, meet)
        found = met.collect()
        shared.unpersist()
        return [(r["tree"], r["node"], pickle.loads(r["blob"])) for r in found]

    @staticmethod
    def _add(held, key, value):
        held[key] = held[key] + value if key in held else value

    @staticmethod
    def _rows(held):
        """(tree, node, packed sums) of a task; losses go under negative numbers."""
        out = []
        for key, value in held.items():
            if key[0] == "loss":
                out.append((-1 - key[1], 0, value.tobytes()))
            else:
                i, names = key
                out += [(i, n, v.tobytes()) for n, v in zip(names, value) if np.any(v)]
        return out

    def split(self, growing: list[Growing]) -> dict[int, np.ndarray]:
        """Splits the open nodes of all trees; gives the losses of boosting stems. In rounds, as far as memory goes."""
        losses: dict[int, np.ndarray] = {}
        todo = [(t, n) for t in growing for n in t.open]
        size = {i: 8 * g.width(s, self.bins[s.subset]) * (len(self.bins[s.subset].cuts) if s.random else int(self.bins[s.subset].starts[-1])) for i, s in enumerate(self.stems)}
        while todo:
            room, taken = PASS_BYTES, []
            while todo and (not taken or room >= size[todo[0][0].stem]):
                room -= size[todo[0][0].stem]
                taken.append(todo.pop(0))
            part: dict[int, Growing] = {}
            for t, n in taken:
                part.setdefault(id(t), replace(t, open=[])).open.append(n)  # shares the tree and the list of fresh nodes
            for kind in (True, False):
                own = [p for p in part.values() if self.stems[p.stem].random == kind]
                if own:
                    losses.update(self._drawn(own) if kind else self._cut(own))
        return losses

    def _take(self, growing: list[Growing], found) -> dict[int, np.ndarray]:
        losses = {}
        for tree, node, result in found:
            if tree < 0:
                losses[-1 - tree] = result
                continue
            t, (n, value, split) = growing[tree].tree, result
            t.n[node], t.value[node] = n, value
            if split is not None:
                feature, threshold, sides, may = split
                first = t.split(node, feature, threshold, sides)
                for s in range(2):
                    if may[s]:
                        growing[tree].fresh.append(first + s)
        return losses

    @staticmethod
    def _decided(stem: Stem, depth: int, total: np.ndarray, split):
        """What the driver needs of a node: rows, value and, if it is split, its sides."""
        own = float(g.count(stem, total)), g.leaf(stem, total)
        if split is None or not g.open_nodes(stem, np.array([depth]), total[None])[0]:
            return *own, None
        feature, threshold, *sides = split
        sides = np.array(sides)
        return *own, (feature, threshold, list(zip(g.count(stem, sides).tolist(), g.leaf(stem, sides))), g.open_nodes(stem, np.full(2, depth + 1), sides).tolist())

    def _cut(self, growing: list[Growing]) -> dict[int, np.ndarray]:
        add, decided = self._add, self._decided

        def work(held, i, own, stem, bins, x, codes, y, w, slot, keys):
            add(held, (i, tuple(own.open)), g.histogram(stem, bins, codes, y, w, slot, len(own.open)))

        def meet(own, stem, bins, node, blobs):
            hist = sum(np.frombuffer(b, float) for b in blobs).reshape(1, int(bins.starts[-1]), -1)
            total = hist[0, : bins.starts[1]].sum(0)
            return decided(stem, own.tree.depth[node], total, g.best_cut(stem, bins, np.array([own.tree.key[node]], np.uint64), hist)[0])

        return self._take(growing, self._met(*self._each(growing, work, self._rows, "open"), meet))

    def _drawn(self, growing: list[Growing]) -> dict[int, np.ndarray]:
        """Two passes: the nodes' ranges give their cut points, then those are measured."""
        add, rows_of, decided = self._add, self._rows, self._decided

        def spans(held, i, own, stem, bins, x, codes, y, w, slot, keys):
            lo, hi = g.ranges(x, slot, len(own.open))
            key = (i, tuple(own.open))
            old = held.get(key)
            new = np.stack([-lo, hi], 1)
            held[key] = new if old is None else np.maximum(old, new)

        def draw(own, stem, bins, node, blobs):
            both = np.max([np.frombuffer(b, float).reshape(2, -1) for b in blobs], 0)
            return g.draw_cuts(stem, bins, np.array([own.tree.key[node]], np.uint64), -both[:1], both[1:])

        cuts: list[dict[int, tuple]] = [{} for _ in growing]
        for tree, node, result in self._met(*self._each(growing, spans, rows_of, "open"), draw):
            cuts[tree][node] = result

        def measure(held, i, own, stem, bins, x, codes, y, w, slot, keys):
            k = max(cuts[i][n][0].shape[1] for n in own.open)
            pad = lambda a, fill: np.concatenate([a, np.full((1, k - a.shape[1]), fill)], 1)
            feature, cut = (np.concatenate([pad(cuts[i][n][j], f) for n in own.open]) for j, f in ((0, -1), (1, 0.0)))
            left = g.left_sums(stem, bins, x, y, w, slot, feature, cut)
            total = g.sums(stem, bins, slot, len(own.open), y, w)
            add(held, (i, tuple(own.open)), np.concatenate([total[:, None], left], 1))

        def meet(own, stem, bins, node, blobs):
            s = sum(np.frombuffer(b, float) for b in blobs).reshape(-1, g.width(stem, bins))
            feature, cut = cuts[next(i for i, o in enumerate(growing) if o.stem == own.stem and o.number == own.number)][node]
            split = g.best_drawn(stem, feature, cut, s[None, 1 : 1 + feature.shape[1]], s[:1])[0]
            return decided(stem, own.tree.depth[node], s[0], split)

        return self._take(growing, self._met(*self._each(growing, measure, rows_of, "open"), meet))

    def finish(self, growing: list[Growing]) -> None:
        """All below the small nodes, each in one task."""
        names = [t for t in growing if t.small]
        if not names:
            return

        def work(held, i, own, stem, bins, x, codes, y, w, slot, keys):
            order = np.argsort(slot, kind="stable")
            edges = np.searchsorted(slot[order], np.arange(len(own.small) + 1))
            for s, node in enumerate(own.small):
                mine = order[edges[s] : edges[s + 1]]
                if len(mine):
                    held.setdefault((i, node), []).append((x[mine], y[mine], w[mine]))

        def finish(held):
            return [(*key, pickle.dumps(tuple(np.concatenate(p) for p in zip(*parts)))) for key, parts in held.items()]

        def meet(own, stem, bins, node, blobs):
            x, y, w = (np.concatenate(p) for p in zip(*map(pickle.loads, blobs)))
            order = np.lexsort((w, y, *x.T))  # the same sums in any order of arrival
            x, y, w = x[order], y[order], w[order]
            return compact(g.grow(stem, bins, x, None if stem.random else bins.codes(x), y, w, own.tree.depth[node], own.tree.key[node]))

        met, shared = self._meeting(*self._each(names, work, finish, "small"), meet)
        # a part at a time: most nodes of a deep tree come this way
        for r in materialize(met.select("tree", "node", "blob"), "subtrees").toLocalIterator():
            names[r["tree"]].below.append((r["node"], pickle.loads(r["blob"])))
        shared.unpersist()

    def grow(self, growing: list[Growing], local_rows: float) -> None:
        """All levels of trees that begin with their roots."""
        while any(t.open for t in growing):
            self.split([t for t in growing if t.open])
            for t in growing:
                t.open = [n for n in t.fresh if t.tree.n[n] > local_rows]
                t.small += [n for n in t.fresh if t.tree.n[n] <= local_rows]
                t.fresh.clear()
        self.finish(growing)

    def tally(self, stems: list[int]) -> None:
        """What boosting starts from."""
        enc, all_stems = self.enc, self.stems

        def run(it):
            held = {i: np.zeros(max(2, all_stems[i].n_classes)) for i in stems}
            for rb in it:
                if not rb.num_rows:
                    continue
                b, behind = enc.batch(rb), Keys(rb)
                kept = {True: behind.add((~behind.held_out()).astype(float)), False: behind.counts}
                for i in stems:
                    s = all_stems[i]
                    w = kept[s.patience > 0] * (b.fold != s.subset)
                    held[i] += np.bincount(b.y.astype(int), w, len(held[i])) if s.classify else np.array([w.sum(), w @ b.y])
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], ["stem", "blob"])

        total: dict[int, np.ndarray] = {}
        for r in map_arrow(self.rows, run, "stem int, blob binary").collect():
            total[r["stem"]] = total.get(r["stem"], 0) + np.frombuffer(r["blob"], float)
        for i in stems:
            self.start[i] = g.starting_scores(all_stems[i], total[i])


def _grow_levels(rows: DataFrame, enc, stems: list[Stem], filled: dict[int, Fill], bins: dict[int, Bins], local_rows: float) -> list[tuple[np.ndarray | None, list[tuple]]]:
    levels = Levels(rows, enc, stems, filled, bins)
    try:
        return _grown(levels, stems, local_rows)
    finally:
        levels.close()


def _grown(levels: Levels, stems: list[Stem], local_rows: float) -> list[tuple[np.ndarray | None, list[tuple]]]:
    def begun(i: int, number: int) -> Growing:
        return Growing(i, number, g.root(stems[i], number), [0])

    plain = [begun(i, t) for i, s in enumerate(stems) if not s.rate for t in range(s.n_trees)]
    levels.grow(plain, local_rows)
    for t in plain:
        levels.done[t.stem].append(t.compact())
    boosted = [i for i, s in enumerate(stems) if s.rate]
    if boosted:
        levels.tally(boosted)
    losses: dict[int, list[float]] = {i: [] for i in boosted}
    for r in range(max((stems[i].n_trees for i in boosted), default=0)):
        boosted = [i for i in boosted if r < stems[i].n_trees]
        growing = [begun(i, r * stems[i].scores + k) for i in boosted for k in range(stems[i].scores)]
        first = True
        while any(t.open for t in growing):
            lost = levels.split([t for t in growing if t.open])
            if first and r:
                for i, (total, n) in lost.items():
                    losses[i].append(total / max(n, 1))
                stopped = {i for i in boosted if g.stalled(stems[i], losses[i])}
                boosted = [i for i in boosted if i not in stopped]
                growing = [t for t in growing if t.stem not in stopped]
            first = False
            for t in growing:
                t.open = list(t.fresh)
                t.fresh.clear()
        for t in growing:
            levels.done[t.stem].append(t.compact())
        if not boosted:
            break
        if (r + 1) % REFRESH == 0:
            levels.keep_scores(r + 1)
    return list(zip(levels.start, levels.done))


def fit(rows: DataFrame, enc, moments, stems: Sequence[Stem], keys: Sequence[str] = (), local_cells: int = g.LOCAL_CELLS,
        local_rows: int = g.LOCAL_ROWS, groups: Callable[[bool], DataFrame] | None = None) -> list[Forest]:
    """Grows all stems on encoded ``rows`` (fold, y and the encoding's columns).

    ``keys`` tell rows apart where trees draw rows; without them the rows' values do.
    ``groups`` gives the groups of equal rows if they are kept already.
    """
    filled = {t: g.fills(enc, moments, t) for t in sorted({s.subset for s in stems})}
    cuts = g.cut_points(rows, enc, list(filled.values()))
    n = max(moments.n(t) for t in filled)
    small = n * len(cuts) <= local_cells
    marks = None
    if not small and any(s.criterion == "absolute_error" for s in stems):
        at = [float(p) for p in np.linspace(0, 1, g.MAX_BINS)]
        marks = np.unique(rows.where(F.col("fold") != TEST).agg(F.percentile_approx("y", at, 10_000).alias("m")).first()["m"])[:-1]
    bins = {t: Bins(cuts, filled[t].live, marks) for t in filled}
    if small:
        names = list(keys) or [c for c in rows.columns if c != "fold"]
        made = _grow_whole(rows.withColumn("key", F.xxhash64(*names)), enc, list(stems), filled, bins)
    else:
        drawn = draws(stems)
        own = equal_rows(rows, keys, drawn).persist() if groups is None else groups(drawn)
        k = own.agg(F.count("*").alias("groups"), F.sum(F.size(KEYS) if drawn else F.col(TIMES)).alias("rows")).first()
        # a task takes as many groups as it would take rows if none were equal, but for wide tables
        most = min(MOST_EQUAL, max(1.0, g.SLICE_CELLS / (g.LOCAL_ROWS * len(cuts))))
        local_rows *= min(most, max(1.0, (k["rows"] or 0) / max(1, k["groups"])))
        once = None
        if drawn and all(s.subsample >= 1 and not s.rate for s in stems) and 0 < k["groups"] * len(drawn_trees(stems)) <= ONCE * (k["rows"] or 0):
            once = draw_once(own, stems).persist()
        made = _grow_levels(own if once is None else once, enc, list(stems), filled, bins, local_rows)
        if once is not None:
            once.unpersist()
        if groups is None:
            own.unpersist()
    return [Forest(s, filled[s.subset], trees, start) for s, (start, trees) in zip(stems, made)]


def fit_points(rows: DataFrame, enc, moments, points: Sequence[tuple[str, dict[str, Any], int]], classify: bool, n_classes: int,
               keys: Sequence[str] = (), **limits) -> list[TreeScorer]:
    """Scorers of (model, parameters, subset), grown together."""
    own = [stem_of(m, p, classify, n_classes, t, int(g.fills(enc, moments, t).live.sum())) for m, p, t in points]
    stems, which = joint_stems(own)
    forests = fit(rows, enc, moments, stems, keys, **limits)
    return [TreeScorer(forests[w], enc, s.max_depth, s.min_split, s.n_trees) for s, w in zip(own, which)]
