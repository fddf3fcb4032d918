"""Additive attributions of single scores: what each input adds to the mean score of TRAIN.

Trees: Shapley values of the path-dependent game, in which an input outside the coalition follows the
rows of TRAIN down both branches. The game is a sum over leaves, and a leaf knows only the distinct
inputs on its path: whether the row meets what its path asks of each, and the share of rows that go
there. Rows with the same pattern of met conditions share the values of a leaf; below a node whose
path and subtree have far fewer patterns than a block has rows, the patterns are worked out once and
the rows look theirs up. Linear models have a closed form in native expressions.
All values of a row stay in one array; rows are never multiplied.
"""

from __future__ import annotations

import functools
import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from cauce.operators.models import Trained, positive_probability, slot_names, source_of
from cauce.sources.scratch import materialise, new_path, release, remove
from cauce.sources.tables import path_exists

#: Rows that are explained together, and bytes of trees that pass through the driver together.
BLOCK = 1 << 16
PART = 16 << 20
#: So few rows are explained by all leaves at once.
FEW = 256


@dataclass(frozen=True)
class Leaves:
    """Leaves in flat form: the conditions of leaf ``i`` are ``start[i]`` to ``start[i + 1]``.

    ``inside`` is the number of a set in ``sets`` (categories that go to the leaf) or -1 where the
    condition is ``low < x <= high``; ``share`` is the part of TRAIN that meets it on this path.
    """

    value: np.ndarray
    start: np.ndarray
    slot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    inside: np.ndarray
    share: np.ndarray
    sets: tuple[np.ndarray, ...]

    def base(self) -> float:
        """Mean score of the rows the trees were grown on, by their own counts."""
        return math.fsum(v * math.prod(self.share[a:b]) for v, a, b in zip(self.value, self.start, self.start[1:]))


@dataclass(frozen=True)
class Tree:
    """One tree in preorder: the left child of an inner node follows it, ``right`` is the place of the other.

    ``slot`` is -1 at leaves, and ``limit`` is their value there. A row goes left if its slot is at most
    ``limit``, or in the set of categories ``sets[inside]`` if ``inside`` is not -1. ``share`` is the part of
    TRAIN that goes left, ``inner`` counts the inner nodes from here down.
    """

    right: np.ndarray
    slot: np.ndarray
    limit: np.ndarray
    inside: np.ndarray
    share: np.ndarray
    inner: np.ndarray
    sets: np.ndarray

    def base(self) -> float:
        """Mean score of the rows the tree was grown on, by their own counts."""
        mean = self.limit.copy()
        for at in range(len(mean) - 1, -1, -1):
            if self.slot[at] >= 0:
                mean[at] = self.share[at] * mean[at + 1] + (1 - self.share[at]) * mean[self.right[at]]
        return float(mean[0])


def build_tree(nodes: dict[int, dict], weight: float, classes: bool) -> Tree:
    """The tree of the saved ``nodes`` by id; ``classes``: the score is the probability of class 1."""
    right, slot, limit, inside, share, sets = [], [], [], [], [], {}
    todo = [(0, None)]
    while todo:
        at, parent = todo.pop()
        if parent is not None:
            right[parent] = len(slot)
        node, leaf = nodes[at], nodes[at]["leftChild"] < 0
        right.append(0)
        if leaf:
            stats = node["impurityStats"]
            slot.append(-1)
            limit.append(weight * (stats[1] / sum(stats) if classes else node["prediction"]))
            inside.append(-1)
            share.append(1.0)
            continue
        split = node["split"]
        left, other = (nodes[node[side]]["rawCount"] for side in ("leftChild", "rightChild"))
        slot.append(split["featureIndex"])
        share.append(left / (left + other))
        if split["numCategories"] >= 0:
            kept = (split["numCategories"], tuple(int(c) for c in split["leftCategoriesOrThreshold"]))
            limit.append(0.0)
            inside.append(sets.setdefault(kept, len(sets)))
        else:
            limit.append(split["leftCategoriesOrThreshold"][0])
            inside.append(-1)
        todo += [(node["rightChild"], len(slot) - 1), (node["leftChild"], None)]
    inner = np.zeros(len(slot), np.int32)
    for at in range(len(slot) - 1, -1, -1):
        if slot[at] >= 0:
            inner[at] = 1 + inner[at + 1] + inner[right[at]]
    table = np.zeros((len(sets), max((n for n, _ in sets), default=0)), bool)
    for i, (_, left) in enumerate(sets):
        table[i, list(left)] = True
    return Tree(np.array(right, np.int32), np.array(slot, np.int32), np.array(limit), np.array(inside, np.int32), np.array(share), inner, table)


def trees(trained: Trained) -> DataFrame:
    """``tree, base, size, packed``: the trees of a boosted or bagged model, read from the form in which it is saved.

    A task packs a tree; the nodes never come to the driver, and a model that was loaded is not saved once more, which would
    take the driver another copy of its trees. Written once, to be removed by ``release``.
    """
    spark, model = SparkSession.active(), trained.model
    averaged = type(model).__name__.startswith("RandomForest")
    classes = hasattr(model, "numClasses")
    if classes and (not averaged or model.numClasses != 2):
        raise ValueError("attributions of classes are those of a forest of two classes")
    weights = None if averaged else list(model.treeWeights)
    share = 1 / model.getNumTrees
    own = trained.saved is None or not path_exists(spark, f"{trained.saved}/data")
    path = new_path(spark, "trees") if own else trained.saved
    if own:
        model.write().save(path)

    def pack(nodes: pa.Table) -> pa.Table:
        number = nodes["treeID"][0].as_py()
        tree = build_tree({row["id"]: row for batch in nodes.to_batches(10_000) for row in batch.to_pylist()},
                          share if weights is None else weights[number], classes)
        packed = pickle.dumps(tree, protocol=5)
        return pa.table({"tree": pa.array([number], pa.int32()), "base": [tree.base()], "size": [len(packed)],
                         "packed": pa.array([packed], pa.binary())})

    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", *[f"nodeData.{c}" for c in ("id", "prediction", "impurityStats", "rawCount", "leftChild", "rightChild", "split")])
    packed = materialise(nodes.repartition(model.getNumTrees, "treeID").groupBy("treeID").applyInArrow(pack, "tree int, base double, size long, packed binary"), "packed")
    if own:
        remove(spark, path)
    return packed


@functools.cache
def _places(d: int) -> tuple[np.ndarray, np.ndarray]:
    """Gauss-Legendre places and weights between 0 and 1 that are exact for products of ``d - 1`` linear factors."""
    place, weight = np.polynomial.legendre.leggauss((d + 1) // 2)
    return (place + 1) / 2, weight / 2


def pattern_values(met: np.ndarray, share: np.ndarray, value: float) -> np.ndarray:
    """Shapley values of one leaf for each pattern of met conditions (conditions x patterns, also of ``met``).

    ``value * prod(met or share)`` is the game. The mean of a condition's gain over all coalitions is the
    integral over t of its gain times the other factors, where a condition is in the coalition with
    probability t; of the polynomial in t a few places give it exactly.
    """
    t, _ = _places(len(share))
    factors, unmet = 1.0, share[:, None, None] * (1 - t)[:, None]
    for f, m in zip(unmet, met):
        factors = factors * np.where(m, t[:, None] + f, f)
    return _gains(factors, met, share, value)


def _gains(factors: np.ndarray, met: np.ndarray, share: np.ndarray, value: float) -> np.ndarray:
    t, w = _places(len(share))
    hit = (value * w * (1 - share[:, None]) / (t + (1 - t) * share[:, None])) @ factors
    return np.where(met, hit, -(value * w / (1 - t)) @ factors)


def _all_patterns(share: np.ndarray, value: float) -> np.ndarray:
    """``pattern_values`` of all patterns, that of number i having its bits."""
    t, _ = _places(len(share))
    factors, unmet = np.ones((len(t), 1)), share[:, None, None] * (1 - t)[:, None]
    for f in unmet:
        less = factors * f
        factors = np.concatenate([less, factors * t[:, None] + less], axis=1)
    return _gains(factors, _patterns(len(share)), share, value)


@functools.cache
def _patterns(d: int) -> np.ndarray:
    return _bits(np.arange(1 << d), d)


def _bits(code: np.ndarray, d: int) -> np.ndarray:
    return (code >> np.arange(d)[:, None]) & 1 == 1


def _add_leaf(out: np.ndarray, slots: Sequence[int], share: np.ndarray, value: float, code: np.ndarray) -> None:
    """Add the values of a leaf; bit j of ``code`` says whether a row meets its condition j."""
    d = len(slots)
    if not d:
        return
    if 1 << d > len(code):
        values, at = pattern_values(_bits(code, d), share, value), None
    else:
        values, at = _all_patterns(share, value), code
    for slot, one in zip(slots, values):
        out[slot] += one if at is None else one[at]


def shapley_values(x: np.ndarray, model: Leaves) -> np.ndarray:
    """Values per slot (slots x rows) of rows given as slots x rows."""
    out = np.zeros_like(x)
    for i, value in enumerate(model.value):
        a, b = model.start[i], model.start[i + 1]
        code = np.zeros(x.shape[1], np.int64)
        for j in range(a, b):
            column = x[model.slot[j]]
            kept = model.inside[j]
            ok = (column > model.low[j]) & (column <= model.high[j]) if kept < 0 else model.sets[kept][column.astype(np.int64)]
            code |= ok.astype(np.int64) << (j - a)
        _add_leaf(out, model.slot[a:b], model.share[a:b], value, code)
    return out


def tree_values(x: np.ndarray, tree: Tree) -> np.ndarray:
    """Values per slot (slots x rows) of the rows by one tree."""
    out = np.zeros_like(x)
    if x.shape[1] <= FEW:
        _add_levels(out, x, tree, np.zeros(1, np.int64), np.ones((1, len(x))), np.ones((1, *x.shape), bool))
        return out

    def left(at: int) -> np.ndarray:
        column, kept = x[tree.slot[at]], tree.inside[at]
        return column <= tree.limit[at] if kept < 0 else tree.sets[kept][column.astype(np.int64)]

    _add_below(out, tree, 0, [], [], np.zeros(x.shape[1], np.int64), left)
    return out


def _add_levels(out: np.ndarray, x: np.ndarray, tree: Tree, at: np.ndarray, share: np.ndarray, met: np.ndarray) -> None:
    """Add the values of all leaves below the nodes ``at``, level by level; ``share`` (nodes x slots) and ``met``
    (nodes x slots x rows) say what their paths ask of all slots, of those that they do not ask for all and true."""
    while len(at):
        if met.size > 1 << 23 and len(at) > 1:
            half = len(at) // 2
            _add_levels(out, x, tree, at[:half], share[:half], met[:half])
            at, share, met = at[half:], share[half:], met[half:]
            continue
        leaf = tree.slot[at] < 0
        if leaf.any():
            _add_leaves(out, share[leaf], met[leaf], tree.limit[at[leaf]])
            at, share, met = at[~leaf], share[~leaf], met[~leaf]
        slot, every = tree.slot[at], np.arange(len(at))
        goes = x[slot] <= tree.limit[at][:, None]
        for i in np.flatnonzero(tree.inside[at] >= 0):
            goes[i] = tree.sets[tree.inside[at[i]]][x[slot[i]].astype(np.int64)]
        part = tree.share[at]
        share, met = np.concatenate([share, share]), np.concatenate([met, met])
        share[every, slot] *= part
        share[every + len(at), slot] *= 1 - part
        met[every, slot] &= goes
        met[every + len(at), slot] &= ~goes
        at = np.concatenate([at + 1, tree.right[at]])


def _add_leaves(out: np.ndarray, share: np.ndarray, met: np.ndarray, value: np.ndarray) -> None:
    """``pattern_values`` of all the leaves (leaves x slots, leaves x slots x rows), added up."""
    t, w = _places(max(1, int((share < 1).sum(axis=1).max())))
    factors = np.repeat(value[:, None, None] * w, met.shape[2], axis=1)
    for j in np.flatnonzero((share < 1).any(axis=0)):
        s = share[:, j, None]
        factors *= np.where(met[:, j, :, None], (t + (1 - t) * s)[:, None], ((1 - t) * s)[:, None])
    missed = -(factors @ (1 / (1 - t)))
    for j in np.flatnonzero((share < 1).any(axis=0)):
        s = share[:, j, None]
        hit = np.einsum("lnq,lq->ln", factors, (1 - s) / (t + (1 - t) * s))
        out[j] += np.where(met[:, j], hit, missed).sum(axis=0)


def _add_below(out: np.ndarray, tree: Tree, at: int, slots: list[int], share: list[float], code: np.ndarray,
               left: Callable[[int], np.ndarray]) -> None:
    """Add the values of all leaves below ``at``; bit j of ``code``: does a row meet what the path asks of ``slots[j]``?"""
    d, k = len(slots), int(tree.inner[at])
    if not k:
        _add_leaf(out, slots, np.array(share), tree.limit[at], code)
        return
    if 4 << (d + k) <= len(code):
        end = at + 2 * k + 1
        inner = [i for i in range(at, end) if tree.slot[i] >= 0]
        for j, i in enumerate(inner, d):
            code = code | (left(i).astype(np.int64) << j)
        every = np.arange(1 << (d + k))
        place = dict(zip(inner, range(d, d + k)))
        some = sorted({*slots, *(int(tree.slot[i]) for i in inner)})
        values = np.zeros((len(out), len(every)))
        _add_below(values, tree, at, slots, share, every & ((1 << d) - 1), lambda i: (every >> place[i]) & 1 == 1)
        for slot in some:
            out[slot] += values[slot][code]
        return
    goes, slot, part = left(at), int(tree.slot[at]), float(tree.share[at])
    for child, way, s in ((at + 1, goes, part), (int(tree.right[at]), ~goes, 1 - part)):
        if slot in slots:
            j = slots.index(slot)
            _add_below(out, tree, child, slots, [*share[:j], share[j] * s, *share[j + 1:]], np.where(way, code, code & ~(1 << j)), left)
        else:
            _add_below(out, tree, child, [*slots, slot], [*share, s], code | (way.astype(np.int64) << d), left)


def _per_input(slots: Sequence[int], n_inputs: int, packed: DataFrame):
    """Arrow batches of feature arrays to arrays with one value per input.

    The trees go to every task in broadcast parts, so the driver holds one part at a time.
    """
    place, context = np.asarray(slots), packed.sparkSession.sparkContext
    parts, now, held = [], [], 0
    sizes = [tuple(r) for r in packed.select("tree", "size").orderBy("tree").collect()]
    for i, (number, size) in enumerate(sizes):
        now.append(number)
        held += size
        if i + 1 == len(sizes) or held + sizes[i + 1][1] > PART:
            found = packed.where(F.col("tree").between(now[0], now[-1])).select("tree", "packed").collect()
            parts.append(context.broadcast([bytes(r["packed"]) for r in sorted(found)]))
            now, held = [], 0

    def explained(batches: list[pa.Array]) -> Iterator[pa.Array]:
        n = sum(map(len, batches))
        x = np.concatenate([b.flatten().to_numpy(zero_copy_only=False) for b in batches]).reshape(n, len(place)).T.copy()
        by_slot, by_input = np.zeros_like(x), np.zeros((n_inputs, n))
        for part in parts:
            for tree in part.value:
                by_slot += tree_values(x, pickle.loads(tree))
        np.add.at(by_input, place, by_slot)
        flat, a = by_input.T.ravel(), 0
        for b in batches:
            m = len(b)
            yield pa.ListArray.from_arrays(pa.array(np.arange(m + 1) * n_inputs, pa.int32()), pa.array(flat[a * n_inputs:(a + m) * n_inputs]))
            a += m

    @F.arrow_udf(ArrayType(DoubleType()))
    def run(features: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held, n = [], 0
        for batch in features:
            held.append(batch)
            n += len(batch)
            if n >= BLOCK:
                yield from explained(held)
                held, n = [], 0
        if held:
            yield from explained(held)

    return run


def _linear(trained: Trained, train: DataFrame, slots: Sequence[int]):
    """Weight times the distance from the mean of TRAIN, summed over the slots of each input."""
    mean = train.select(Summarizer.mean(F.col("features"))).first()[0].toArray().tolist()
    weight = trained.model.coefficients.toArray().tolist()
    base = trained.model.intercept + math.fsum(w * m for w, m in zip(weight, mean))
    array = lambda v: F.array(*map(F.lit, v))
    far = F.zip_with(vector_to_array("features"), array(mean), lambda x, m: x - m)
    added = F.zip_with(far, array(weight), lambda x, w: x * w)
    parts = []
    for i in range(len(trained.inputs.columns)):
        mine = [s for s, owner in enumerate(slots) if owner == i]
        part = F.slice(added, mine[0] + 1, len(mine)) if mine else F.array().cast("array<double>")
        parts.append(F.aggregate(part, F.lit(0.0), lambda a, b: a + b))
    return F.array(*parts), base


def attributions(rows: DataFrame, trained: Trained, train: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """``key, score, base, attributions``: one value per input, in the order of ``trained.inputs.columns``.

    ``base`` plus all values is the score. Scores are predicted numbers, the probability of class 1 of a
    forest, or the log-odds of a logistic model. NULL inputs count as what the preparation makes of
    them; repeated rows get a line each; ``train`` is read for linear models only.
    """
    inputs = trained.inputs
    owner = {c: i for i, c in enumerate(inputs.columns)}
    slots = [owner[source_of(name, trained)] for name in slot_names(trained, rows)]
    typed = [*[F.col(c).cast("double").alias(c) for c in inputs.numeric], *inputs.categorical]
    linear = hasattr(trained.model, "coefficients")
    classes = hasattr(trained.model, "numClasses")
    if linear:
        values, base = _linear(trained, trained.prepare.transform(train.select(*typed)), slots)
        score = vector_to_array(F.col("rawPrediction"))[1] if classes else F.col("prediction")
    else:
        packed = trees(trained)
        base = math.fsum(r["base"] for r in packed.select("base").collect())
        values = _per_input(slots, len(inputs.columns), packed)(vector_to_array("features"))
        release(packed)
        score = positive_probability() if classes else F.col("prediction")
    scored = trained.transform(rows.select(F.struct(F.lit(0).alias("_"), *key).alias("_key"), *typed))
    return scored.select(*[F.col("_key")[k].alias(k) for k in key], score.alias("score"), F.lit(base).alias("base"),
                         values.alias("attributions"))
