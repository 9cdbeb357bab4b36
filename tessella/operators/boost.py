"""Boosted trees for a 0/1 label, grown level by level by all tasks of one stage at the same time.

The steps are those of Spark's ``GBTClassifier`` (logistic loss, variance gain, bins of features found ahead, early stop
by the loss of held-out rows), and the result is its model.  Spark starts a job for each level of each tree; here one
barrier stage keeps the binned rows (about 80 bytes each) in its tasks and passes only sums on, so a level costs no job.
"""

from __future__ import annotations

import json
import secrets
import socket
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import delete, passing, scratch_dir, stored

#: Bins of a feature, and rows (those with the smallest keys) whose values place their cuts; Spark's trees take 32 and 10,000.
BINS, CUT_ROWS = 64, 100_000
#: Rows that are counted at once.
BLOCK = 1 << 17
#: Residuals and losses are whole multiples of 1 / UNIT (single precision), so their sums are exact in any order:
#: trees do not depend on how rows are dealt to tasks.
UNIT = float(1 << 22)
#: Seconds without a word from another task.
PATIENCE = 3600


@dataclass(frozen=True)
class Settings:
    rounds: int
    depth: int
    step: float
    least_per_node: int
    rows: float
    features: float
    seed: int
    #: The boosting ends when a round lowers the held-out loss by less than this share (Spark's ``validationTol``).
    least_gain: float = 0.01


def cuts_of(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Cuts halfway between neighbouring values: all of them, or those that give each bin an equal share of the rows left.

    A value that many rows have thus takes one bin, and the others share what remains.
    """
    v, n = np.unique(values[~np.isnan(values)].astype(np.float64), return_counts=True)
    if len(v) <= bins:
        return (v[:-1] + v[1:]) / 2
    below, used, at = np.cumsum(n), 0, []
    for left in range(bins, 1, -1):
        goal = used + (below[-1] - used) / left
        i = int(np.searchsorted(below, goal))
        first = at[-1] + 1 if at else 0
        if i > first and goal - below[i - 1] <= below[i] - goal:
            i -= 1
        if i >= len(v) - 1:
            break
        at.append(i)
        used = below[i]
    at = np.array(at, int)
    return (v[at] + v[at + 1]) / 2


def _binned(batches: Iterator[pa.RecordBatch], cuts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row for each batch: its keys, labels (1) and held rows (2), and its bins, two features in one number."""
    for batch in batches:
        if not batch.num_rows:
            continue
        pairs = np.zeros((-(-len(cuts) // 2), batch.num_rows), np.uint16)
        for f, c in enumerate(cuts):
            at = np.searchsorted(c, batch.column(f).to_numpy(zero_copy_only=False)).astype(np.uint16)
            pairs[f // 2] += at if f % 2 else at * np.uint16(BINS)
        key, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "kind"))
        out = [key.astype(np.int64).tobytes(), kind.astype(np.uint8).tobytes(), pairs.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in out], names=["keys", "kinds", "pairs"])


class Exchange:
    """Sums over the tasks of a barrier stage: task 0 gets every task's numbers and answers all."""

    def __init__(self, context: BarrierTaskContext):
        tasks = context.getTaskInfos()
        self.first, self.others, self.root = context.partitionId() == 0, [], None
        server = socket.create_server(("", 0), backlog=len(tasks)) if self.first else None
        said = context.allGather(f"{server.getsockname()[1]} {secrets.token_hex(16)}" if self.first else "")
        port, word = next(s for s in said if s).split()
        if self.first:
            server.settimeout(PATIENCE)
            while len(self.others) < len(tasks) - 1:
                peer = server.accept()[0]
                peer.settimeout(PATIENCE)
                if self._take(peer, len(word)) == word.encode():
                    self.others.append(peer)
                else:
                    peer.close()
            server.close()
        else:
            self.root = socket.create_connection((tasks[0].address.rpartition(":")[0] or tasks[0].address, int(port)), PATIENCE)
            self.root.sendall(word.encode())

    @staticmethod
    def _take(peer: socket.socket, size: int) -> bytearray:
        out = bytearray(size)
        view = memoryview(out)
        while len(view):
            n = peer.recv_into(view)
            if not n:
                raise ConnectionError("a task of the boosting ended")
            view = view[n:]
        return out

    def _get(self, peer: socket.socket) -> np.ndarray:
        return np.frombuffer(self._take(peer, int.from_bytes(self._take(peer, 8), "big")))

    @staticmethod
    def _put(peer: socket.socket, numbers: np.ndarray) -> None:
        data = np.ascontiguousarray(numbers, np.float64).tobytes()
        peer.sendall(len(data).to_bytes(8, "big") + data)

    def total(self, own: np.ndarray) -> np.ndarray | None:
        """The sum of all tasks' arrays, at task 0."""
        if self.root:
            return self._put(self.root, own)
        for peer in self.others:
            own = own + self._get(peer).reshape(own.shape)
        return own

    def tell(self, answer: np.ndarray | None) -> np.ndarray:
        """What task 0 answers, at all tasks."""
        if self.root:
            return self._get(self.root)
        for peer in self.others:
            self._put(peer, answer)
        return np.asarray(answer, np.float64).ravel()

    def close(self) -> None:
        for peer in [*self.others, *([self.root] if self.root else [])]:
            peer.close()


def histograms(pairs: np.ndarray, rows: np.ndarray, slot: np.ndarray, target: np.ndarray, slots: int) -> np.ndarray:
    """[slot, feature, bin, (rows, sum of targets)] of the rows; two features are counted together and then told apart."""
    cells = slots * BINS * BINS
    out = np.zeros((2, len(pairs), cells))
    for lo in range(0, len(rows), BLOCK):
        own = rows[lo : lo + BLOCK]
        base, w = slot[lo : lo + BLOCK].astype(np.int64) * (BINS * BINS), target[own]
        for k, pair in enumerate(pairs):
            at = base + pair[own]
            out[0, k] += np.bincount(at, minlength=cells)
            out[1, k] += np.bincount(at, w, cells)
    out = out.reshape(2, len(pairs), slots, BINS, BINS)
    both = np.stack([out.sum(4), out.sum(3)], 2)  # (2, pairs, feature of the pair, slots, bins)
    return both.transpose(3, 1, 2, 4, 0).reshape(slots, 2 * len(pairs), BINS, 2)


def best_split(h: np.ndarray, features: np.ndarray, least: int) -> tuple[float, int, int, float, float] | None:
    """(gain, feature, bin, rows and sum on the left) of the split that lowers the variance most, ties to the first feature."""
    n, s = h[0, :, 0].sum(), h[0, :, 1].sum()
    left = h[features].cumsum(1)[:, :-1]
    nl, sl = left[..., 0], left[..., 1]
    fits = (nl >= least) & (n - nl >= least)
    if not fits.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fits, (sl * sl / nl + (s - sl) ** 2 / (n - nl) - s * s / n) / n, -1.0)
    f, b = np.unravel_index(np.argmax(gain), gain.shape)
    if gain[f, b] <= 1e-12 * max(1e-3, (s / n) ** 2):
        return None
    return float(gain[f, b]), int(features[f]), int(b), float(nl[f, b]), float(sl[f, b])


def _tree(x: Exchange, pairs: np.ndarray, bag: np.ndarray, target: np.ndarray, n_features: int, s: Settings, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """(node of each row, [node, (rows, sum, gain, feature, bin)]); nodes are numbered as in a heap from 1, leaves have feature -1."""
    size, place = 2 << s.depth, np.arange(pairs.shape[1])
    tree = np.zeros((size, 5))
    tree[:, 3] = -1
    node = np.ones(pairs.shape[1], np.int64)
    build, whole, known = [1], [(1, 0, 0)], {}  # whole: (node counted, its parent, its sibling)
    chosen = max(1, min(n_features, int(np.ceil(s.features * n_features))))
    for _ in range(s.depth):
        slots = np.full(size, -1, np.int64)
        slots[build] = np.arange(len(build))
        slot = slots[node]
        rows = np.flatnonzero(bag & (slot >= 0))
        got, plan = x.total(histograms(pairs, rows, slot[rows], target, len(build))), []
        if x.first:
            level = {}
            for (own, parent, other), h in zip(whole, got, strict=True):
                level[own] = h
                if other:
                    level[other] = known[parent] - h
            known = level
            if 1 in level:
                tree[1, :2] = level[1][0].sum(0)
            for at in sorted(level):
                features = np.sort(np.random.default_rng([s.seed, turn, at]).permutation(n_features)[:chosen])
                found = best_split(level[at], features, s.least_per_node)
                if found:
                    gain, f, b, n, total = found
                    tree[at, 2:] = gain, f, b
                    tree[2 * at, :2] = n, total
                    tree[2 * at + 1, :2] = tree[at, :2] - (n, total)
                    small = 2 * at + (tree[2 * at + 1, 0] < n)
                    plan.append((at, f, b, small if max(n, tree[at, 0] - n) >= 2 * s.least_per_node else 0))
        plan = x.tell(np.array(plan)).reshape(-1, 4).astype(np.int64)
        if not len(plan):
            break
        feature, cut, splits = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, bool)
        feature[plan[:, 0]], cut[plan[:, 0]], splits[plan[:, 0]] = plan[:, 1], plan[:, 2], True
        f = feature[node]
        pair = pairs[f >> 1, place]
        right = np.where(f & 1, pair % BINS, pair // BINS) > cut[node]
        node = np.where(splits[node], 2 * node + right, node)
        build = [int(b) for b in plan[:, 3] if b]
        whole = [(b, b // 2, b ^ 1) for b in build]
        if not build:
            break
    return node, x.tell(tree).reshape(size, 5)


def in_bag(key: np.ndarray, share: float, seed: int, turn: int) -> np.ndarray:
    """A share of the rows for each round, by their keys (SplitMix64)."""
    if share >= 1:
        return np.ones(len(key), bool)
    z = key.view(np.uint64) + np.uint64(((seed + 1) * 0xD1342543DE82EF95 + (turn + 1) * 0x9E3779B97F4A7C15) % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) < np.uint64(int(share * 2**64))


def _whole(numbers: np.ndarray) -> np.ndarray:
    return np.rint(numbers * UNIT) / UNIT


def _boost(batches: Iterator[pa.RecordBatch], n_features: int, s: Settings) -> Iterator[pa.RecordBatch]:
    """The rounds of one model; task 0 yields each tree as bytes of :func:`_tree`'s numbers."""
    keys, kinds, parts = [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)], [np.zeros((-(-n_features // 2), 0), np.uint16)]
    for batch in batches:
        for k, kind, p in zip(*(batch.column(c) for c in ("keys", "kinds", "pairs")), strict=True):
            keys.append(np.frombuffer(k.as_py(), np.int64))
            kinds.append(np.frombuffer(kind.as_py(), np.uint8))
            parts.append(np.frombuffer(p.as_py(), np.uint16).reshape(-(-n_features // 2), -1))
    key, kind, pairs = np.concatenate(keys), np.concatenate(kinds), np.concatenate(parts, axis=1)
    del keys, kinds, parts
    y, held = np.where(kind & 1, 1.0, -1.0), np.flatnonzero(kind & 2)
    score, teaches = np.zeros(len(y)), (kind & 2) == 0
    x, trees, best, kept = Exchange(BarrierTaskContext.get()), [], np.inf, 0
    try:
        watched = x.tell(x.total(np.array([float(len(held))])))[0] > 0
        for turn in range(s.rounds):
            with np.errstate(over="ignore"):
                target = y if not turn else _whole(4 * y / (1 + np.exp(2 * y * score)))
            node, tree = _tree(x, pairs, teaches & in_bag(key, s.rows, s.seed, turn), target, n_features, s, turn)
            score += (s.step if turn else 1.0) * (tree[:, 1] / np.maximum(tree[:, 0], 1))[node]
            trees.append(tree)
            if not watched:
                kept = turn + 1
                continue
            loss = x.total(np.array([_whole(2 * np.logaddexp(0, -2 * y[held] * score[held])).sum(), float(len(held))]))
            now = loss[0] / loss[1] if x.first else None
            if x.tell(np.array([turn and best - now < s.least_gain * max(now, 0.01)]) if x.first else None)[0]:
                break
            if x.first:
                best, kept = now, turn + 1
        if x.first:
            yield pa.RecordBatch.from_arrays([pa.array(range(kept), pa.int32()), pa.array([t.tobytes() for t in trees[:kept]], pa.binary())], names=["turn", "tree"])
    finally:
        x.close()


def _loaded(spark: SparkSession, trees: list[np.ndarray], cuts: list[np.ndarray], s: Settings) -> GBTClassificationModel:
    """Spark's model of these trees, read from its own file format (variances are not counted, so nodes have none)."""
    about = lambda name, uid, params, **more: json.dumps({"class": f"org.apache.spark.ml.{name}", "timestamp": 0, "sparkVersion": spark.version, "uid": uid, "paramMap": params, "defaultParamMap": {}, **more})
    columns = {"featuresCol": "vector", "predictionCol": "prediction", "impurity": "variance"}
    own = columns | {"labelCol": "label", "probabilityCol": "probability", "rawPredictionCol": "rawPrediction", "maxIter": s.rounds, "maxDepth": s.depth, "stepSize": s.step, "minInstancesPerNode": s.least_per_node, "subsamplingRate": s.rows, "seed": s.seed}
    uid = uuid.uuid4().hex[:12]
    nodes, heads = [], []
    for t, tree in enumerate(trees):
        known = [1]
        for at in known:  # parents before children
            known += [2 * at, 2 * at + 1] if tree[at, 3] >= 0 else []
        place = {at: i for i, at in enumerate(known)}
        for at in known:
            n, total, gain, f, b = (float(v) for v in tree[at])
            mean = total / max(n, 1.0)
            down = (gain, place[2 * at], place[2 * at + 1], (int(f), [float(cuts[int(f)][int(b)])], -1)) if f >= 0 else (-1.0, -1, -1, (-1, [], -1))
            nodes.append((t, (place[at], mean, 0.0, [n, total, mean * total], int(n), *down)))
        heads.append((t, about("regression.DecisionTreeRegressionModel", f"dtr_{uid}_{t}", columns), s.step if t else 1.0))
    path = f"{scratch_dir(spark)}/trees-{uid}"
    spark.createDataFrame([(about("classification.GBTClassificationModel", f"GBTClassifier_{uid}", own, numFeatures=len(cuts), numTrees=len(trees)),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(heads, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    split = "struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
    schema = f"treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: long, gain: double, leftChild: int, rightChild: int, split: {split}>"
    spark.createDataFrame(nodes, schema).coalesce(1).write.parquet(f"{path}/data")
    model = GBTClassificationModel.load(path)
    delete(spark, path)
    return model


def at_once(spark: SparkSession) -> bool:
    """Whether the cluster can run a barrier stage; with dynamic allocation Spark refuses them."""
    return spark.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false").lower() != "true"


def train(rows: DataFrame, names: tuple[str, ...], each: list[Settings]) -> list[GBTClassificationModel]:
    """One model for each of the settings from rows with ``key`` (long, the row's place in all samples), ``label`` (0 or 1), ``held`` and features.

    Held rows end the boosting and teach nothing.  Without any, all rounds are done.
    """
    spark = rows.sparkSession
    floats = {f.name for f in rows.schema.fields if f.dataType.simpleString() == "float"}
    kind = (F.col("label").cast("int") + F.when(F.col("held"), 2).otherwise(0)).cast("int").alias("kind")
    rows = rows.select(*(F.col(n) if n in floats else F.col(n).cast("double").alias(n) for n in names), "key", kind)
    teaching = rows.where("kind < 2")
    n = teaching.count()
    if not n:
        raise ValueError("no rows to train on")
    if n > CUT_ROWS:
        teaching = teaching.where(F.col("key") <= int(-(2**63) + 2**64 * CUT_ROWS / n))
    placed = teaching.select(*names).toArrow()
    cuts = [cuts_of(placed.column(i).to_numpy()) for i in range(len(names))]
    # As many tasks as run at once: a barrier stage waits for all of them.
    context = spark.sparkContext._jsc.sc()
    tasks = max(1, context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile()))
    with passing(spark):
        binned = stored(rows.mapInArrow(lambda batches: _binned(batches, cuts), "keys binary, kinds binary, pairs binary"), "binned")
        dealt = binned.repartition(tasks)  # by turns: rows of one length each, so tasks get equal shares
        models = []
        for s in each:
            found = dealt.mapInArrow(lambda batches, s=s: _boost(batches, len(names), s), "turn int, tree binary", barrier=True).collect()
            trees = [np.frombuffer(r["tree"]).reshape(-1, 5) for r in sorted(found, key=lambda r: r["turn"])]
            models.append(_loaded(spark, trees, cuts, s))
    return models
