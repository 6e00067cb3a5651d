"""Boosted trees as Spark ML's GBTClassifier grows them (same bins, trees, loss and early stopping), in numpy.

Spark ML starts five jobs a round and touches every feature of every row in each. Here one barrier stage holds the rows
as numbers of bins for all rounds; its tasks send histograms to the driver, which chooses the splits and sends them back.
Several features share a histogram as long as their bins do, and of two children only the smaller one is counted.
"""

from __future__ import annotations

import contextlib
import os
import secrets
import socket
import threading
from collections.abc import Callable, Iterator
from multiprocessing.connection import Client, Connection, Listener

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession

from ..functions.memory import freed

#: Cells of a histogram that features share, and rows that are counted at once.
_CELLS, _ROWS = 1024, 1 << 16
Splits = list[np.ndarray]


def found_splits(sample: np.ndarray, bins: int = 32) -> Splits:
    """Thresholds of each column, as Spark ML finds them: between all values if these are few, else at even counts."""
    out = []
    for column in sample.T:
        values, counts = np.unique(column, return_counts=True)
        middle = (values[:-1] + values[1:]) / 2
        if len(middle) >= bins:
            stride, upto = len(column) / bins, np.cumsum(counts)
            chosen, target = [], stride
            for k in range(1, len(values)):
                if abs(upto[k - 1] - target) < abs(upto[k] - target):
                    chosen.append(middle[k - 1])
                    target += stride
            middle = np.array(chosen)
        out.append(middle)
    return out


def _binned(splits: Splits) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.stack([np.searchsorted(s, b.column(k).to_numpy(zero_copy_only=False)).astype(np.uint8) for k, s in enumerate(splits)])
                y, held = (b.column(c).to_numpy(zero_copy_only=False).astype(np.uint8) for c in ("is_match", "held"))
                yield pa.RecordBatch.from_pydict({"x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary()), "held": pa.array([held.tobytes()], pa.binary())})

    return run


def grouped(sizes: list[int]) -> list[list[int]]:
    """Features that share a histogram: the product of their numbers of bins is _CELLS at most."""
    out: list[list[int]] = []
    room: list[int] = []
    for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
        at = next((k for k, r in enumerate(room) if r >= sizes[f]), None)
        if at is None:
            out.append([])
            room.append(_CELLS)
            at = len(out) - 1
        out[at].append(f)
        room[at] //= sizes[f]
    return out


def _at_once(connection: Connection) -> Connection:
    """Messages leave without waiting for the answer to the one before."""
    with socket.socket(fileno=os.dup(connection.fileno())) as s:
        s.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)
    return connection


class Rows:
    """A task's share of the rows."""

    def __init__(self, x: np.ndarray, y: np.ndarray, sizes: list[int], counts: bool) -> None:
        """x: bins by feature and row. y: 0 or 1. counts: whether histograms are asked for."""
        self.x, self.sizes, self.groups = x, sizes, grouped(sizes)
        self.y = y.astype(float) * 2 - 1
        self.guess = np.zeros(len(y))
        self.counted: np.ndarray | None = None
        self.cells = []
        for g in self.groups if counts else []:
            joint = np.zeros(len(y), np.uint16)
            for f in g:
                joint = joint * np.uint16(sizes[f]) + x[f]
            self.cells.append(joint)

    def begin(self, first: bool) -> None:
        """What the next tree is fitted to: the labels, then the negative gradient of the loss."""
        self.rows = {1: np.arange(len(self.y), dtype=np.int32)}
        self.target = self.y.copy() if first else 4 * self.y / (1 + np.exp(2 * self.y * self.guess))

    def histogram(self, nodes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count and sum of the targets by node, feature and bin; sums of squares by node."""
        most, m = max(self.sizes), len(nodes)
        count, total, square = np.zeros((m, len(self.sizes), most)), np.zeros((m, len(self.sizes), most)), np.zeros(m)
        for i, n in enumerate(nodes):
            again = n == 1 and self.counted is not None  # the root has the same rows in each round
            size = [int(np.prod([self.sizes[f] for f in g])) for g in self.groups]
            joint = [(np.zeros(s), np.zeros(s)) for s in size]
            for k in range(0, len(self.rows[n]), _ROWS):
                rows = slice(k, k + _ROWS) if n == 1 else self.rows[n][k : k + _ROWS]
                weight = self.target[rows]
                square[i] += weight @ weight
                for s, cells, (c, t) in zip(size, self.cells, joint, strict=True):
                    where = cells[rows].astype(np.intp)
                    t += np.bincount(where, weight, s)
                    if not again:
                        c += np.bincount(where, None, s)
            for g, (c, t) in zip(self.groups, joint, strict=True):
                shape = [self.sizes[f] for f in g]
                for k, f in enumerate(g):
                    others = tuple(j for j in range(len(g)) if j != k)
                    count[i, f, : self.sizes[f]], total[i, f, : self.sizes[f]] = c.reshape(shape).sum(axis=others), t.reshape(shape).sum(axis=others)
            if again:
                count[i] = self.counted
            elif n == 1:
                self.counted = count[i].copy()
        return count, total, square

    def split(self, feature: np.ndarray, upto: np.ndarray) -> None:
        """Rows of nodes that are split go to their children."""
        for n in [n for n in self.rows if feature[n] >= 0]:
            rows = self.rows.pop(n)
            right = self.x[feature[n]].take(rows) > upto[n]
            self.rows[2 * n], self.rows[2 * n + 1] = rows[~right], rows[right]

    def end(self, value: np.ndarray, weight: float) -> None:
        """The tree counts from now on."""
        for n, rows in self.rows.items():
            self.guess[rows] += weight * value[n]

    def loss(self) -> float:
        return float((2 * np.logaddexp(0, -2 * self.y * self.guess)).sum())


def _worker(address: tuple[str, int], key: bytes, sizes: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, held = [np.zeros((len(sizes), 0), np.uint8)], [np.zeros(0, np.uint8)], [np.zeros(0, np.uint8)]
        for b in batches:
            for i in range(b.num_rows):
                one, two, three = (np.frombuffer(b.column(c)[i].as_py(), np.uint8) for c in ("x", "y", "held"))
                x.append(one.reshape(len(sizes), -1))
                y.append(two)
                held.append(three)
        kept = np.concatenate(held) == 1
        every, label = np.concatenate(x, axis=1), np.concatenate(y)
        x.clear()
        train, test = Rows(every[:, ~kept], label[~kept], sizes, True), Rows(every[:, kept], label[kept], sizes, False)
        del every
        freed()
        with _at_once(Client(address, authkey=key)) as driver:
            driver.send((len(train.y), len(test.y)))
            while (order := driver.recv()) is not None:
                what, *given = order
                if what == "begin":
                    train.begin(*given)
                    test.begin(*given)
                elif what == "count":
                    driver.send(train.histogram(*given))
                elif what == "split":
                    train.split(*given)
                    test.split(*given)
                else:
                    train.end(*given)
                    test.end(*given)
                    driver.send(test.loss())
        del train, test
        freed()
        yield pa.RecordBatch.from_pydict({"n": pa.array([len(label)], pa.int64())})

    return run


class Tree:
    """Nodes by number: the root is 1, the children of n are 2n and 2n + 1."""

    def __init__(self, depth: int) -> None:
        n = 2 << depth
        self.feature, self.upto = np.full(n, -1), np.zeros(n, np.int64)
        self.count, self.sum, self.square, self.gain = (np.zeros(n) for _ in range(4))

    @property
    def value(self) -> np.ndarray:
        return np.divide(self.sum, self.count, out=np.zeros(len(self.sum)), where=self.count > 0)


def _grown(tasks: list[Connection], sizes: list[int], depth: int, first: bool) -> Tree:
    def told(*order: object) -> None:
        for t in tasks:
            t.send(order)

    def counted(nodes: list[int]) -> dict[int, list[np.ndarray]]:
        told("count", nodes)
        sums = [sum(parts) for parts in zip(*[t.recv() for t in tasks], strict=True)]
        return {n: [s[k] for s in sums] for k, n in enumerate(nodes)}

    tree = Tree(depth)
    told("begin", first)
    known = counted([1])
    count, total, square = known[1]
    tree.count[1], tree.sum[1], tree.square[1] = count[0].sum(), total[0].sum(), square
    usable = np.arange(max(sizes) - 1) < np.array(sizes)[:, None] - 1
    for level in range(depth):
        feature, upto, asked = np.full(256, -1), np.zeros(256, np.int64), []
        for n, (count, total, _) in known.items():
            left_n, left_s = np.cumsum(count, axis=1)[:, :-1], np.cumsum(total, axis=1)[:, :-1]
            right_n, right_s = tree.count[n] - left_n, tree.sum[n] - left_s
            ok = usable & (left_n >= 1) & (right_n >= 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(ok, (left_s**2 / left_n + right_s**2 / right_n - tree.sum[n] ** 2 / tree.count[n]) / tree.count[n], 0.0)
            best = int(gain.argmax()) if gain.size else -1
            # what is left of rounding is no gain
            if best < 0 or gain.flat[best] <= 1e-12 * max(tree.square[n] / tree.count[n], 1e-300):
                continue
            f, k = divmod(best, gain.shape[1])
            feature[n], upto[n] = tree.feature[n], tree.upto[n] = f, k
            tree.gain[n] = gain[f, k]
            tree.count[2 * n], tree.sum[2 * n], tree.count[2 * n + 1], tree.sum[2 * n + 1] = left_n[f, k], left_s[f, k], right_n[f, k], right_s[f, k]
            asked.append(2 * n + int(right_n[f, k] < left_n[f, k]))
        if not asked:
            break
        told("split", feature, upto)
        if level == depth - 1:
            break
        found, before = counted(asked), known
        known = {}
        for n in asked:
            known[n], known[n ^ 1] = found[n], [a - b for a, b in zip(before[n // 2], found[n], strict=True)]
            tree.square[n], tree.square[n ^ 1] = known[n][2], known[n ^ 1][2]
    return tree


def _boosted(tasks: list[Connection], sizes: list[int], rounds: int, depth: int, step: float, tolerance: float) -> list[tuple[Tree, float]]:
    held = sum(n for _, n in [t.recv() for t in tasks])
    out: list[tuple[Tree, float]] = []
    best, upto = np.inf, rounds
    for k in range(rounds):
        out.append((_grown(tasks, sizes, depth, not k), step if k else 1.0))
        for t in tasks:
            t.send(("end", out[-1][0].value, out[-1][1]))
        loss = sum(t.recv() for t in tasks) / max(held, 1)
        if held:
            if k and best - loss < tolerance * max(loss, 0.01):
                break
            if loss < best:
                best, upto = loss, k + 1
    for t in tasks:
        t.send(None)
    return out[:upto]


def fitted(rows: DataFrame, names: list[str], rounds: int, depth: int, step: float, tolerance: float, seed: int = 42, bins: int = 32) -> tuple[list[tuple[Tree, float]], Splits]:
    """Trees with their weights, and the thresholds of the features. rows: names as doubles, is_match, held (0 or 1). Rows
    that are held count for the end of boosting only."""
    spark = rows.sparkSession
    n = rows.filter("held = 0").count()
    enough = max(bins * bins, 10_000)  # rows that thresholds are found on, as in Spark ML
    seen = rows.filter("held = 0").select(*names)
    sample = seen.sample(enough / n, seed) if n > enough else seen
    splits = found_splits(sample.toPandas().to_numpy(float), bins)
    sizes = [len(s) + 1 for s in splits]
    parts, key = max(1, spark.sparkContext.defaultParallelism), secrets.token_bytes(32)
    cells = rows.select(*names, "is_match", "held").mapInArrow(_binned(splits), "x binary, y binary, held binary").repartition(parts)
    grown: list[list[tuple[Tree, float]]] = []
    with Listener((spark.conf.get("spark.driver.host"), 0), backlog=parts, authkey=key) as door:
        over, address = threading.Event(), door.address

        def serve() -> None:
            while not over.is_set():
                tasks: list[Connection] = []
                try:
                    while len(tasks) < parts:
                        tasks.append(_at_once(door.accept()))
                        if over.is_set():
                            return
                    grown.append(_boosted(tasks, sizes, rounds, depth, step, tolerance))
                except (EOFError, OSError):  # a task is gone: Spark starts all of them again
                    pass
                except BaseException:  # tasks must not wait for a driver that is gone
                    over.set()
                    door.close()
                    raise
                finally:
                    for t in tasks:
                        t.close()

        thread = threading.Thread(target=serve, daemon=True)
        thread.start()
        try:
            cells.mapInArrow(_worker(address, key, sizes), "n long", barrier=True).collect()
        finally:
            over.set()
            with contextlib.suppress(OSError):
                Client(address, authkey=key).close()  # the thread stops waiting for tasks
            thread.join()
            freed()
    return grown[-1], splits


def as_model(spark: SparkSession, trees: list[tuple[Tree, float]], splits: Splits) -> GBTClassificationModel:
    """The trees as a model of Spark ML."""
    sc = spark.sparkContext
    jvm, gateway = sc._jvm, sc._gateway
    ml = jvm.org.apache.spark.ml
    doubles = lambda x: _array(gateway, jvm.double, x)

    def node(tree: Tree, n: int) -> object:
        count, value = float(tree.count[n]), float(tree.value[n])
        spread = max(float(tree.square[n]) / count - value * value, 0.0) if count else 0.0
        stats = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(doubles([count, float(tree.sum[n]), float(tree.square[n])]), int(count))
        f = int(tree.feature[n])
        if f < 0:
            return ml.tree.LeafNode(value, spread, stats)
        split = ml.tree.ContinuousSplit(f, float(splits[f][tree.upto[n]]))
        return ml.tree.InternalNode(value, spread, float(tree.gain[n]), node(tree, 2 * n), node(tree, 2 * n + 1), split, stats)

    regression = ml.regression.DecisionTreeRegressionModel
    made = gateway.new_array(regression, len(trees))
    for k, (tree, _) in enumerate(trees):
        made[k] = regression(f"dtr_{secrets.token_hex(6)}", node(tree, 1), len(splits))
    return GBTClassificationModel(ml.classification.GBTClassificationModel(f"GBTClassifier_{secrets.token_hex(6)}", made, doubles([w for _, w in trees]), len(splits), 2))


def _array(gateway: object, kind: object, values: list) -> object:
    out = gateway.new_array(kind, len(values))
    for k, v in enumerate(values):
        out[k] = v
    return out
