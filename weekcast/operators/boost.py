"""Regularised second-order boosting (M2–M5): histograms, many fits at once.

Squared loss, leaf weights and split gains with L1/L2 penalties, rows and
columns drawn per tree (XGBoost's objective; ``gbtree``, and ``gblinear``
from sufficient statistics).  The inputs are binned once; bins are shared by all fits.

All fits advance one tree level per step.  A step adds up gradients and
counts per (fit, node, feature, bin) and gives the best split of every open node:

* a table beyond ``BROADCAST_BYTES`` stays where it is: a step is one job;
  tasks make histograms of their blocks, the sums and the splits are made by
  the task that gets the fit, and only splits come to the driver;
* a smaller one is broadcast and the *fits* are dealt over the tasks, which
  run the same steps on the same blocks (so both ways give the same trees).

Row samples are a hash of (row keys, tree, seed) and sums are made in block
order, so a model does not depend on the cluster.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from ..sources import store

BROADCAST_BYTES = 64 << 20
BLOCK_ROWS = 65_536
MAX_BINS = 256
MAX_CATEGORIES = 65_536
#: Trees after which the margins are written again (a table that is not broadcast).
REWRITE = 10
PARTITIONS = 4


@dataclass(frozen=True)
class Params:
    """One fit; the defaults are the reference library's."""

    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    booster: str = "gbtree"  # dart without drop-out (its default rates are 0) is gbtree
    min_child_weight: float = 1.0
    seed: int = 42


# The tuned booster (the reference's search result).
TUNED = Params(
    n_estimators=51, max_depth=7, learning_rate=0.08962161965694515, reg_lambda=1.5217227415395248e-07, reg_alpha=3.805804544409099e-06,
    subsample=0.2068525521593345, colsample_bytree=0.8857508899692184,
)


@dataclass
class Tree:
    """Nodes in the order of their making; ``feature`` -1 is a leaf, ``cat`` splits on one category against the rest."""

    feature: list = field(default_factory=lambda: [-1])
    bin: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [0])
    right: list = field(default_factory=lambda: [0])
    weight: list = field(default_factory=lambda: [0.0])
    gain: list = field(default_factory=lambda: [0.0])
    cover: list = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin_: int, gain: float, weights: tuple, covers: tuple) -> tuple[int, int]:
        n = len(self.feature)
        self.feature[node], self.bin[node], self.left[node], self.right[node], self.gain[node] = feature, bin_, n, n + 1, gain
        for w, c in zip(weights, covers):
            for name, v in zip(("feature", "bin", "left", "right", "weight", "gain", "cover"), (-1, 0, 0, 0, w, 0.0, c)):
                getattr(self, name).append(v)
        return n, n + 1

    def nodes(self, bins: np.ndarray, cat: int) -> np.ndarray:
        """The leaf of every row of a bin matrix; ``cat`` is the number of the categorical column."""
        at = np.zeros(len(bins), np.int64)
        feature, bin_, left, right = (np.array(x) for x in (self.feature, self.bin, self.left, self.right))
        rows = np.arange(len(bins))
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            b = bins[rows, np.maximum(f, 0)]
            goes_left = np.where(f == cat, b == bin_[at], b <= bin_[at])
            at = np.where(inner, np.where(goes_left, left[at], right[at]), at)


@dataclass(frozen=True)
class Bins:
    """Cut points of the numeric inputs and the categories of the last one."""

    features: tuple
    cuts: tuple  # per numeric input, ascending; bin = number of cuts <= value
    category: str
    categories: tuple

    @property
    def offsets(self) -> np.ndarray:
        """First bin of each input in one row of histogram, and their total."""
        return np.cumsum([0, *[len(c) + 1 for c in self.cuts], max(1, len(self.categories))])

    def of(self, numeric: np.ndarray, category: list) -> np.ndarray:
        number = {c: i for i, c in enumerate(self.categories)}
        out = np.empty((len(category), len(self.features) + 1), np.int32)
        for f, cuts in enumerate(self.cuts):
            out[:, f] = np.searchsorted(np.array(cuts), numeric[:, f], side="right")
        out[:, -1] = [number.get(c, -1) for c in category]
        return out


def make_bins(rows: DataFrame, features, category: str = "familia", max_bins: int = MAX_BINS) -> Bins:
    """Quantile cut points of all rows (every distinct value while there are fewer than ``max_bins``)."""
    probs = [i / max_bins for i in range(max_bins)]
    found = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), F.array(*map(F.lit, probs)), 50 * max_bins).alias(c) for c in features]).first()
    categories = [r[0] for r in rows.select(category).distinct().orderBy(category).limit(MAX_CATEGORIES + 1).collect()]
    if len(categories) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} values of {category}")
    return Bins(tuple(features), tuple(tuple(sorted(set(found[c] or []))) for c in features), category, tuple(categories))


class Block:
    """Binned rows: ``train`` and ``test`` say for each fold which rows it uses."""

    def __init__(self, bins, y, uid, train, test):
        self.bins, self.y, self.uid, self.train, self.test = bins, y, uid, train, test

    def pack(self) -> dict:
        return {"n": len(self.y), "bins": self.bins.tobytes(), "y": self.y.tobytes(), "uid": self.uid.tobytes(), "train": self.train.tobytes(), "test": self.test.tobytes()}

    @classmethod
    def unpack(cls, row: dict) -> Block:
        n = row["n"]
        read = lambda c, t: np.frombuffer(row[c], t)
        return cls(read("bins", np.int32).reshape(n, -1), read("y", float), read("uid", np.uint64), read("train", bool).reshape(n, -1), read("test", bool).reshape(n, -1))

    def sampled(self, p: Params, tree: int, fold: int) -> np.ndarray:
        rows = self.train[:, fold]
        if p.subsample >= 1.0:
            return rows
        h = (self.uid ^ np.uint64((p.seed * 1_000_003 + tree) % (1 << 63))) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return rows & ((h >> np.uint64(11)) < np.uint64(int(p.subsample * (1 << 53))))


_BLOCK = pa.schema([("block", pa.int64()), ("n", pa.int64()), *[(c, pa.binary()) for c in ("bins", "y", "uid", "train", "test")]])
_BLOCK_DDL = "block bigint, n bigint, bins binary, y binary, uid binary, train binary, test binary"


def blocks(rows: DataFrame, bins: Bins, folds: int = 1, keys=("familia", "week_start"), partitions: int = PARTITIONS) -> DataFrame:
    """Written table of blocks from rows (keys, features, target, and ``train_folds``/``test_folds``: arrays of fold numbers).

    Rows are dealt by a hash of their keys and sorted; a null feature or target is an error.
    """
    ship(rows.sparkSession)
    needed = [*bins.features, "target"]
    bad = rows.where(F.greatest(*[F.col(c).isNull().cast("int") for c in needed], F.lit(0)) == 1).count()
    if bad:
        raise ValueError(f"{bad} training rows with a null feature or target")
    uid = F.xxhash64(*[F.col(c).cast("string") for c in keys])
    flat = rows.select(*[F.col(c).cast("double").alias(c) for c in needed], F.col(bins.category).alias("_cat"), uid.alias("_uid"), "train_folds", "test_folds", *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)])
    part = F.pmod(F.xxhash64("_uid"), F.lit(partitions)).cast("int")
    flat = flat.withColumn("_part", part).repartition(partitions, "_part").sortWithinPartitions("_part", *[f"_k{i}" for i in range(len(keys))], "_uid")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, number = None, [], 0

        def emit():
            table = pa.Table.from_batches(held)
            numeric = np.column_stack([np.asarray(table[c]) for c in bins.features]) if bins.features else np.zeros((table.num_rows, 0))
            member = []
            for c in ("train_folds", "test_folds"):
                m = np.zeros((table.num_rows, folds), bool)
                for i, own in enumerate(table[c].to_pylist()):
                    m[i, own or []] = True
                member.append(m)
            b = Block(bins.of(numeric, table["_cat"].to_pylist()), np.asarray(table["target"]), np.asarray(table["_uid"]).view(np.uint64), *member)
            return pa.RecordBatch.from_pylist([{"block": part * (1 << 32) + number} | b.pack()], schema=_BLOCK)

        for batch in batches:
            own = np.asarray(batch.column("_part"))
            cuts = [0, *(np.flatnonzero(np.diff(own)) + 1), len(own)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                for i in range(a, b, BLOCK_ROWS):
                    piece = batch.slice(i, min(b, i + BLOCK_ROWS) - i)
                    if held and (own[i] != part or sum(x.num_rows for x in held) + piece.num_rows > BLOCK_ROWS):
                        yield emit()
                        held, number = [], number + 1 if own[i] == part else 0
                    part = int(own[i])
                    held.append(piece)
        if held:
            yield emit()

    path = store.new_location(rows.sparkSession, "boost-blocks")
    flat.mapInArrow(pack, _BLOCK_DDL).write.parquet(path)
    return rows.sparkSession.read.schema(_BLOCK_DDL).parquet(path)


# ---------------------------------------------------------------- one step


def soft(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def histogram(block: Block, pred: np.ndarray, slot: np.ndarray, slots: int, rows: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(slots, bins, 2): sums of gradients and counts of the sampled rows of each open node."""
    use = np.flatnonzero(rows & (slot >= 0))
    total = int(offsets[-1])
    key = (slot[use, None] * total + offsets[None, :-1] + block.bins[use]).ravel()
    g = np.repeat(pred[use] - block.y[use], block.bins.shape[1])
    return np.stack([np.bincount(key, g, slots * total), np.bincount(key, minlength=slots * total).astype(float)], axis=1).reshape(slots, total, 2)


def split_gains(hist: np.ndarray, offsets: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gains slots x bins, left sums slots x bins x 2, node sums slots x 2); impossible splits have gain -inf."""
    node = hist[:, offsets[-2] : offsets[-1]].sum(axis=1)
    left = hist.copy()
    for a, b in zip(offsets[:-2], offsets[1:-1]):  # numeric inputs: all bins up to this one
        left[:, a:b] = np.cumsum(hist[:, a:b], axis=1)
    right = node[:, None] - left
    score = lambda s: soft(s[..., 0], p.reg_alpha) ** 2 / np.maximum(s[..., 1] + p.reg_lambda, 1e-300)
    gain = score(left) + score(right) - score(node)[:, None]
    gain[(left[..., 1] < p.min_child_weight) | (right[..., 1] < p.min_child_weight)] = -np.inf
    return gain, left, node


def columns(p: Params, tree: int, offsets: np.ndarray) -> np.ndarray:
    """Which bins belong to the columns drawn for a tree; each category is a column of its own."""
    numeric, categories = len(offsets) - 2, int(offsets[-1] - offsets[-2])
    n = numeric + categories
    chosen = np.ones(n, bool)
    if p.colsample_bytree < 1.0:
        chosen[:] = False
        chosen[np.random.default_rng([p.seed, tree]).permutation(n)[: max(1, int(p.colsample_bytree * n))]] = True
    return np.concatenate([np.repeat(chosen[:numeric], np.diff(offsets[:-1])), chosen[numeric:]])


def best_splits(hist: np.ndarray, offsets: np.ndarray, p: Params, tree: int) -> np.ndarray:
    """Per open node: bin (-1: none), gain, gradient and count on the left, and of the node."""
    gain, left, node = split_gains(hist, offsets, p)
    gain[:, ~columns(p, tree, offsets)] = -np.inf
    scale = np.maximum(np.abs(soft(node[:, 0], p.reg_alpha)), 1.0) ** 2
    with np.errstate(invalid="ignore"):
        best = np.argmax(np.round(gain / scale[:, None], 12), axis=1)  # ties: the first input and bin
    at = np.arange(len(best))
    found = gain[at, best] > 1e-6
    return np.column_stack([np.where(found, best, -1), np.where(found, gain[at, best], 0.0), left[at, best], node])


# ---------------------------------------------------------------- all levels of all fits


@dataclass
class Fit:
    """A model in the making: key, parameters, fold, trees so far and the tree at work."""

    key: int
    params: Params
    fold: int
    base: float
    report: tuple  # numbers of trees after which the test error is wanted
    trees: list = field(default_factory=list)
    tree: Tree | None = None
    open: list = field(default_factory=list)
    level: int = 0
    errors: dict = field(default_factory=dict)

    @property
    def done(self) -> bool:
        return len(self.trees) >= self.params.n_estimators


def grow(fits: list[Fit], provider, offsets: np.ndarray) -> list[Fit]:
    """Advance all fits, one level per step, until they have their trees."""
    which = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    while todo := [f for f in fits if not f.done]:
        for f in todo:
            if f.tree is None:
                f.tree, f.open, f.level = Tree(), [0], 0
        splits = provider.step(todo)
        ended = []
        for f in todo:
            p, following = f.params, []
            weight = lambda g, h, p=p: float(-soft(g, p.reg_alpha) / max(h + p.reg_lambda, 1e-300) * p.learning_rate) if h > 0 else 0.0
            for node, (at, gain, gl, hl, g, h) in zip(f.open, splits[f.key]):
                if f.level == 0:
                    f.tree.weight[0], f.tree.cover[0] = weight(g, h), h
                if at >= 0:
                    a = int(at)
                    children = f.tree.split(node, int(which[a]), a - int(offsets[which[a]]), gain, (weight(gl, hl), weight(g - gl, h - hl)), (hl, h - hl))
                    following += children
            f.open, f.level = following, f.level + 1
            if not following or f.level >= p.max_depth:
                f.trees.append(f.tree)
                ended.append(f)
                f.tree = None
        provider.finish(ended)
    return fits


class Local:
    """Steps over blocks at hand (in a task)."""

    def __init__(self, blocks: list[Block], fits: list[Fit], offsets: np.ndarray):
        self.blocks, self.offsets = blocks, offsets
        self.pred = {f.key: [np.full(len(b.y), f.base) for b in blocks] for f in fits}

    def step(self, fits: list[Fit]) -> dict:
        return {f.key: best_splits(self._sum(f), self.offsets, f.params, len(f.trees)) for f in fits}

    def _sum(self, f: Fit) -> np.ndarray:
        return sum(_hist(b, pred, f, self.offsets) for b, pred in zip(self.blocks, self.pred[f.key]))

    def finish(self, fits: list[Fit]) -> None:
        cat = len(self.offsets) - 2
        for f in fits:
            miss = n = 0
            for i, b in enumerate(self.blocks):
                self.pred[f.key][i] = self.pred[f.key][i] + np.array(f.trees[-1].weight)[f.trees[-1].nodes(b.bins, cat)]
                own = b.test[:, f.fold]
                miss, n = miss + np.abs(self.pred[f.key][i] - b.y)[own].sum(), n + own.sum()
            if len(f.trees) in f.report:
                f.errors[len(f.trees)] = (float(miss), int(n))


def _hist(b: Block, pred: np.ndarray, f: Fit, offsets: np.ndarray) -> np.ndarray:
    slot_of = np.full(len(f.tree.feature), -1)
    slot_of[f.open] = np.arange(len(f.open))
    rows = b.sampled(f.params, len(f.trees), f.fold)
    return histogram(b, pred, slot_of[f.tree.nodes(b.bins, len(offsets) - 2)], len(f.open), rows, offsets)


class Jobs:
    """Steps as Spark jobs over the written blocks; margins are written again every ``REWRITE`` trees."""

    def __init__(self, table: DataFrame, fits: list[Fit], offsets: np.ndarray):
        self.spark, self.offsets, self.fits = table.sparkSession, offsets, fits
        self.order = {f.key: i for i, f in enumerate(fits)}
        self.written = {f.key: 0 for f in fits}
        base = np.array([f.base for f in fits])
        self.table = self._write(table, lambda b, _: np.tile(base, (len(b.y), 1)))

    def _write(self, table: DataFrame, preds) -> DataFrame:
        schema = _BLOCK.append(pa.field("preds", pa.binary()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    new = preds(Block.unpack(row), row)
                    yield pa.RecordBatch.from_pylist([{**row, "preds": np.ascontiguousarray(new).tobytes()}], schema=schema)

        path = store.new_location(self.spark, "boost-margins")
        table.mapInArrow(run, _BLOCK_DDL + ", preds binary").write.parquet(path)
        return self.spark.read.schema(_BLOCK_DDL + ", preds binary").parquet(path)

    def _margins(self):
        """Function (block, row) → margins of all fits after the trees that are not in the table."""
        cat, fresh, n = len(self.offsets) - 2, [(self.order[f.key], f.trees[self.written[f.key] :]) for f in self.fits], len(self.fits)

        def margins(b: Block, row: dict) -> np.ndarray:
            out = np.frombuffer(row["preds"]).reshape(len(b.y), n).copy()
            for i, trees in fresh:
                for t in trees:
                    out[:, i] += np.array(t.weight)[t.nodes(b.bins, cat)]
            return out

        return margins

    def step(self, fits: list[Fit]) -> dict:
        margins, order, offsets = self._margins(), self.order, self.offsets
        small = [replace_trees(f) for f in fits]
        shared = self.spark.sparkContext.broadcast(small)
        hist = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("hist", pa.binary())])
        found = pa.schema([("key", pa.int64()), ("splits", pa.binary())])

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                for row in batch.to_pylist():
                    b = Block.unpack(row)
                    pred = margins(b, row)
                    for f in own:
                        h = _hist(b, pred[:, order[f.key]], f, offsets)
                        yield pa.RecordBatch.from_pylist([{"key": f.key, "block": row["block"], "hist": h.tobytes()}], schema=hist)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = {f.key: f for f in shared.value}
            key = total = None

            def best():
                f = own[key]
                return pa.RecordBatch.from_pylist([{"key": key, "splits": best_splits(total.reshape(len(f.open), -1, 2), offsets, f.params, len(f.trees)).tobytes()}], schema=found)

            for batch in batches:
                for k, h in zip(batch.column("key").to_pylist(), batch.column("hist").to_pylist()):
                    if k != key:
                        if key is not None:
                            yield best()
                        key, total = k, np.zeros(len(h) // 8)
                    total = total + np.frombuffer(h)
            if key is not None:
                yield best()

        sums = self.table.mapInArrow(make, "key bigint, block bigint, hist binary").repartition("key").sortWithinPartitions("key", "block")
        out = sums.mapInArrow(add, "key bigint, splits binary").toArrow()
        return {k: np.frombuffer(s).reshape(-1, 6) for k, s in zip(out["key"].to_pylist(), out["splits"].to_pylist())}

    def finish(self, fits: list[Fit]) -> None:
        wanted = [f for f in fits if len(f.trees) in f.report]
        if wanted:
            margins, order = self._margins(), self.order
            asked = [(f.key, f.fold) for f in wanted]
            schema = pa.schema([("key", pa.int64()), ("miss", pa.float64()), ("n", pa.int64())])

            def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for row in batch.to_pylist():
                        b = Block.unpack(row)
                        pred = margins(b, row)
                        out = [{"key": k, "miss": float(np.abs(pred[:, order[k]] - b.y)[b.test[:, fold]].sum()), "n": int(b.test[:, fold].sum())} for k, fold in asked]
                        yield pa.RecordBatch.from_pylist(out, schema=schema)

            sums = self.table.mapInArrow(errors, "key bigint, miss double, n bigint").groupBy("key").agg(F.sum("miss").alias("miss"), F.sum("n").alias("n")).collect()  # one row a fit
            by_key = {r.key: (r.miss, r.n) for r in sums}
            for f in wanted:
                f.errors[len(f.trees)] = by_key[f.key]
        if any(len(f.trees) - self.written[f.key] >= REWRITE for f in self.fits):
            self.table = self._write(self.table, self._margins())
            self.written = {f.key: len(f.trees) for f in self.fits}


def replace_trees(f: Fit) -> Fit:
    """What a step needs of a fit: the finished trees only by number."""
    return replace(f, trees=[None] * len(f.trees), errors={}, report=())


# ---------------------------------------------------------------- models


@dataclass
class Booster:
    """A fitted model: bins, base score and trees (or the weights of a linear one)."""

    bins: Bins
    base: float
    params: Params
    trees: list
    linear: tuple | None = None  # (bias, numeric weights, category weights)

    def margins(self, numeric: np.ndarray, category: list) -> np.ndarray:
        if self.linear:
            bias, w, by_category = self.linear
            number = dict(zip(self.bins.categories, by_category))
            return self.base + bias + numeric @ np.array(w) + np.array([number.get(c, 0.0) for c in category])
        bins, out = self.bins.of(numeric, category), np.full(len(category), self.base)
        for t in self.trees:
            out += np.array(t.weight)[t.nodes(bins, len(self.bins.features))]
        return out

    def save(self, spark, path: str) -> None:
        """One row of JSON in a Parquet table."""
        text = json.dumps({"bins": asdict(self.bins), "base": self.base, "params": asdict(self.params), "trees": [asdict(t) for t in self.trees], "linear": self.linear})
        spark.createDataFrame([(text,)], "model string").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> Booster:
        d = json.loads(spark.read.parquet(path).first()[0])
        b = d["bins"]
        bins = Bins(tuple(b["features"]), tuple(map(tuple, b["cuts"])), b["category"], tuple(b["categories"]))
        return cls(bins, d["base"], Params(**d["params"]), [Tree(**t) for t in d["trees"]], d["linear"])


def score(model: Booster, df: DataFrame, keys=("familia", "week_start")) -> DataFrame:
    """M6/M7: keys, actual (if there is a target) and predicted for each row; null where a feature is null."""
    ship(df.sparkSession)
    features, category = list(model.bins.features), model.bins.category
    missing = [c for c in (*features, category) if c not in df.columns]
    if missing:
        raise ValueError(f"missing model features: {missing}")
    extra = [c for c in ("role", "fold") if c in df.columns]
    actual = [F.col("target").cast("double").alias("actual")] if "target" in df.columns else []
    out = [*[F.col(c) for c in (*keys, *extra)], *actual]
    rows = df.select(*out, *[F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(features)], F.col(category).alias("_cat"))
    names = [*keys, *extra, *(["actual"] if actual else [])]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(f"_f{i}") for i in range(len(features))]
            known = np.ones(batch.num_rows, bool)
            for c in cols:
                known &= np.asarray(c.is_valid())
            x = np.column_stack([np.asarray(c.fill_null(0.0)) for c in cols]) if cols else np.zeros((batch.num_rows, 0))
            pred = shared.value.margins(x, batch.column("_cat").to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(pred, mask=~known)], names=[*names, "predicted"])

    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([*[rows.schema[c] for c in names], StructField("predicted", DoubleType())])
    return rows.mapInArrow(run, schema)


def _fits(table: DataFrame, jobs: list[tuple[int, Params, int, tuple]], means: dict, offsets: np.ndarray, broadcast_bytes: int = BROADCAST_BYTES) -> list[Fit]:
    """Run fits (key, params, fold, report) over the block table."""
    fits = [Fit(k, p, fold, means[fold], report) for k, p, fold, report in jobs]
    size = table.agg(F.sum(F.octet_length("bins") + F.octet_length("y") + F.octet_length("uid") + F.octet_length("train") + F.octet_length("test"))).first()[0] or 0
    if size > broadcast_bytes:
        return grow(fits, Jobs(table, fits, offsets), offsets)
    spark = table.sparkSession
    rows = sorted(table.toArrow().to_pylist(), key=lambda r: r["block"])  # at most broadcast_bytes
    shared = spark.sparkContext.broadcast((rows, fits))
    by_work = sorted(range(len(fits)), key=lambda i: -fits[i].params.n_estimators * fits[i].params.max_depth)
    todo = spark.createDataFrame([(i,) for i in by_work], "i int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, fits = shared.value
        own = [Block.unpack(r) for r in rows]
        for batch in batches:
            for i in batch.column(0).to_pylist():
                f = grow([fits[i]], Local(own, [fits[i]], offsets), offsets)[0]
                text = json.dumps({"trees": [asdict(t) for t in f.trees], "errors": {str(k): v for k, v in f.errors.items()}})
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([text])], names=["i", "fit"])

    parts = min(len(fits), 4 * spark.sparkContext.defaultParallelism)
    for i, text in todo.repartition(parts).mapInArrow(run, "i int, fit string").collect():  # fitted models and errors
        d = json.loads(text)
        fits[i].trees = [Tree(**t) for t in d["trees"]]
        fits[i].errors = {int(k): tuple(v) for k, v in d["errors"].items()}
    return fits


def _means(rows: DataFrame, folds: int) -> dict:
    """Base score of each fold: the mean target of its training rows (12 digits, so that the order of the sum doesn't show)."""
    found = rows.select(F.explode("train_folds").alias("fold"), F.col("target").cast("double").alias("y")).groupBy("fold").agg(F.avg("y").alias("m")).collect()  # one row a fold
    return {i: 0.0 for i in range(folds)} | {r.fold: float(f"{r.m:.12g}") for r in found}


def _plain(train: DataFrame) -> DataFrame:
    none = F.array().cast("array<int>")
    return train.withColumns({"train_folds": F.array(F.lit(0)), "test_folds": none})


def fit(train: DataFrame, params: Params = TUNED, features=None, category: str = "familia", keys=("familia", "week_start"), broadcast_bytes: int = BROADCAST_BYTES) -> Booster:
    """M2: one model of all rows."""
    from .learn import feature_columns

    features = list(features or feature_columns(train))
    if params.booster == "gblinear":
        return fit_linear(train, params, features, category)
    bins = make_bins(train, features, category)
    rows = _plain(train)
    done = _fits(blocks(rows, bins, 1, keys), [(0, params, 0, ())], _means(rows, 1), bins.offsets, broadcast_bytes)[0]
    return Booster(bins, done.base, params, done.trees)


def root_gains(train: DataFrame, params: Params = TUNED, features=None, category: str = "familia") -> DataFrame:
    """Gain of every possible root split of the first tree on all rows (no row or column sample): feature, threshold or category, gain."""
    from .learn import feature_columns

    features = list(features or feature_columns(train))
    bins = make_bins(train, features, category)
    rows = _plain(train)
    mean = _means(rows, 1)[0]
    f = Fit(0, replace(params, subsample=1.0), 0, mean, ())
    f.tree, f.open = Tree(), [0]
    offsets = bins.offsets
    parts = [_hist(b, np.full(len(b.y), mean), f, offsets) for b in map(Block.unpack, sorted(blocks(rows, bins).toArrow().to_pylist(), key=lambda r: r["block"]))]
    gain = split_gains(sum(parts), offsets, params)[0][0]
    out = []
    for i, name in enumerate(features):
        out += [(name, None, float(c), float(gain[offsets[i] + b])) for b, c in enumerate(bins.cuts[i]) if np.isfinite(gain[offsets[i] + b])]
    out += [(category, c, None, float(gain[offsets[-2] + b])) for b, c in enumerate(bins.categories) if np.isfinite(gain[offsets[-2] + b])]
    return train.sparkSession.createDataFrame(out, "feature string, category string, threshold double, gain double")


def importance(model: Booster) -> dict[str, float]:
    """Mean gain of the splits on each input, as a share of their sum."""
    names = [*model.bins.features, model.bins.category]
    gains: dict[str, list] = {n: [] for n in names}
    for t in model.trees:
        for f, g in zip(t.feature, t.gain):
            if f >= 0:
                gains[names[f]].append(g)
    mean = {n: float(np.mean(g)) if g else 0.0 for n, g in gains.items()}
    total = sum(mean.values()) or 1.0
    return {n: g / total for n, g in mean.items()}


# ---------------------------------------------------------------- attribution


def _leaf_paths(t: Tree) -> Iterator[tuple[float, dict]]:
    """(weight, {input: (share of the training rows that its splits let through, [(bin, side, category split)])}) of every leaf."""
    stack = [(0, {})]
    while stack:
        node, path = stack.pop()
        f = t.feature[node]
        if f < 0:
            yield t.weight[node], path
            continue
        for child, side in ((t.left[node], True), (t.right[node], False)):
            share, conditions = path.get(f, (1.0, []))
            stack.append((child, {**path, f: (share * t.cover[child] / t.cover[node], [*conditions, (t.bin[node], side)])}))


def _shares(z: np.ndarray) -> np.ndarray:
    """(2**d, d): for each set of satisfied inputs (bits), what a leaf of weight 1 gives each input.

    The sum over subsets of the other inputs is the product of their
    polynomials z_j + o_j·y, its coefficients weighted by k!(d-k-1)!/d!.
    """
    from math import factorial

    d = len(z)
    o = ((np.arange(1 << d)[:, None] >> np.arange(d)) & 1).astype(float)
    weight = np.array([factorial(k) * factorial(d - k - 1) / factorial(d) for k in range(d)])
    out = np.empty((1 << d, d))
    for f in range(d):
        poly = np.zeros((1 << d, d))
        poly[:, 0] = 1.0
        for j in range(d):
            if j != f:
                poly[:, 1:] = poly[:, 1:] * z[j] + poly[:, :-1] * o[:, j, None]
                poly[:, 0] *= z[j]
        out[:, f] = (poly @ weight) * (o[:, f] - z[f])
    return out


def attributions(model: Booster, bins: np.ndarray) -> tuple[np.ndarray, float]:
    """(rows x inputs Shapley values, base value) of a tree model, missing inputs averaged over the training rows of each node."""
    cat = len(model.bins.features)
    phi, base = np.zeros((len(bins), cat + 1)), model.base
    for t in model.trees:
        for weight, path in _leaf_paths(t):
            names = list(path)
            z = np.array([path[f][0] for f in names])
            base += weight * float(np.prod(z))
            if not names or weight == 0.0:
                continue
            code = np.zeros(len(bins), np.int64)
            for i, f in enumerate(names):
                fits = np.ones(len(bins), bool)
                for b, side in path[f][1]:
                    goes_left = bins[:, f] == b if f == cat else bins[:, f] <= b
                    fits &= goes_left == side
                code |= fits.astype(np.int64) << i
            phi[:, names] += weight * _shares(z)[code]
    return phi, base


def shap(model: Booster, df: DataFrame, keys=("familia", "week_start")) -> DataFrame:
    """Rows (keys, feature, attribution, base_value, predicted), one for each row and input.

    The attributions of a row and the base value add up to its prediction.
    One pass over the rows with the model broadcast; a row with a null
    feature has no prediction and null attributions.
    """
    if model.linear:
        raise ValueError("attribution is for tree models; a linear one's are its terms")
    ship(df.sparkSession)
    features = list(model.bins.features)
    names = [*features, model.bins.category]
    rows = df.select(*keys, *[F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(features)], F.col(model.bins.category).alias("_cat"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            cols = [batch.column(f"_f{i}") for i in range(len(features))]
            known = np.ones(n, bool)
            for c in cols:
                known &= np.asarray(c.is_valid())
            x = np.column_stack([np.asarray(c.fill_null(0.0)) for c in cols]) if cols else np.zeros((n, 0))
            phi, base = attributions(shared.value, shared.value.bins.of(x, batch.column("_cat").to_pylist()))
            each = np.repeat(np.arange(n), len(names))
            null = np.repeat(~known, len(names))
            take = pa.array(each)
            columns = [batch.column(k).take(take) for k in keys]
            columns += [pa.array(names * n), pa.array(phi.ravel(), mask=null), pa.array(np.full(len(each), base)), pa.array(np.repeat(phi.sum(axis=1) + base, len(names)), mask=null)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "feature", "attribution", "base_value", "predicted"])

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    more = [StructField("feature", StringType()), *[StructField(c, DoubleType()) for c in ("attribution", "base_value", "predicted")]]
    return rows.mapInArrow(run, StructType([*[rows.schema[c] for c in keys], *more]))


# ---------------------------------------------------------------- linear booster


def fit_linear(train: DataFrame, params: Params, features, category: str = "familia") -> Booster:
    """``gblinear``: rounds of cyclic coordinate descent with the elastic net, from one aggregate per category.

    The gradients of all rounds follow from sums of products, so the rows are read once.
    """
    features = list(features)
    x = [F.col(c).cast("double") for c in features]
    y = F.col("target").cast("double")
    sums = {"n": F.count(F.lit(1)), "y": F.sum(y)}
    sums |= {f"x{i}": F.sum(a) for i, a in enumerate(x)} | {f"xy{i}": F.sum(a * y) for i, a in enumerate(x)}
    sums |= {f"xx{i}_{j}": F.sum(x[i] * x[j]) for i in range(len(x)) for j in range(i, len(x))}
    found = train.groupBy(category).agg(*[v.alias(k) for k, v in sums.items()]).orderBy(category).limit(MAX_CATEGORIES + 1).collect()  # one row a category
    if len(found) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} values of {category}")
    n_c, y_c = np.array([r.n for r in found], float), np.array([r.y for r in found])
    s = np.array([[r[f"x{i}"] for i in range(len(x))] for r in found]).reshape(len(found), len(x))
    xy = np.array([sum(r[f"xy{i}"] for r in found) for i in range(len(x))])
    xx = np.array([[sum(r[f"xx{min(i, j)}_{max(i, j)}"] for r in found) for j in range(len(x))] for i in range(len(x))]).reshape(len(x), len(x))
    n = n_c.sum()
    base = float(y_c.sum() / n)
    bias, w, c = 0.0, np.zeros(len(x)), np.zeros(len(found))
    lam, alpha, rate = params.reg_lambda * n, params.reg_alpha * n, params.learning_rate

    def delta(g: float, h: float, now: float) -> float:
        if h < 1e-5:
            return 0.0
        g, h = g + lam * now, h + lam
        return max(-(g + alpha) / h, -now) if now - g / h >= 0 else min(-(g - alpha) / h, -now)

    for _ in range(params.n_estimators):
        bias -= rate * ((s @ w).sum() + (n_c * (base + bias + c)).sum() - y_c.sum()) / n
        for i in range(len(x)):
            g = xx[i] @ w + (s[:, i] * (base + bias + c)).sum() - xy[i]
            w[i] += rate * delta(g, xx[i, i], w[i])
        for k in range(len(found)):
            g = s[k] @ w + n_c[k] * (base + bias + c[k]) - y_c[k]
            c[k] += rate * delta(g, n_c[k], c[k])
    bins = Bins(tuple(features), tuple(() for _ in features), category, tuple(r[0] for r in found))
    return Booster(bins, base, params, [], (float(bias), tuple(map(float, w)), tuple(map(float, c))))


# ---------------------------------------------------------------- searches


def with_folds(folds: DataFrame, keys=("familia", "week_start")) -> DataFrame:
    """Rows of :func:`split.expanding_folds` as one row a key with the arrays ``train_folds`` and ``test_folds``."""
    rest = [c for c in folds.columns if c not in (*keys, "fold", "role")]
    pick = lambda role: F.sort_array(F.collect_list(F.when(F.col("role") == role, F.col("fold").cast("int"))))
    return folds.groupBy(*keys).agg(*[F.first(c).alias(c) for c in rest], pick("train").alias("train_folds"), pick("test").alias("test_folds"))


def errors(rows: DataFrame, sets: list[Params], folds: int, features, category: str = "familia", keys=("familia", "week_start"), broadcast_bytes: int = BROADCAST_BYTES, bins=None, table=None) -> list[list[float]]:
    """Test MAE of each parameter set on each fold; sets that differ in the number of trees alone share a fit."""
    bins = bins or make_bins(rows, features, category)
    table = table if table is not None else blocks(rows, bins, folds, keys)
    chains: dict[Params, set[int]] = {}
    for p in sets:
        chains.setdefault(replace(p, n_estimators=0), set()).add(p.n_estimators)
    jobs, of = [], {}
    for chain, counts in chains.items():
        for fold in range(folds):
            of[chain, fold] = len(jobs)
            jobs.append((len(jobs), replace(chain, n_estimators=max(counts)), fold, tuple(sorted(counts))))
    done = _fits(table, jobs, _means(rows, folds), bins.offsets, broadcast_bytes)
    out = []
    for p in sets:
        own = [done[of[replace(p, n_estimators=0), fold]].errors[p.n_estimators] for fold in range(folds)]
        out.append([miss / n if n else None for miss, n in own])
    return out


# The reference's grid.
GRID = {"n_estimators": [100, 200], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.1, 0.2], "subsample": [0.8, 1.0], "colsample_bytree": [0.8, 1.0]}


def grid_search(folds: DataFrame, grid: dict = GRID, features=None, n_splits: int = 5, **how) -> DataFrame:
    """M4: mean test MAE of every combination over the expanding folds, best first (rank, parameters, n_folds, mean_mae, std_mae)."""
    from .learn import feature_columns, param_grid

    sets = [Params(**c) for c in param_grid(grid)]
    rows = with_folds(folds)
    path = store.new_location(folds.sparkSession, "boost-folds")
    store.write_table(rows, path)
    rows = folds.sparkSession.read.schema(rows.schema).parquet(path)
    features = list(features or feature_columns(folds))
    found = errors(rows, sets, n_splits, features, **how)
    names = list(grid)
    table = []
    for p, maes in zip(sets, found):
        own = [m for m in maes if m is not None]
        table.append((*[float(getattr(p, c)) for c in names], len(own), float(np.mean(own)), float(np.std(own))))
    table.sort(key=lambda r: (r[-2], r[: len(names)]))
    ddl = ", ".join(f"{c} double" for c in names)
    return folds.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(table, 1)], f"rank int, {ddl}, n_folds int, mean_mae double, std_mae double")


# The reference's search ranges (log: drawn by logarithm).
RANGES = {
    "booster": ("gbtree", "gblinear", "dart"), "reg_lambda": (1e-8, 1.0, "log"), "reg_alpha": (1e-8, 1.0, "log"), "subsample": (0.2, 1.0),
    "colsample_bytree": (0.2, 1.0), "n_estimators": (50, 300, "int"), "max_depth": (2, 10, "int"), "learning_rate": (0.01, 0.3),
}


class Parzen:
    """Model-based draws: each parameter from the kernel density of the good trials, chosen by its ratio to that of the others."""

    def __init__(self, ranges: dict, seed: int = 42, startup: int = 10, candidates: int = 24):
        self.ranges, self.rng, self.startup, self.candidates = ranges, np.random.default_rng(seed), startup, candidates
        self.trials: list[tuple[dict, float]] = []

    def _unit(self, name: str, v) -> float:
        lo, hi, *kind = self.ranges[name]
        return (np.log(v) - np.log(lo)) / (np.log(hi) - np.log(lo)) if kind == ["log"] else (v - lo) / (hi - lo)

    def _value(self, name: str, u: float):
        lo, hi, *kind = self.ranges[name]
        v = float(np.exp(np.log(lo) + u * (np.log(hi) - np.log(lo)))) if kind == ["log"] else lo + u * (hi - lo)
        return int(min(hi, max(lo, round(v)))) if kind == ["int"] else float(min(hi, max(lo, v)))

    def _density(self, u: np.ndarray, centres: np.ndarray) -> np.ndarray:
        """Mixture of one wide kernel and one kernel per trial."""
        mid = np.concatenate([[0.5], centres])
        width = np.concatenate([[1.0], np.full(len(centres), max(0.08, 1.0 / (1 + len(centres))))])
        return (np.exp(-0.5 * ((u[:, None] - mid) / width) ** 2) / width).mean(axis=1)

    def draw(self) -> dict:
        ranked = sorted(self.trials, key=lambda t: t[1])
        good, rest = ranked[: max(1, -(-len(ranked) // 5))], ranked[max(1, -(-len(ranked) // 5)) :]
        out = {}
        for name, r in self.ranges.items():
            categorical = isinstance(r[0], str)
            if len(ranked) < self.startup:
                out[name] = str(self.rng.choice(r)) if categorical else self._value(name, self.rng.random())
            elif categorical:
                share = lambda own: np.array([1.0 + sum(t[name] == c for t, _ in own) for c in r]) / (len(r) + len(own))
                ratio = share(good) / share(rest)
                drawn = self.rng.choice(len(r), self.candidates, p=share(good))
                out[name] = r[int(drawn[np.argmax(ratio[drawn])])]
            else:
                centres, others = (np.array([self._unit(name, t[name]) for t, _ in own]) for own in (good, rest))
                pick = self.rng.integers(-1, len(centres), self.candidates)
                width = max(0.08, 1.0 / (1 + len(centres)))
                u = np.where(pick < 0, self.rng.random(self.candidates), self.rng.normal(centres[pick], width))
                u = np.abs(u)
                u = np.clip(np.where(u > 1, 2 - u, u), 0, 1)
                out[name] = self._value(name, float(u[np.argmax(self._density(u, centres) / self._density(u, others))]))
        return out

    def tell(self, params: dict, error: float) -> None:
        self.trials.append((params, error))


def tpe_search(train: DataFrame, n_trials: int = 30, at_once: int = 5, features=None, ranges: dict = RANGES, seed: int = 42, valid_share: float = 0.2, category: str = "familia", order_col: str = "week_start", **how) -> DataFrame:
    """M5: model-based search, scored on the last ``valid_share`` of each family's train weeks; ``at_once`` trials are fitted together.

    Rows (trial, parameters, mae, rank).  The same seed gives the same trials.
    """
    from pyspark.sql import Window

    from .learn import feature_columns

    spark = train.sparkSession
    features = list(features or feature_columns(train))
    pos = F.row_number().over(Window.partitionBy(category).orderBy(order_col)) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy(category))
    inner = pos < F.floor(n * (1 - valid_share))
    zero, none = F.array(F.lit(0)), F.array().cast("array<int>")
    rows = train.withColumn("_inner", inner).withColumns({"train_folds": F.when(F.col("_inner"), zero).otherwise(none), "test_folds": F.when(F.col("_inner"), none).otherwise(zero)})
    path = store.new_location(spark, "boost-search")
    store.write_table(rows, path)
    rows = spark.read.schema(rows.schema).parquet(path)
    fit_rows, valid = rows.where("_inner"), rows.where("not _inner")
    bins = make_bins(rows, features, category)
    table = blocks(rows, bins, 1, (category, order_col))
    search, found = Parzen(ranges, seed), []
    while len(found) < n_trials:
        some = min(n_trials - len(found), at_once if len(found) >= search.startup else search.startup)
        drawn = [search.draw() for _ in range(some)]
        sets = [Params(**d) for d in drawn]
        trees = [replace(p, booster="gbtree") for p in sets if p.booster != "gblinear"]
        by_trees = iter(errors(rows, trees, 1, features, category, (category, order_col), bins=bins, table=table, **how) if trees else [])
        for d, p in zip(drawn, sets):
            if p.booster == "gblinear":
                scored = score(fit_linear(fit_rows, p, features, category), valid, (category, order_col))
                mae = scored.agg(F.avg(F.abs(F.col("actual") - F.col("predicted")))).first()[0]
            else:
                mae = next(by_trees)[0]
            found.append((len(found), d, mae))
        for _, d, mae in found[-some:]:
            search.tell(d, mae)
    order = {t: i for i, (t, _, _) in enumerate(sorted(found, key=lambda r: (r[2], r[0])), 1)}
    names = list(ranges)
    kind = {n: "string" if isinstance(r[0], str) else "int" if r[2:] == ("int",) else "double" for n, r in ranges.items()}
    ddl = ", ".join(f"{n} {kind[n]}" for n in names)
    return spark.createDataFrame([(t, order[t], *[d[n] for n in names], float(mae)) for t, d, mae in found], f"trial int, rank int, {ddl}, mae double")
