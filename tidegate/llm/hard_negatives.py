"""Hard negatives of anchors, found through a tree of split points with distance ranges."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm import gnat, vectors
from tidegate.session import materialise, ship_package

#: Rows that the tree is fitted on at most (and bytes of their vectors), rows of a leaf aimed at,
#: rows of a tile, anchors of a block.
SAMPLE_ROWS, SAMPLE_BYTES = 8192, 1 << 25
LEAF_ROWS, TILE_ROWS, BLOCK_ROWS = 2048, 2048, 1024
#: Rows found that a task holds, besides twice those it keeps, before it looks for the best ones.
HELD = 1 << 16
_STRIP = 128
_OUT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def mine(
    rows: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    leaf_rows: int = LEAF_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Each component ``x`` becomes ``floor(scale * x)``; the score of two rows is the inner product of
    these integers. Anchors are the rows for which ``anchors`` holds. An anchor's positives are
    the ``positives`` best other rows of its label, higher scores first, ties by smaller id. For
    each of them the ``negatives`` best rows of other labels are returned whose score ``s`` lies in
    ``window``, per cent of the positive's score ``p``: ``window[0] * p <= 100 * s <=
    window[1] * p``, ranked from 1.

    Defined cases: rows with a null id or label, a null or empty vector, or null or non-finite
    components take no part; nor do rows of another length than most vectors have (the longer
    among equals), or with components so large that scores pass 2**53. Labels are integers. Repeated rows
    count each, as candidates and as anchors; a row is no positive of an anchor of the same id.
    Anchors without positives, and positives without negatives, have no rows; an empty table gives
    none. Other columns are ignored.

    How it runs. The tree is fitted on a bounded sample; every row is routed to its leaf, and the
    ranges are the extremes over all rows. Leaves are dealt into tiles of bounded size, anchors
    into blocks. The sample gives each anchor a score that its last positive reaches at least, and
    each window a floor likewise; the tree then names the leaves that can hold better rows. Only with
    the tiles of those an anchor is compared, and there all its scores are computed, so the result is
    exact. A task takes some blocks with one partition of tiles, both read from where they are written:
    nothing is shuffled for a pair of them. It keeps the best rows of each window alone, and the last of
    them is a higher floor for the tiles that follow.
    """
    spark = rows.sparkSession
    ship_package(spark)
    coded = _coded(rows, anchors, id_col, vector_col, label_col, scale)
    facts = coded.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("anchor").alias("anchors"),
        F.max(F.greatest(F.array_max("codes"), -F.array_min("codes"))).alias("largest"),
        F.max(F.size("codes")).alias("width"),
    ).first()
    if not facts["n"] or not facts["anchors"]:
        return spark.createDataFrame([], _OUT)
    kind = np.dtype("<i2" if facts["largest"] < 1 << 15 else "<i4")
    # No partial sum of a score passes this, so it is exact in single precision up to 2**24.
    exact = np.float32 if facts["largest"] ** 2 * facts["width"] < 1 << 24 else np.float64
    most = max(256, min(sample_rows, SAMPLE_BYTES // (8 * facts["width"])))
    taken = coded.sample(min(1.0, most / facts["n"]), seed=7).limit(2 * most).toArrow()
    sample = _Rows(
        taken["id"].to_numpy().astype(np.int64),
        taken["label"].to_numpy().astype(np.int64),
        _matrix(taken["codes"].combine_chunks(), facts["width"]),
    )
    tree = gnat.fit(sample.codes, facts["n"] / max(1, len(sample.ids)), leaf_rows)
    routed = materialise(_routed(coded, tree, kind, facts["width"]), "negatives-routed")
    tree = _measured(routed, tree, kind)
    tiles = _tiles(routed)
    blocks = _blocks(routed, facts["anchors"])
    shared = spark.sparkContext.broadcast((tree, sample, kind, exact))

    meet = partial(_meet, tiles=tiles, kind=kind, exact=exact)
    found = meet(blocks.mapInArrow(_seek_positives(shared, positives), _SOUGHT), k=positives, same=True)
    found = found.select("block", "at", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    best = Window.partitionBy("block", "at").orderBy(F.desc("positive_score"), "positive_id")
    chosen = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
    # A block has a bounded number of anchors, and each of them a bounded number of positives.
    wanted = chosen.groupBy("block").agg(
        F.collect_list(F.struct("at", "place", "positive_id", "positive_score")).alias("wanted")
    )
    # Dealt out, since each block is looked up in the sample and the tree.
    wanted = materialise(_dealt(blocks.join(wanted, "block"), facts["anchors"]), "negatives-windows")
    found = meet(wanted.mapInArrow(_seek_negatives(shared, negatives, window), _SOUGHT), k=negatives, same=False)
    best = Window.partitionBy("block", "at", "place").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    return ranked.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


class _Rows:
    """Ids, labels and codes (double, holding integers) of some rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, codes: np.ndarray):
        self.ids, self.labels, self.codes = ids, labels, codes


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def _packed(column: pa.Array, kind: np.dtype) -> np.ndarray:
    """Matrix from a binary column with one vector a row; no row has another length."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).astype(float).reshape(len(values), -1)


def _coded(rows, anchors, id_col, vector_col, label_col, scale) -> DataFrame:
    """``(id, label, anchor, codes)`` of the rows that take part."""
    chosen = rows.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.col(vector_col).alias("vector"),
    )
    fine = chosen.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & vectors.all_finite(F.col("vector")))
    width = vectors.common_length(fine, "vector")
    bound = int((2**53 / max(1, width)) ** 0.5) - 1
    fine = fine.filter((F.size("vector") == width) & vectors.codes_fit(F.col("vector"), scale, bound))
    codes = vectors.codes(F.col("vector"), scale).cast("array<int>")
    return materialise(fine.select("id", "label", "anchor", codes.alias("codes")), "negatives-codes")


def _routed(coded: DataFrame, tree: gnat.Tree, kind: np.dtype, width: int) -> DataFrame:
    """Every row with its leaf, and a number that deals the rows of any leaf out evenly."""
    shared = coded.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rng = np.random.default_rng(TaskContext.get().partitionId())
        for batch in batches:
            x = _matrix(batch.column(3), width)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * (width * kind.itemsize))
            data = pa.py_buffer(x.astype(kind).tobytes())
            codes = pa.Array.from_buffers(pa.binary(), len(x), [None, offsets.buffers()[1], data])
            yield pa.record_batch(
                [
                    pa.array(shared.value.route(x)),
                    pa.array(rng.integers(0, 1 << 62, len(x))),
                    *batch.columns[:3],
                    codes,
                ],
                ["leaf", "deal", "id", "label", "anchor", "codes"],
            )

    schema = "leaf bigint, deal bigint, id bigint, label bigint, anchor boolean, codes binary"
    return coded.select("id", "label", "anchor", "codes").mapInArrow(run, schema)


def _measured(routed: DataFrame, tree: gnat.Tree, kind: np.dtype) -> gnat.Tree:
    """The tree with ranges over all rows: extremes of each task, merged by Spark.

    Their number is that of the nodes times the square of a node's degree.
    """
    if not tree.nodes:
        return tree
    shared = routed.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import copy

        own = copy.deepcopy(shared.value)
        for batch in batches:
            own.measure(_packed(batch.column(0), kind))
        for at, node in enumerate(own.nodes):
            m = len(node.points)
            i, j = (a.ravel() for a in np.indices((m, m)))
            i = np.append(i, np.full(m, -1))  # squared lengths
            j = np.append(j, np.arange(m))
            low = np.append(node.low.ravel(), node.shortest)
            high = np.append(node.high.ravel(), node.longest)
            seen = high >= 0
            columns = (np.full(len(i), at)[seen], i[seen], j[seen], low[seen], high[seen])
            yield pa.record_batch([pa.array(c) for c in columns], ["node", "i", "j", "low", "high"])

    parts = routed.select("codes").mapInArrow(run, "node bigint, i bigint, j bigint, low double, high double")
    merged = parts.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    for at, i, j, low, high in merged.collect():
        node = tree.nodes[at]
        if i < 0:
            node.shortest[j], node.longest[j] = low, high
        else:
            node.low[i, j], node.high[i, j] = low, high
    return tree


def _tiles(routed: DataFrame) -> DataFrame:
    """Rows of each leaf packed into tiles, written once."""
    sizes = {r["leaf"]: r["count"] for r in routed.groupBy("leaf").count().collect()}
    parts = {leaf: -(-count // TILE_ROWS) for leaf, count in sizes.items()}
    # One row a leaf; leaves are no more than the rows the tree was fitted on.
    known = routed.sparkSession.createDataFrame(sorted(parts.items()), "leaf bigint, parts bigint")
    dealt = routed.join(F.broadcast(known), "leaf").select(
        "leaf", F.pmod("deal", "parts").alias("part"), "id", "label", "codes"
    )

    def pack(table: pa.Table) -> pa.Table:
        return pa.table(
            {
                "leaf": table["leaf"][:1],
                "tile_ids": [table["id"].to_numpy().astype(np.int64).tobytes()],
                "tile_labels": [table["label"].to_numpy().astype(np.int64).tobytes()],
                "tile_codes": [b"".join(table["codes"].to_pylist())],
            }
        )

    schema = "leaf bigint, tile_ids binary, tile_labels binary, tile_codes binary"
    packed = dealt.groupBy("leaf", "part").applyInArrow(pack, schema)
    return materialise(packed, "negatives-tiles", row_group_rows=1)


def _dealt(rows: DataFrame, anchors: int) -> DataFrame:
    """Rows dealt out by their block: they are few and short, and what is done with each is long."""
    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(min(-(-anchors // BLOCK_ROWS), tasks), "block")


def _blocks(routed: DataFrame, anchors: int) -> DataFrame:
    """Anchors packed into blocks, written once: an anchor is known by its block and place."""
    blocks = -(-anchors // BLOCK_ROWS)
    dealt = routed.filter("anchor").select(
        F.pmod("deal", F.lit(blocks).cast("bigint")).alias("block"), "id", "label", "codes"
    )

    def pack(table: pa.Table) -> pa.Table:
        return pa.table(
            {
                "block": table["block"][:1],
                "ids": [table["id"].to_numpy().astype(np.int64).tobytes()],
                "labels": [table["label"].to_numpy().astype(np.int64).tobytes()],
                "codes": [b"".join(table["codes"].to_pylist())],
            }
        )

    schema = "block bigint, ids binary, labels binary, codes binary"
    packed = _dealt(dealt, anchors).groupBy("block").applyInArrow(pack, schema)
    return materialise(packed, "negatives-anchors")


#: A block of anchors, and where to look. ``windows`` holds six longs for each window: its anchor's place in
#: the block, the positive's place, id and score, the least and greatest score; they are sorted by
#: anchor. ``reach`` has a row of bits for each of ``leaves``: whether an anchor needs that leaf.
_SOUGHT = (
    "block bigint, ids binary, labels binary, codes binary, windows binary, leaves array<bigint>, reach binary"
)
#: What a task found for a window.
_FOUND = (
    "block bigint, at int, place int, anchor_id bigint, positive_id bigint, positive_score bigint,"
    " id bigint, score bigint"
)


def _unpack(row: dict, prefix: str, kind: np.dtype) -> _Rows:
    ids = np.frombuffer(row[f"{prefix}ids"], np.int64)
    labels = np.frombuffer(row[f"{prefix}labels"], np.int64)
    codes = np.frombuffer(row[f"{prefix}codes"], kind).reshape(len(ids), -1)
    return _Rows(ids, labels, codes.astype(float))


def _sought(row: dict, mine: _Rows, windows: np.ndarray, low, high, tree: gnat.Tree) -> pa.RecordBatch:
    """The row of a block for :func:`_meet`; ``low`` and ``high`` are matrices of anchors and windows."""
    reached = tree.reach(mine.codes, low, high)
    bits = np.zeros((len(reached), len(mine.ids)), bool)
    for at, who in enumerate(reached.values()):
        bits[at, who] = True
    return pa.record_batch(
        [
            pa.array([row["block"]], pa.int64()),
            *(pa.array([row[c]], pa.binary()) for c in ("ids", "labels", "codes")),
            pa.array([windows.astype(np.int64).tobytes()], pa.binary()),
            pa.array([list(reached)], pa.list_(pa.int64())),
            pa.array([np.packbits(bits, axis=1).tobytes()], pa.binary()),
        ],
        ["block", "ids", "labels", "codes", "windows", "leaves", "reach"],
    )


def _meet(sought: DataFrame, tiles: DataFrame, kind: np.dtype, exact: type, k: int, same: bool) -> DataFrame:
    """The best ``k`` rows of each window among the tiles of a task, of the anchor's label or of others.

    The hint asks for pairs of partitions, whatever the size: so a block meets all tiles of a
    partition before the next block comes.
    """
    sought = materialise(sought, "negatives-sought", row_group_rows=1)
    paired = sought.crossJoin(tiles.hint("shuffle_replicate_nl")).filter("array_contains(leaves, leaf)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            for i in range(batch.num_rows):
                row = _Lazy(columns, i)
                if best is None or best.block != row["block"]:
                    if best is not None:
                        yield best.found()
                    best = _Best(row, kind, exact, k, same)
                best.meet(row["leaf"], _unpack(row, "tile_", kind))
        if best is not None:
            yield best.found()

    return materialise(paired.mapInArrow(run, _FOUND), "negatives-found")


class _Lazy:
    """A row of Arrow columns that makes Python values of those asked for."""

    def __init__(self, columns: dict[str, pa.Array], i: int):
        self.columns, self.i = columns, i

    def __getitem__(self, name: str):
        return self.columns[name][self.i].as_py()


class _Best:
    """The best rows so far within each window of a block's anchors."""

    def __init__(self, row, kind: np.dtype, exact: type, k: int, same: bool):
        self.block, self.k, self.same, self.exact = row["block"], k, same, exact
        self.mine = _unpack(row, "", kind)
        self.mine.codes = self.mine.codes.astype(exact)
        n, leaves = len(self.mine.ids), row["leaves"]
        bits = np.frombuffer(row["reach"], np.uint8).reshape(len(leaves), -1)
        self.reach = dict(zip(leaves, np.unpackbits(bits, axis=1, count=n).astype(bool)))
        self.windows = np.frombuffer(row["windows"], np.int64).reshape(-1, 6)
        # Exact too: bounds are no larger than scores, or a power of two.
        self.low, self.high = (self.windows[:, c].astype(exact) for c in (4, 5))
        self.first = np.searchsorted(self.windows[:, 0], np.arange(n))
        self.number = np.bincount(self.windows[:, 0], minlength=n)
        self.most = np.full(n, -np.inf, exact)
        np.maximum.at(self.most, self.windows[:, 0], self.high)
        none = np.zeros(0, np.int64)
        self.held, self.size = [(none, none, none)], 0
        self._raise()

    def _raise(self) -> None:
        """The least score that some window of an anchor still takes."""
        self.least = np.full(len(self.most), np.inf, self.exact)
        np.minimum.at(self.least, self.windows[:, 0], self.low)

    def meet(self, leaf: int, tile: _Rows) -> None:
        right = tile.codes.astype(self.exact).T
        who = np.flatnonzero(self.reach[leaf])
        for start in range(0, who.size, _STRIP):
            some = who[start : start + _STRIP]
            scores = self.mine.codes[some] @ right
            hits = np.flatnonzero((scores >= self.least[some, None]) & (scores <= self.most[some, None]))
            i, j = np.divmod(hits, scores.shape[1])
            i = some[i]
            fine = tile.labels[j] == self.mine.labels[i]
            fine = fine & (tile.ids[j] != self.mine.ids[i]) if self.same else ~fine
            i, j, score = i[fine], j[fine], scores.ravel()[hits[fine]]
            # Each of them once for each window of its anchor.
            number = self.number[i]
            at = np.repeat(np.arange(i.size), number)
            window = np.arange(at.size) + np.repeat(self.first[i] - (np.cumsum(number) - number), number)
            inside = (score[at] >= self.low[window]) & (score[at] <= self.high[window])
            at, window = at[inside], window[inside]
            self.held.append((window, tile.ids[j[at]], score[at].astype(np.int64)))
            self.size += at.size
            if self.size > 2 * len(self.windows) * self.k + HELD:
                self.fold()

    def fold(self) -> None:
        """Keep the best of each window; the last of them is its new floor."""
        window, ids, score = (np.concatenate(c) for c in zip(*self.held))
        order = np.lexsort((ids, -score, window))
        window, ids, score = window[order], ids[order], score[order]
        rank = np.arange(window.size) - np.searchsorted(window, window)
        last = rank == self.k - 1
        self.low[window[last]] = score[last]
        self._raise()
        kept = rank < self.k
        self.held, self.size = [(window[kept], ids[kept], score[kept])], int(kept.sum())

    def found(self) -> pa.RecordBatch:
        self.fold()
        window, ids, score = self.held[0]
        at, place, positive, positive_score = self.windows[window, :4].T
        columns = (np.full(len(at), self.block), at, place, self.mine.ids[at], positive, positive_score, ids, score)
        kinds = (c.split()[1] for c in _FOUND.split(", "))
        arrow = {"bigint": pa.int64(), "int": pa.int32()}
        names = [c.split()[0] for c in _FOUND.split(", ")]
        return pa.record_batch([pa.array(c, arrow[kind]) for c, kind in zip(columns, kinds)], names)


def _scores(mine: _Rows, others: _Rows, exact: type) -> Iterator[tuple[int, np.ndarray]]:
    """Anchor and its integer score with each of the other rows."""
    left, right = mine.codes.astype(exact), others.codes.astype(exact).T
    for start in range(0, len(mine.ids), _STRIP):
        for i, row in enumerate(left[start : start + _STRIP] @ right):
            yield start + i, row


def _floor(scores: np.ndarray, k: int) -> float:
    """The ``k``-th largest, or minus infinity if they are fewer."""
    return np.partition(scores, scores.size - k)[scores.size - k] if scores.size >= k else -np.inf


def _seek_positives(shared, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, sample, kind, exact = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                mine = _unpack(row, "", kind)
                low = np.full((len(mine.ids), 1), -np.inf)
                for i, scores in _scores(mine, sample, exact):
                    same = (sample.labels == mine.labels[i]) & (sample.ids != mine.ids[i])
                    low[i] = _floor(scores[same], k)
                # One window for each anchor, open above.
                windows = np.zeros((len(low), 6), np.int64)
                windows[:, 0] = np.arange(len(low))
                windows[:, 4], windows[:, 5] = np.maximum(low[:, 0], -(2.0**62)), 1 << 62
                yield _sought(row, mine, windows, low, np.full(low.shape, np.inf), tree)

    return run


def _seek_negatives(shared, k: int, window: tuple[int, int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, sample, kind, exact = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                mine = _unpack(row, "", kind)
                fields = ("at", "place", "positive_id", "positive_score")
                wanted = np.array([[w[f] for f in fields] for w in row["wanted"]], np.int64)
                wanted = wanted[np.lexsort((wanted[:, 1], wanted[:, 0]))]
                score = wanted[:, 3]
                windows = np.column_stack([wanted, -((-window[0] * score) // 100), (window[1] * score) // 100])
                of = [np.flatnonzero(windows[:, 0] == i) for i in range(len(mine.ids))]
                width = max(map(len, of))
                low, high = np.full((len(of), width), np.inf), np.full((len(of), width), -np.inf)
                for i, scores in _scores(mine, sample, exact):
                    other = scores[sample.labels != mine.labels[i]]
                    for w, at in enumerate(of[i]):
                        inside = other[(other >= windows[at, 4]) & (other <= windows[at, 5])]
                        if inside.size >= k:
                            windows[at, 4] = _floor(inside, k)
                        low[i, w], high[i, w] = windows[at, 4:]
                yield _sought(row, mine, windows, low, high, tree)

    return run
