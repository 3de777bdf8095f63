"""Near-duplicate vectors by int8 tile products with rigorous error bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tidegate.llm.components import connected_components
from tidegate.session import materialise, ship_package

#: Distinct vectors per tile.
TILE = 4096
#: Rounding slack of the single and double precision sums, far above what they can lose.
SLACK = 1e-6
#: Counts and edges that a task holds before it hands some on.
HELD = 1 << 18


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    tile: int = TILE,
) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` for each row of ``vectors``.

    Two rows link when the cosine of their vectors, in double precision, is at least
    ``threshold``. ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest id reachable, ``kept`` tells whether it is the row's own.

    Defined cases: null, empty and zero vectors and those with null or non-finite components link
    with nothing; vectors of different length do not link; equal vectors link with each other (if
    the threshold is at most 1); rows with a null id are not linked and get a null component.
    Rows that share an id and a vector count as two rows; rows that share an id alone are one node,
    with the links of both vectors. Other columns are ignored.

    How it runs. Equal vectors become one class with a count. Classes are packed into tiles of
    ``tile`` vectors at most, written once. A task takes one partition of tiles with another, read
    from where they are written: no pair of tiles is ever shuffled or written, so disk grows with
    the rows, not with their square. Of each pair of tiles a product of the vectors' int8 codes
    bounds every cosine from above, and only pairs whose bound reaches the threshold are computed
    in double precision. A task returns a count per vector and a forest of the links it found, so a
    large group of near copies gives rows in proportion to its size. The work grows with the square
    of the number of distinct vectors, in independent pieces of one bounded size.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    kind = vectors.schema[vector_col].dataType
    # Single precision stays as it is: it takes half the bytes, and doubles of it are the same numbers.
    element = "float" if getattr(kind, "elementType", None) == FloatType() else "double"
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(vector_col).cast(f"array<{element}>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(F.col("id").isNotNull() & finite & some, F.lit(False))
    zero = F.lit(0.0).cast(element)  # added, it makes one number of both zeros
    key = F.unhex(F.sha2(F.to_json(F.struct(F.transform("vector", lambda x: x + zero))), 256))
    rows = rows.withColumn("key", F.when(usable, key))
    keyed = materialise(rows.select("id", "key"), "vector-keys")
    of_class = (F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"))
    classes = materialise(keyed.filter("key IS NOT NULL").groupBy("key").agg(*of_class), "vector-classes")
    whole = rows.filter("key IS NOT NULL").groupBy("key").agg(*of_class, F.first("vector").alias("vector"))
    tiles = materialise(_tiles(whole, tile, classes.count()), "vector-tiles", row_group_rows=1)
    found = materialise(_compare(tiles, threshold), "vector-links")
    counts = found.filter("other IS NULL").groupBy("node").agg(F.sum("n").alias("n"))
    forest = found.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))
    groups = connected_components(forest, "vector-groups")
    member = (
        classes.join(counts, "node", "left")
        .join(groups, "node", "left")
        .select(
            "key",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    out = keyed.join(member, "key", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )


def _tiles(classes: DataFrame, tile: int, number: int) -> DataFrame:
    """Classes packed into tiles: one row per tile with its vectors as bytes.

    ``number`` is that of the classes. A tile has at most ``tile`` vectors, all of one length. Each
    task packs what it holds of the aggregate, in few enough tasks that most tiles are full.
    """
    kind = "<f4" if classes.schema["vector"].dataType.elementType == FloatType() else "<f8"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made, waiting = TaskContext.get().partitionId(), 0, {}

        def packed(dim: int) -> pa.RecordBatch:
            nonlocal made
            made += 1
            node, copies, flat = (np.concatenate(c) for c in zip(*waiting.pop(dim)))
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "dim": dim,
                        "task": task,
                        "number": made,
                        "nodes": node.tobytes(),
                        "copies": copies.tobytes(),
                        "vectors": flat.tobytes(),
                    }
                ],
                pa.schema(
                    [("dim", pa.int32()), ("task", pa.int32()), ("number", pa.int64())]
                    + [(c, pa.binary()) for c in ("nodes", "copies", "vectors")]
                ),
            )

        for batch in batches:
            sizes = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes).tolist():
                mine = batch.filter(pa.array(sizes == dim))
                columns = (mine.column(0).to_numpy(), mine.column(1).to_numpy(), mine.column(2).flatten().to_numpy())
                node, copies, flat = (c.astype(k) for c, k in zip(columns, ("<i8", "<i8", kind)))
                at = 0
                while at < len(node):
                    held = waiting.setdefault(dim, [])
                    upto = min(len(node), at + tile - sum(len(h[0]) for h in held))
                    held.append((node[at:upto], copies[at:upto], flat[at * dim : upto * dim]))
                    at = upto
                    if sum(len(h[0]) for h in held) == tile:
                        yield packed(dim)
        for dim in sorted(waiting):
            yield packed(dim)

    few = classes.select("node", "copies", "vector").coalesce(max(1, number // (4 * tile)))
    return few.mapInArrow(pack, "dim int, task int, number bigint, nodes binary, copies binary, vectors binary")


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first: squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, their scale, the length of what rounding lost and the length that is left."""
    scale = np.abs(units).max(axis=1, keepdims=True) / 127
    codes = np.rint(units / scale).astype(np.int8)
    back = codes * scale
    lost = np.sqrt(((units - back) ** 2).sum(axis=1))
    return codes, scale[:, 0], lost, np.sqrt((back**2).sum(axis=1))


class _Tile:
    """Unit vectors, their decoded int8 codes in single precision, and what :func:`_quantise` says of them."""

    def __init__(self, units: np.ndarray):
        self.units = units
        codes, scale, self.lost, self.left = _quantise(units)
        self.decoded = (codes * scale[:, None]).astype(np.float32)


def _links(a: np.ndarray, b: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of linked pairs between two matrices of unit vectors."""
    return _tile_links(_Tile(a), _Tile(b), threshold)


def _tile_links(a: _Tile, b: _Tile, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of linked pairs between two tiles, in strips.

    |x.y - x'.y'| <= |x - x'| |y| + |x'| |y - y'| with x', y' the decoded vectors. The second part of
    that bound is one more term of the product, so a pair costs one comparison with a number of x.
    The product is rounded: by 2**-23 of the lengths at most for each of its terms, and some to spare.
    """
    dim = a.units.shape[1]
    left = np.concatenate([a.decoded, a.left[:, None].astype(np.float32)], axis=1)
    right = np.concatenate([b.decoded, b.lost[:, None].astype(np.float32)], axis=1).T
    longest = 2 * max(a.left.max(), 1) * max(np.sqrt(b.left**2 + b.lost**2).max(), 1)
    rest = threshold - SLACK - (dim + 8) * 2.0**-23 * longest - a.lost
    least = np.nextafter(rest.astype(np.float32), np.float32(-np.inf))
    for start in range(0, len(left), 128):
        strip = slice(start, start + 128)
        hits = np.flatnonzero(left[strip] @ right >= least[strip, None])
        for low in range(0, hits.size, 1 << 16):
            x, y = np.divmod(hits[low : low + (1 << 16)], right.shape[1])
            x += start
            linked = np.einsum("ij,ij->i", a.units[x], b.units[y]) >= threshold
            yield x[linked], y[linked]


def _forest(pairs: np.ndarray) -> np.ndarray:
    """A spanning forest of the pairs."""
    parent: dict[int, int] = {}
    kept = []
    for x, y in pairs.tolist():
        roots = []
        for at in (x, y):
            root = at
            while parent.setdefault(root, root) != root:
                root = parent[root]
            while parent[at] != root:
                parent[at], at = root, parent[at]
            roots.append(root)
        if roots[0] != roots[1]:
            parent[max(roots)] = min(roots)
            kept.append((x, y))
    return np.array(kept, np.int64).reshape(-1, 2)


def _compare(tiles: DataFrame, threshold: float) -> DataFrame:
    """Rows ``(node, other, n)``: links of a forest (``n`` null), or a number of links of a node.

    No equality tells the two sides apart, so Spark deals out pairs of partitions and reads both
    where they lie; an equality of lengths would make it shuffle by them. Either of two tiles may
    come first: which one does is settled so that any two partitions share their pairs evenly.
    """
    columns = ("dim", "task", "number", "nodes", "copies", "vectors")
    one, two = (tiles.select(*(F.col(c).alias(f"{c}{k}") for c in columns)) for k in (1, 2))
    same, before = (F.expr(f"struct(task1, number1) {sign} struct(task2, number2)") for sign in ("=", "<"))
    even = F.expr("(task1 + number1 + task2 + number2) % 2 = 0")
    paired = one.crossJoin(two).filter((F.expr("dim1 - dim2") == 0) & (same | (before == even)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, tile = _Held(), None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                # A tile of the first partition meets all of the second before the next one comes.
                if last != (row["task1"], row["number1"]):
                    last, tile = (row["task1"], row["number1"]), _Tile(_units(row, 1))
                _compare_tiles(row, tile, threshold, held)
                if held.size() > HELD:
                    held.fold()
                    if held.size() > HELD // 2:
                        yield held.flush()
        if held.size():
            held.fold()
            yield held.flush()

    fields = [f"{c}{k}" for k in (1, 2) for c in columns]
    return paired.select(same.alias("same"), *fields).mapInArrow(run, "node bigint, other bigint, n bigint")


class _Held:
    """Numbers of links by node and edges of a forest, from several pairs of tiles."""

    def __init__(self):
        self.nodes, self.counts, self.edges = [], [], []

    def add(self, nodes: np.ndarray, counts: np.ndarray) -> None:
        self.nodes.append(nodes[counts > 0])
        self.counts.append(counts[counts > 0])

    def size(self) -> int:
        return sum(map(len, self.nodes)) + sum(map(len, self.edges))

    def fold(self) -> None:
        """One count for each node, and a forest of all edges."""
        nodes, of = np.unique(np.concatenate([np.zeros(0, np.int64), *self.nodes]), return_inverse=True)
        counts = np.zeros(len(nodes), np.int64)
        np.add.at(counts, of, np.concatenate([np.zeros(0, np.int64), *self.counts]))
        edges = np.concatenate([np.zeros((0, 2), np.int64), *self.edges])
        self.nodes, self.counts, self.edges = [nodes], [counts], [_forest(edges) if len(self.edges) > 1 else edges]

    def flush(self) -> pa.RecordBatch:
        nodes, counts, edges = self.nodes[0], self.counts[0], self.edges[0]
        self.__init__()
        return pa.record_batch(
            [
                pa.array(np.concatenate([nodes, edges[:, 0]])),
                pa.concat_arrays([pa.nulls(len(nodes), pa.int64()), pa.array(edges[:, 1])]),
                pa.concat_arrays([pa.array(counts), pa.nulls(len(edges), pa.int64())]),
            ],
            ["node", "other", "n"],
        )


def _units(row: dict, side: int) -> np.ndarray:
    data, values = row[f"vectors{side}"], len(row[f"nodes{side}"]) // 8 * row[f"dim{side}"]
    return _unit(np.frombuffer(data, f"<f{len(data) // values}").reshape(-1, row[f"dim{side}"]).astype(float))


def _compare_tiles(row: dict, tile: _Tile, threshold: float, held: _Held) -> None:
    """Adds the links between the tiles of ``row``; ``tile`` is the first one."""
    node1, node2 = (np.frombuffer(row[c], np.int64) for c in ("nodes1", "nodes2"))
    copies1, copies2 = (np.frombuffer(row[c], np.int64) for c in ("copies1", "copies2"))
    count1, count2 = np.zeros(len(node1), np.int64), np.zeros(len(node2), np.int64)
    edges = np.zeros((0, 2), np.int64)
    for x, y in _tile_links(tile, tile if row["same"] else _Tile(_units(row, 2)), threshold):
        if row["same"]:
            x, y = x[x < y], y[x < y]
        np.add.at(count1, x, copies2[y])
        np.add.at(count2, y, copies1[x])
        if x.size:
            edges = _forest(np.concatenate([edges, np.stack([node1[x], node2[y]], axis=1)]))
    held.add(node1, count1)
    held.add(node2, count2)
    if len(edges):
        held.edges.append(edges)
