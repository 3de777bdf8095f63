"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm import tokens
from tidegate.llm.components import connected_components
from tidegate.session import arrow_rows, give_back, materialise, scratch_path, ship_package

#: Counters of the frequency sketch; its one byte each (a frequency class) is what gets broadcast.
#: They blur the order of grams, not the result, once there are many more grams than counters.
SKETCH_BITS = 24
_BLOCK_BITS = 14
#: Blocks of counters are mostly small numbers: tasks hand them on packed.
_PACK = "zstd"
#: Ranges of gram hashes whose counts the suffix filter compares.
RANGES = 64
#: Postings of a gram per list, before it is dealt out to several lists.
LIST_ROWS = 100_000
#: Sets that a task remembers in order not to list equal sets twice.
REMEMBERED = 500_000
#: Texts, or blocks of counters, that a Python worker holds at once.
BATCH_ROWS = 512

_PROFILE = "block int, counts binary, id bigint, n bigint, digest bigint, digest2 bigint"


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    similar: tuple[int, int] = (80, 100),
) -> DataFrame:
    """``(id_col, n_shingles, component_id)`` for each row of ``docs``.

    Words are runs of anything but white space in the text with A-Z lower-cased; a document's set
    holds its distinct runs of ``n`` words, or its whole sequence where it has fewer. Two
    documents link when ``similar[1] * |A & B| >= similar[0] * |A | B|``; ``component_id`` is the
    smallest id reachable over links. Links are exact up to collisions of 64-bit hashes.

    Defined cases: null, empty and blank texts have no shingles and link with nothing; equal sets
    link; rows that share an id are one document, which links by any of its texts and has one
    component, so equal texts of other documents meet in it; a row with a null id gets the component of the documents with an equal set, or null if there are none: it
    is not compared with other sets. Other columns are ignored, whatever their names.

    How it runs. (1) One pass writes a profile per row and counts all grams in a sketch of fixed
    size. (2) A second pass lists, for each distinct set, its rarest grams: any linked pair shares
    one of them. Lists of one set are dropped. (3) Rows of a list are compared with one pivot of
    the list, then, where a list still joins several components, with its best linked member, and
    in the end every remaining pair from different components of a list is compared. Pairs within
    a component need no comparison, so a group of near copies costs its size and not its square;
    nor are their links counted.
    """
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return _components(docs, id_col, text_col, n, similar)


def _components(
    docs: DataFrame, id_col: str, text_col: str, n: int, similar: tuple[int, int]
) -> DataFrame:
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    scanned = materialise(rows.mapInArrow(give_back(_profiles(n)), _PROFILE), "ngram-profiles")
    profiles = scanned.filter("block IS NULL").drop("block", "counts")
    classes = materialise(
        profiles.filter("n > 0")
        .groupBy("digest", "digest2", "n")
        .agg(F.min("id").alias("node"))
        .filter("node IS NOT NULL"),
        "ngram-classes",
    )
    order = spark.sparkContext.broadcast(_frequency_classes(scanned.filter("block IS NOT NULL")))
    postings = materialise(_lists(rows, classes, order, n, similar), "ngram-lists")
    sets, table = _sets(rows, postings, n)

    def test(pairs: DataFrame, label: str) -> DataFrame:
        return materialise(_verify(_suffix_filter(pairs, sets, similar), sets, similar), label)

    # Stars around the member with the fewest rarer grams, mostly the origin of its copies; equals
    # are ordered alike in all lists.
    first = F.struct("pos", F.xxhash64("node"))
    tested = test(_stars(postings, first, similar), "ngram-star1")
    links = tested.filter("linked")
    groups = materialise(connected_components(links), "ngram-groups1")
    # Stars around the member with most links, in lists that still join several components.
    degrees = (
        links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(
            F.count(F.lit(1)).alias("degree")
        )
    )
    rest = _open_lists(postings, groups).join(degrees, "node", "left")
    best = F.struct(-F.coalesce("degree", F.lit(0)), F.xxhash64("node"))
    pairs = _stars(rest, best, similar).join(tested, ["a", "b"], "left_anti")
    tested2 = test(pairs, "ngram-star2")
    links = links.unionByName(tested2.filter("linked"))
    groups = materialise(connected_components(links), "ngram-groups2")
    # All pairs that are left between components.
    rest = materialise(_open_lists(postings, groups), "ngram-open")
    done = tested.unionByName(tested2)
    pairs = _cross_pairs(rest, similar).join(done, ["a", "b"], "left_anti")
    tested3 = test(pairs, "ngram-cross")
    links = links.unionByName(tested3.filter("linked"))
    spark.sql(f"DROP TABLE {table}")
    ties = _ties(profiles, classes)
    groups = materialise(
        connected_components(links.select("a", "b").unionByName(ties)), "ngram-groups"
    )
    member = classes.join(groups, "node", "left").select(
        "digest", "digest2", "n", F.coalesce("component", "node").alias("component")
    )
    key = ["digest", "digest2", "n"]
    worded = profiles.filter("n > 0").join(member, key, "left").select("id", "n", "component")
    # A text without words belongs with the other texts of its id, if there are any.
    blank = profiles.filter("n = 0").join(groups, F.col("id") == F.col("node"), "left")
    out = worded.unionByName(blank.select("id", "n", "component"))
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )


def _ties(profiles: DataFrame, classes: DataFrame) -> DataFrame:
    """``(a, b)``: an id that stands on different sets, with the node of each of them."""
    sizes = F.struct("n", "digest", "digest2")
    several = (
        profiles.filter("id IS NOT NULL")
        .groupBy("id")
        .agg(F.min(sizes).alias("low"), F.max(sizes).alias("high"))
        .filter("low <> high")
        .select("id")
    )
    held = profiles.filter("n > 0").join(several, "id", "left_semi")
    tied = held.join(classes, ["digest", "digest2", "n"])
    return tied.filter("id <> node").select(F.col("id").alias("a"), F.col("node").alias("b")).distinct()


def keep_one(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is the smallest of its component; rows without an id stay."""
    dropped = groups.filter(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    return docs.join(dropped, id_col, "left_anti")


def _need(left: Column, right: Column, similar: tuple[int, int]) -> Column:
    """Grams that linked sets of these sizes share at least."""
    num, den = similar
    return F.ceil(F.lit(num) * (left + right) / F.lit(num + den))


def batch_sets(
    texts: pa.Array, n: int
) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct gram hashes of each text."""
    data, offsets = tokens.string_bytes(texts)
    hashes, row, _ = tokens.words(data, offsets, _ALPHABET)
    bounds = np.searchsorted(row, np.arange(len(offsets)))
    runs = tokens.ngrams(hashes, n)
    for i in range(len(offsets) - 1):
        start, end = bounds[i], bounds[i + 1]
        if end - start >= n:
            grams = np.sort(runs[start : end - n + 1])
            new = np.empty(grams.size, bool)
            new[0] = True
            np.not_equal(grams[1:], grams[:-1], out=new[1:])
            yield i, grams[new]
        elif end > start:
            yield i, np.array([tokens.sequence_hash(hashes[start:end])], np.uint64)
        else:
            yield i, np.zeros(0, np.uint64)


_ALPHABET = tokens.whitespace_alphabet()


def _digests(grams: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        one = tokens.mix(grams + np.uint64(0x51ED270B)).sum(dtype=np.uint64)
        two = tokens.mix(grams ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def _small(batch: pa.RecordBatch, rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def _profiles(n: int) -> Callable:
    """Profile of each row, and at the end of a task its gram counts in blocks of counters.

    A task's count of one counter stops at 255: the order of grams needs no more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "counts", "id", "n", "digest", "digest2"]
        counts = np.zeros(1 << SKETCH_BITS, np.uint8)
        for batch in (part for whole in batches for part in _small(whole)):
            size, one, two, seen = [], [], [], []
            for _, grams in batch_sets(batch.column(1), n):
                left, right = _digests(grams)
                size.append(grams.size)
                one.append(left)
                two.append(right)
                seen.append(grams)
            bucket, more = np.unique(
                np.concatenate(seen) >> np.uint64(64 - SKETCH_BITS), return_counts=True
            )
            bucket = bucket.astype(np.int64)
            counts[bucket] = np.minimum(counts[bucket] + more, 255)
            rows = batch.num_rows
            own = [batch.column(0), *(pa.array(x, pa.int64()) for x in (size, one, two))]
            yield pa.record_batch([pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()), *own], names)
        parts = counts.reshape(-1, 1 << _BLOCK_BITS)
        for block in np.flatnonzero(parts.any(axis=1)).tolist():
            packed = pa.compress(parts[block].tobytes(), _PACK, asbytes=True)
            head = [pa.array([block], pa.int32()), pa.array([packed])]
            yield pa.record_batch([*head, *(pa.nulls(1, pa.int64()) for _ in range(4))], names)

    return run


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            plain = pa.decompress(counts, 1 << _BLOCK_BITS, _PACK, asbytes=True)
            part = np.frombuffer(plain, np.uint8).astype(np.int64)
            total[block] = total[block] + part if block in total else part
    if total:
        classes = [
            np.minimum(255, 8 * np.log2(np.maximum(x, 1))).astype(np.uint8).tobytes()
            for x in total.values()
        ]
        yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array(classes)], ["block", "counts"])


def _frequency_classes(blocks: DataFrame) -> np.ndarray:
    """One byte for each counter: eight times the binary logarithm of its count.

    The size is fixed (16 MiB), whatever the input, so it may pass through the driver.
    """
    summed = (
        blocks.select("block", "counts")
        .repartition(64, "block")
        .mapInArrow(give_back(_sum_blocks), "block int, counts binary")
    )
    out = np.zeros((1 << (SKETCH_BITS - _BLOCK_BITS), 1 << _BLOCK_BITS), np.uint8)
    for row in summed.collect():
        out[row["block"]] = np.frombuffer(bytes(row["counts"]), np.uint8)
    return out.reshape(-1)


def _prefixes(order, n: int, similar: tuple[int, int]) -> Callable:
    """Rarest grams of each distinct set: enough of them that linked sets share one.

    ``place`` packs the size of the set, the gram's position in it and, for frequent grams, the
    number of lists (a power of two) that the gram is dealt out to.
    """
    num, den = similar

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = order.value
        seen: set[tuple[int, int]] = set()
        for batch in (part for whole in batches for part in _small(whole)):
            grams_out, keys, places = [], [], []
            for _, grams in batch_sets(batch.column(1), n):
                size = grams.size
                if not size:
                    continue
                key = _digests(grams)
                if key in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(key)
                length = size - -(-num * size // den) + 1
                level = classes[(grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                rank = (level.astype(np.uint64) << np.uint64(56)) | (grams >> np.uint64(8))
                chosen = np.argpartition(rank, length - 1)[:length]
                chosen = chosen[np.argsort(rank[chosen])]
                most = np.exp2((level[chosen].astype(np.float64) + 1) / 8)
                lists = np.ceil(np.log2(np.maximum(most / LIST_ROWS, 1))).astype(np.int64)
                grams_out.append(grams[chosen].view(np.int64))
                keys.append(np.full(length, key[0], np.int64))
                places.append((lists << 56) | (size << 28) | np.arange(length))
            if grams_out:
                yield pa.record_batch(
                    [pa.array(np.concatenate(x)) for x in (grams_out, keys, places)],
                    ["gram", "digest", "place"],
                )

    return run


def _lists(
    rows: DataFrame, classes: DataFrame, order, n: int, similar: tuple[int, int]
) -> DataFrame:
    """``(gram, node, n, pos)`` of grams that several sets list.

    A row stays only if its list has a set of a size that it could link with, by what the two can
    share from this gram on. Linked sets meet at one gram whose rows both pass.
    """
    num, den = similar
    listed = rows.select("id", "text").mapInArrow(
        give_back(_prefixes(order, n, similar)), "gram bigint, digest bigint, place bigint"
    )
    listed = listed.withColumn(
        "deal", F.expr("pmod(xxhash64(digest), shiftleft(1L, cast(shiftright(place, 56) AS int)))")
    )
    # Sets of other tasks may be equal.
    once = listed.repartition("gram", "deal").dropDuplicates(["gram", "deal", "digest", "place"])
    once = once.withColumn("size", F.expr("shiftright(place, 28) & 268435455"))
    # The nearest sizes tell: if these are too far off, or too large, so are all others. A dealt
    # gram's rows may have their partners in another list.
    nearest = Window.partitionBy("gram", "deal").orderBy("size", "digest")
    several = once.withColumns(
        {"below": F.lag("size").over(nearest), "above": F.lead("size").over(nearest)}
    ).filter(
        f"shiftright(place, 56) > 0 OR below * {den} >= size * {num} OR (size * {den} >= above * {num}"
        f" AND (size - (place & 268435455)) * {num + den} >= {num} * (size + above))"
    )
    return (
        several.join(classes.select("digest", "node"), "digest")
        .select(
            "gram",
            "node",
            F.expr("shiftright(place, 28) & 268435455").cast("int").alias("n"),
            F.expr("place & 268435455").cast("int").alias("pos"),
        )
        .distinct()
    )


def _sets(rows: DataFrame, postings: DataFrame, n: int) -> tuple[DataFrame, str]:
    """Table ``(node, grams, ranges)`` of the sets that are in a list, and its name.

    ``ranges`` counts a set's grams by hash range. The table is bucketed by node, below the shared
    folder: the joins that test pairs bring the pairs to the sets and never shuffle all sets.
    """
    spark = rows.sparkSession
    nodes = postings.select(F.col("node").alias("id")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _small(whole)):
            sets = [grams for _, grams in batch_sets(batch.column(1), n)]
            steps = np.concatenate([[0], np.cumsum([grams.size for grams in sets])])
            flat = np.concatenate(sets)
            place = np.repeat(np.arange(len(sets)), np.diff(steps)) * RANGES
            place += (flat >> np.uint64(64 - RANGES.bit_length() + 1)).astype(np.int64)
            ranges = np.bincount(place, minlength=len(sets) * RANGES)
            even = np.arange(len(sets) + 1) * RANGES
            lists = [
                pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))
                for at, values, kind in (
                    (steps, flat.view(np.int64), pa.int64()),
                    (even, ranges, pa.int32()),
                )
            ]
            yield pa.record_batch([batch.column(0), *lists], ["node", "grams", "ranges"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = rows.repartition(parts, "id").join(nodes, "id", "left_semi")
    made = wanted.select("id", "text").mapInArrow(
        give_back(run), "node bigint, grams array<bigint>, ranges array<int>"
    )
    path = scratch_path(spark, "ngram-sets")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    made.write.bucketBy(parts, "node").sortBy("node").option("path", path).saveAsTable(name)
    return spark.table(name), name


def _filtered(pairs: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Length and positional filters over joined list rows, then one row for each pair.

    At the rarest gram that two sets share they can share that one and what follows it in the
    smaller rest. A linked pair meets at that gram, so others need not pass.
    """
    num, den = similar
    kept = pairs.filter(
        f"n1 * {den} >= n2 * {num} AND n2 * {den} >= n1 * {num}"
        f" AND least(n1 - p1, n2 - p2) * {num + den} >= {num} * (n1 + n2)"
    )
    return kept.select(
        F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b")
    ).distinct()


def _stars(postings: DataFrame, first: Column, similar: tuple[int, int]) -> DataFrame:
    """Each list's members with the one that comes first by ``first``."""
    member = F.struct("node", "n", "pos")
    pivots = postings.groupBy("gram").agg(F.min_by(member, F.struct(first, "node")).alias("p"))
    joined = postings.join(pivots, "gram").filter("node <> p.node")
    return _filtered(
        joined.select(
            F.col("node").alias("node1"),
            F.col("n").alias("n1"),
            F.col("pos").alias("p1"),
            F.col("p.node").alias("node2"),
            F.col("p.n").alias("n2"),
            F.col("p.pos").alias("p2"),
        ),
        similar,
    )


def _open_lists(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of the lists that hold several components, with the component of each."""
    tagged = postings.join(groups, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    several = (
        tagged.groupBy("gram")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high")
        .select("gram")
    )
    return tagged.join(several, "gram", "left_semi")


def _cross_pairs(rows: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Pairs of a list's members from different components.

    The components of a list are paired first, so members of the same one never meet. The best
    position and the sizes of a component's members bound what any two of them can share.
    """
    num, den = similar
    parts = rows.groupBy("gram", "component").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.expr("n - pos")).alias("rest"),
    )
    one, two = (
        parts.select("gram", *(F.col(c).alias(f"{c}{i}") for c in parts.columns[1:])) for i in "12"
    )
    pairs = one.join(two, "gram").filter(
        f"component1 < component2 AND high1 * {den} >= low2 * {num} AND high2 * {den} >= low1 * {num}"
        f" AND least(rest1, rest2) * {num + den} >= {num} * (low1 + low2)"
    )
    pairs = pairs.select("gram", "component1", "component2", "low2", "high2", "rest2")
    left, right = (
        rows.select(
            "gram",
            *(
                F.col(c).alias(f"{short}{i}")
                for c, short in (
                    ("component", "component"), ("node", "node"), ("n", "n"), ("pos", "p"),
                )
            ),
        )
        for i in "12"
    )
    # Of the first component only members that the best of the second could link with go on.
    some = pairs.join(left, ["gram", "component1"]).filter(
        f"n1 * {den} >= low2 * {num} AND high2 * {den} >= n1 * {num}"
        f" AND least(n1 - p1, rest2) * {num + den} >= {num} * (n1 + low2)"
    )
    return _filtered(some.join(right, ["gram", "component2"]), similar)


def _suffix_filter(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Drop pairs whose gram counts by hash range already differ too much.

    The differences of the counts add up to no more than the grams that only one of the two sets
    has, and linked sets have at most ``|A| + |B| - 2 * need`` of those.
    """
    one = sets.select(F.col("node").alias("a"), F.col("ranges").alias("ranges1"))
    two = sets.select(F.col("node").alias("b"), F.col("ranges").alias("ranges2"))
    joined = pairs.join(one, "a").join(two, "b")
    total = lambda c: F.aggregate(c, F.lit(0), lambda s, x: s + x)
    apart = total(F.zip_with("ranges1", "ranges2", lambda x, y: F.abs(x - y)))
    n1, n2 = total("ranges1"), total("ranges2")
    return (
        joined.withColumns({"apart": apart, "n1": n1, "n2": n2})
        .filter(F.col("apart") <= F.col("n1") + F.col("n2") - 2 * _need(F.col("n1"), F.col("n2"), similar))
        .select("a", "b")
        .distinct()
    )


def _verify(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """``(a, b, linked)``: each pair's whole sets compared, once."""
    num, den = similar
    one = sets.select(F.col("node").alias("a"), F.col("grams").alias("grams1"))
    two = sets.select(F.col("node").alias("b"), F.col("grams").alias("grams2"))
    both = pairs.join(one, "a").join(two, "b")
    shared = F.size(F.array_intersect("grams1", "grams2"))
    union = F.size("grams1") + F.size("grams2") - shared
    return both.select("a", "b", (den * shared >= num * union).alias("linked"))
