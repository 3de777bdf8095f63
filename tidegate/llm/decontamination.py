"""Benchmark decontamination: documents scanned for word windows of benchmark items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.sqltext import ascii_lower, unused, words
from tidegate.session import materialise

WINDOW = 10
#: Windows that the literal hash set holds at most.
SET_WINDOWS = 50_000
#: Hashes of windows (two longs each) that are broadcast at most, where there are more of them than that.
BROADCAST_CODES = 2_000_000

_SEPARATOR = " "


def _word_array(column: str) -> Column:
    return words(ascii_lower(F.col(column).cast("string")))


def benchmark_windows(
    items: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = WINDOW
) -> DataFrame:
    """``(item, size, window, code)``: distinct windows of each item, as text and as hash.

    A window is ``n`` consecutive words; an item of fewer words, but not none, is one window.
    """
    listed = items.select(F.col(id_col).cast("string").alias("item"), _word_array(text_col).alias("words"))
    listed = listed.filter(F.size("words") > 0).withColumn("size", F.least(F.size("words"), F.lit(n)))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)
    slices = F.transform(starts, lambda i: F.slice(F.col("words"), i, F.col("size")))
    return (
        listed.select("item", "size", F.explode(slices).alias("part"))
        .select(
            "item", "size", F.array_join("part", _SEPARATOR).alias("window"), F.xxhash64("part").alias("code")
        )
        .distinct()
    )


def _in_set(value: str, codes: list[int]) -> str:
    listed = (f"{code}L" if code > -(2**63) else f"{code + 1}L - 1L" for code in codes)
    return f"{value} IN ({', '.join(listed)})" if codes else "false"


def _starts(size: int, column: str) -> str:
    return f"IF(size({column}) >= {size}, sequence(1, size({column}) - {size} + 1), array())"


def _hits(sizes: dict[int, list[tuple[int, str]]], column: str = "words") -> str:
    """SQL for the places of a document's windows, ``array<struct<at, size, window>>``.

    The hash of each token window is looked up in the set; the words of those found are kept, so
    that they can be compared.
    """
    parts = []
    for size, known in sorted(sizes.items()):
        codes = sorted({code for code, _ in known})
        places = f"filter({_starts(size, column)}, i -> {_in_set(f'xxhash64(slice({column}, i, {size}))', codes)})"
        parts.append(
            f"transform({places}, i -> struct(i - 1 AS at, {size} AS size,"
            f" array_join(slice({column}, i, {size}), '{_SEPARATOR}') AS window))"
        )
    return f"concat({', '.join(parts)})" if parts else "cast(array() AS array<struct<at:int,size:int,window:string>>)"


def _all_windows(sizes: dict[int, list], text: bool, column: str = "words") -> str:
    """SQL for the hash of every window of a document, and with ``text`` its words."""
    words = f", array_join(slice({column}, i, {{size}}), '{_SEPARATOR}') AS window" if text else ""
    parts = [
        f"transform({_starts(size, column)}, i -> struct(i - 1 AS at, {size} AS size,"
        f" xxhash64(slice({column}, i, {size})) AS code{words.format(size=size)}))"
        for size in sorted(sizes)
    ]
    return f"concat({', '.join(parts)})"


def _bounded(table: DataFrame, most: int) -> DataFrame:
    """``table``, to be broadcast if it has at most ``most`` rows."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def _occurring(docs: DataFrame, text_col: str, windows: DataFrame, sizes: dict[int, list]) -> DataFrame:
    """Those of ``windows`` whose hash occurs in a document: far fewer, unless the corpus is made of benchmarks.

    Only hashes of the documents' windows meet the benchmark's; no text is written or shuffled.
    """
    codes = docs.select(F.explode(F.array(_word_array(text_col))).alias("words"))
    codes = codes.select(F.expr(f"inline({_all_windows(sizes, False)})")).select("size", "code")
    known = windows.select("size", "code").distinct()
    seen = codes.join(_bounded(known, BROADCAST_CODES), ["size", "code"], "left_semi").distinct()
    return windows.join(seen, ["size", "code"], "left_semi").select(*windows.columns)


def _window_places(rows: DataFrame, windows: DataFrame, sizes: dict[int, list]) -> DataFrame:
    """``(row, at, size, window)`` of the windows of ``rows(row, words)`` that have a hash among ``windows``."""
    places = rows.select("row", F.expr(f"inline({_all_windows(sizes, True)})"))
    known = windows.select("size", "code").distinct()
    return places.join(_bounded(known, BROADCAST_CODES), ["size", "code"], "left_semi").drop("code")


def _window_set(windows: DataFrame, limit: int) -> tuple[dict[int, list], bool]:
    """Windows by size, and whether all of them fit the bound of the broadcast set."""
    sizes = [row["size"] for row in windows.select("size").distinct().collect()]  # at most WINDOW
    some = windows.select("size", "code", "window").distinct().limit(limit + 1).collect()
    if len(some) > limit:
        return {size: [] for size in sizes}, False
    out: dict[int, list] = {size: [] for size in sizes}
    for row in some:
        out[row["size"]].append((row["code"], row["window"]))
    return out, True


def _benchmark(
    docs: DataFrame, items: DataFrame, text_col: str, item_id: str, item_text: str, n: int, limit: int
) -> tuple[DataFrame, dict[int, list], bool]:
    """Benchmark windows, those of the set by size, and whether the set holds all that can hit."""
    windows = materialise(benchmark_windows(items, item_id, item_text, n), "benchmark-windows")
    sizes, bounded = _window_set(windows, limit)
    if not bounded:
        windows = materialise(_occurring(docs, text_col, windows, sizes), "benchmark-occurring")
        sizes, bounded = _window_set(windows, limit)
    return windows, sizes, bounded


def scan(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = WINDOW,
    set_windows: int = SET_WINDOWS,
) -> DataFrame:
    """``(id_col, n_words, n_hit, n_items, items array<string>, contaminated)`` per row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of a benchmark window, ``items`` are the
    items with an occurring window, sorted as strings. Null texts have no words; null item ids
    are counted in no list, though their windows hit. Ids may be null or repeat, rows are kept one
    for one; other columns are ignored.

    One pass looks up the hash of every token window in a literal hash set of benchmark windows
    and keeps the words of the hits; those are compared with the windows themselves in a join of
    the few that remain. No text is shuffled. With more than ``set_windows`` distinct windows, a
    pass over hashes alone first finds those that occur in the documents, and the set holds these. Only
    if they are too many as well does the join find the hits: on hashes, broadcast up to
    ``BROADCAST_CODES``, and the words of those that match are compared as before.
    """
    windows, sizes, bounded = _benchmark(docs, items, text_col, item_id, item_text, n, set_windows)
    # From a generator, so that the optimizer does not split the text anew for each window.
    split = F.explode(F.array(_word_array(text_col))).alias("words")
    scanned = docs.select(F.col(id_col).alias("id"), split).select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        F.size("words").cast("bigint").alias("n_words"),
        F.expr(_hits(sizes)).alias("hits") if bounded else F.col("words"),
    )
    scanned = materialise(scanned, "decontamination-rows")
    if bounded:
        places = scanned.select("row", F.inline("hits"))
    else:
        places = materialise(_window_places(scanned, windows, sizes), "decontamination-hits")
    known = windows.select("window", "size").distinct()
    listed = windows.select("window", "size", "item")
    if bounded:
        # At most ``set_windows`` windows of ``n`` words.
        known = F.broadcast(known)
        # Items that share their wording have few windows and many rows.
        if listed.limit(set_windows + 1).count() <= set_windows:
            listed = F.broadcast(listed)
    places = places.join(known, ["window", "size"], "left_semi")
    matched = (
        places.select("row", "window", "size").distinct().join(listed, ["window", "size"])
        .groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    covered = places.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("at", "size"))).alias("hits"))
    covered = covered.select("row", _covered("hits").alias("n_hit"))
    found = scanned.select("row", "id", "n_words").join(covered, "row", "left").join(matched, "row", "left")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items_of).cast("bigint").alias("n_items"),
        items_of.alias("items"),
        (n_hit > 0).alias("contaminated"),
    )


def _covered(hits: str) -> Column:
    """Words inside any of the places, which are in order."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def step(state, hit):
        end = hit["at"] + hit["size"]
        more = F.greatest(end - F.greatest(hit["at"], state["end"]), F.lit(0))
        return F.struct(F.greatest(end, state["end"]).alias("end"), (state["n"] + more).alias("n"))

    return F.aggregate(hits, start, step, lambda state: state["n"])


def remove_documents(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = WINDOW,
    set_windows: int = SET_WINDOWS,
) -> DataFrame:
    """Rows of ``docs`` in which no benchmark window occurs, with all their columns.

    A narrow filter: hashes are looked up in the literal set, then the words of the hits in the
    set of window texts. With more than ``set_windows`` windows the sets hold those that occur in
    the documents; if these are too many as well, the rows are numbered and the hits joined, as in
    :func:`scan`. Columns of ``docs`` may have any names.
    """
    windows, sizes, bounded = _benchmark(docs, items, text_col, item_id, item_text, n, set_windows)
    if not sizes:
        return docs
    if bounded:
        texts = sorted({text for known in sizes.values() for _, text in known})
        inside = ", ".join(f"'{text}'" for text in texts)
        # From a generator, so that the optimizer does not split the text anew for each window.
        found = unused(docs.columns, "__words")
        probe = docs.select("*", F.explode(F.array(_word_array(text_col))).alias(found))
        hits = _hits(sizes, found)
        clean = probe.filter(f"NOT exists({hits}, h -> h.window IN ({inside}))")
        return clean.drop(found)
    row = unused(docs.columns, "__row")
    numbered = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    split = F.explode(F.array(_word_array(text_col))).alias("words")
    places = _window_places(numbered.select(F.col(row).alias("row"), split), windows, sizes)
    hit = places.join(windows.select("window", "size"), ["window", "size"], "left_semi")
    dirty = hit.select(F.col("row").alias(row)).distinct()
    return numbered.join(dirty, row, "left_anti").drop(row)
