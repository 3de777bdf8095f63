"""Line dedup: content hashes of runs of lines find passages that repeat, whole runs are deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.sqltext import unused
from tidegate.session import materialise

#: Words of the shortest run that counts as a passage.
PASSAGE_WORDS = 50


def _key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """Id of a row, and a hash that tells rows of one id apart by their text."""
    own = F.col(id_col)
    return own, F.xxhash64(own.cast("string"), F.col(text_col).cast("string"))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc, sig, line, hash, words)`` of every line with a word; the text stays behind."""
    own, sig = _key(id_col, text_col)
    parts = docs.select(
        own.alias("doc"), sig.alias("sig"), F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("line", "part")
    )
    lines = parts.select(
        "doc",
        "sig",
        "line",
        F.xxhash64(F.btrim("part", F.lit(" \t\r"))).alias("hash"),
        F.regexp_count("part", F.lit(r"\S+")).alias("words"),
    ).filter("words > 0")
    # One shuffle serves the removal of repeated rows and all windows along a document.
    return lines.repartition("doc", "sig").dropDuplicates(["doc", "sig", "line"])


def _passages(lines: DataFrame, least: int) -> DataFrame:
    """Shortest runs of at least ``least`` words that start, and that end, at each line.

    ``content`` is the hash of the run's line hashes, ``anchor`` the smallest line hash, and the
    line that has it.
    """
    along = Window.partitionBy("doc", "sig").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    placed = lines.withColumn("stop", F.sum("words").over(along)).withColumn(
        "start", F.col("stop") - F.col("words")
    )
    # By word positions: the lines that start less than ``least`` words after this one ...
    ahead = Window.partitionBy("doc", "sig").orderBy("start").rangeBetween(0, least - 1)
    # ... or that end less than ``least`` words before this one does.
    back = Window.partitionBy("doc", "sig").orderBy("stop").rangeBetween(-(least - 1), 0)
    runs = []
    for over in (ahead, back):
        runs.append(
            placed.select(
                "doc",
                "sig",
                F.min("line").over(over).alias("first"),
                F.max("line").over(over).alias("last"),
                (F.max("stop").over(over) - F.min("start").over(over)).alias("total"),
                F.min(F.struct("hash", "line")).over(over).alias("anchor"),
                F.collect_list("hash").over(over).alias("hashes"),
            )
            .filter(F.col("total") >= least)
            .select(
                "doc",
                "sig",
                "first",
                "last",
                "anchor",
                F.xxhash64("hashes", F.size("hashes")).alias("content"),
            )
        )
    return runs[0].unionByName(runs[1])


def _place(*fields: str) -> Column:
    """Order of places: ids first to last, rows without an id behind them."""
    return F.struct(F.col("doc").isNull().alias("none"), *(F.col(f) for f in fields))


def repeated_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = PASSAGE_WORDS
) -> DataFrame:
    """``(doc, sig, runs array<struct<first, last>>)``: runs of lines to delete, merged and in order.

    A run of lines is deleted when it has ``least`` words or more and the same lines stand, in a
    run, at an earlier place (by document, then line) that does not overlap it. Lines are compared
    without outer white space; lines without a word take no part.

    The shortest runs of ``least`` words that start, and that end, at each line are grouped by a
    hash of their content; it is not compared with the lines. Those that match overlap each other
    along the document, which covers longer matches. Of equal content the first place is found by a
    partial aggregate: no list of places is gathered and no pairs are made. Equal runs have the same
    smallest line hash, so runs whose smallest hash stands at one place are left out before; that
    saves work and changes no row.
    """
    passages = materialise(_passages(_lines(docs, id_col, text_col), least), "line-passages")
    at = passages.select(
        F.col("anchor.hash").alias("hash"),
        F.struct(F.col("doc"), F.col("sig"), F.col("anchor.line").alias("line")).alias("at"),
    )
    shared = at.groupBy("hash").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    shared = shared.filter(~F.col("low").eqNullSafe(F.col("high"))).select("hash")
    matched = passages.withColumn("hash", F.col("anchor.hash")).join(shared, "hash", "left_semi")
    firsts = matched.groupBy("content").agg(
        F.min(_place("doc", "sig", "first", "last")).alias("origin"),
        F.max(_place("doc", "sig", "first", "last")).alias("latest"),
    )
    firsts = firsts.filter("origin <> latest").select("content", "origin")
    here = _place("doc", "sig")
    there = F.struct(F.col("origin.none").alias("none"), F.col("origin.doc"), F.col("origin.sig"))
    other = ~here.eqNullSafe(there)
    later = (
        matched.join(firsts, "content")
        .filter(other | (F.col("first") > F.col("origin.last")))
        .select("doc", "sig", "first", "last")
        .distinct()
    )
    before = (
        Window.partitionBy("doc", "sig").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    )
    until = Window.partitionBy("doc", "sig").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0)
    merged = (
        later.withColumn("reach", F.max("last").over(before))
        .withColumn("new", (F.col("reach").isNull() | (F.col("first") > F.col("reach") + 1)).cast("int"))
        .withColumn("run", F.sum("new").over(until))
        .groupBy("doc", "sig", "run")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
    )
    return merged.groupBy("doc", "sig").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = PASSAGE_WORDS
) -> DataFrame:
    """Rows of ``docs`` without the runs of lines that repeat earlier, and two counts.

    All columns of ``docs`` stay, ``text_col`` is what is left (lines joined by line feeds);
    ``n_lines`` counts the lines of the text with a word, ``n_deleted`` those of them that went.
    Null texts stay null, with no lines; texts without repeats stay as they are; rows that share
    id and text are one document and treated alike. Columns of ``docs`` named like the two counts
    are replaced.
    """
    own_doc, own_sig, own_runs, own_left = (
        unused(docs.columns, name) for name in ("__doc", "__sig", "__runs", "__left")
    )
    runs = materialise(
        repeated_runs(docs, id_col, text_col, least).select(
            F.col("doc").alias(own_doc), F.col("sig").alias(own_sig), F.col("runs").alias(own_runs)
        ),
        "line-runs",
    )
    own, sig = _key(id_col, text_col)
    # The runs follow the data and have no bound: they are never broadcast.
    same = (sig == F.col(own_sig)) & own.eqNullSafe(F.col(own_doc))
    joined = docs.join(runs.hint("merge"), same, "left")
    text = F.col(text_col).cast("string")
    lines = F.split(text, "\n")
    dead = lambda i: F.exists(own_runs, lambda run: (i >= run["first"]) & (i <= run["last"]))
    kept = F.filter(lines, lambda _, i: ~dead(i))
    solid = lambda parts: F.size(F.filter(parts, lambda part: part.rlike(r"\S")))
    n_lines = F.when(text.isNull(), F.lit(0)).otherwise(solid(lines))
    cut = F.col(own_runs).isNotNull()
    out = joined.withColumn(own_left, F.when(cut, F.array_join(kept, "\n")).otherwise(text))
    left = F.split(own_left, "\n")
    n_deleted = F.when(cut, n_lines - solid(left)).otherwise(F.lit(0))
    names = [c for c in docs.columns if c not in ("n_lines", "n_deleted")]
    return out.select(
        *(F.col(own_left).alias(c) if c == text_col else F.col(c) for c in names),
        n_lines.cast("bigint").alias("n_lines"),
        n_deleted.cast("bigint").alias("n_deleted"),
    )
