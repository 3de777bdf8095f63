"""Content types from leading bytes, by a table of signatures."""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.constants import HTML_OPENINGS, SIGNATURES

SCHEMA = "mime STRING, at INT, pattern STRING, mask STRING, skip_space BOOLEAN"
#: Rows and shapes (position and mask) of a signature table at most: it is read by the driver.
MOST_ROWS, MOST_SHAPES = 10_000, 100
_DIGITS = "0123456789ABCDEF"
_SPACE = "^(?:09|0A|0C|0D|20)+"


def default_signatures(spark: SparkSession) -> DataFrame:
    """The public sniffing table: images, audio, video, fonts, archives, documents and markup.

    ``pattern`` and ``mask`` are hex, as long as each other; a byte counts in the bits of its mask.
    ``skip_space`` leaves out white space before the signature.
    """
    rows = [(mime, at, pattern, mask or "F" * len(pattern), False) for mime, at, pattern, mask in SIGNATURES]
    for opening in HTML_OPENINGS:
        # Letters in either case, then a space or the end of the tag.
        text = opening.encode().hex().upper()
        mask = "".join("DF" if c.isalpha() else "FF" for c in opening)
        ends = [""] if opening == "<!--" else ["20", "3E"]
        rows += [("text/html", 0, text + end, mask + "FF" * (len(end) // 2), True) for end in ends]
    rows.append(("text/xml", 0, b"<?xml".hex().upper(), "F" * 10, True))
    return spark.createDataFrame(rows, SCHEMA)


def _masked(digits: str, mask: str) -> str:
    return "".join(_DIGITS[int(d, 16) & int(m, 16)] for d, m in zip(digits, mask) if m != "0")


def _masked_column(text: Column, at: int, mask: str) -> Column:
    """The digits of hex ``text`` from byte ``at`` on that count in ``mask``, cut to its bits."""
    parts, place = [], 2 * at + 1
    for nibble, run in groupby(mask):
        size = len(list(run))
        piece = F.substring(text, place, size)
        if nibble != "0":
            kept = "".join(_DIGITS[i & int(nibble, 16)] for i in range(16))
            parts.append(piece if nibble == "F" else F.translate(piece, _DIGITS, kept))
        place += size
    return F.concat(*parts)


def identify(df: DataFrame, sniff_hex: str, by: list[str], signatures: DataFrame, name: str = "sniffed") -> DataFrame:
    """``df`` with the content type of its leading bytes (hex) in ``name``; NULL where none fits.

    The signature that compares most bytes wins, among equals the first type by name. Rows are told
    apart by ``by``, which must be unique. Each row is looked up once per shape (position and
    mask) in the whole table, by the bytes that count: one join on equal keys, with a table bounded by
    ``MOST_ROWS``, whatever its number of signatures.
    """
    spark = df.sparkSession
    known = signatures.select("mime", "at", F.upper("pattern"), F.upper("mask"), "skip_space").limit(MOST_ROWS + 1).collect()
    shapes = sorted({(r["at"], r[3], r["skip_space"]) for r in known if r[3].strip("0")})
    if len(known) > MOST_ROWS or len(shapes) > MOST_SHAPES:
        raise ValueError(f"a signature table has at most {MOST_ROWS} rows and {MOST_SHAPES} shapes")
    number = {shape: i for i, shape in enumerate(shapes)}
    index = [
        (number[r["at"], r[3], r["skip_space"]], _masked(r[2], r[3]), sum(r[3][i : i + 2] != "00" for i in range(0, len(r[3]), 2)), r["mime"])
        for r in known
        if r[3].strip("0")
    ]
    table = spark.createDataFrame(index, "shape INT, bytes STRING, n INT, mime STRING")
    text = F.upper(F.coalesce(F.col(sniff_hex), F.lit("")))
    bare = F.regexp_replace(text, _SPACE, "")
    keys = [_masked_column(bare if skip else text, at, mask) for at, mask, skip in shapes]
    looked = df.select(*by, F.posexplode(F.array(*keys) if keys else F.array().cast("array<string>")).alias("shape", "bytes"))
    # The longest first, then the first name: the least of (-n, mime).
    found = (
        looked.join(F.broadcast(table), ["shape", "bytes"])
        .groupBy(*by)
        .agg(F.min(F.struct((-F.col("n")).alias("n"), "mime")).alias("best"))
        .select(*by, F.col("best.mime").alias(name))
    )
    return df.join(found, by, "left")
