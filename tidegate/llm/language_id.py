"""Language identification by compression: the language whose dictionary packs a text best."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.session import ship_package

#: Labelled rows per language that a dictionary is made from at most, and its size.
TRAINING_ROWS = 200
DICTIONARY_BYTES = 1 << 15
#: Slices, evenly spread, that a sampled text gives to a dictionary.
SLICES = 4
#: Texts are packed in pieces of this size, so that the dictionary counts and not what a long text
#: repeats of itself.
PIECE = 2048
LEVEL = 6
#: Languages at most: more distinct labels than these point to a wrong column.
LANGUAGES = 1000
#: Margin (share of the second smallest size) below which a prediction is marked as rejected.
MARGIN = 0.01
UNKNOWN = "und"


@dataclass
class Model:
    """Raw-content dictionary of each language."""

    dictionaries: dict[str, bytes]


def train(
    docs: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    rows: int = TRAINING_ROWS,
) -> Model:
    """Dictionaries from labelled rows for which ``usable`` holds.

    Of each language the ``rows`` rows with the smallest hash of their id are taken. Each has an
    equal share of the dictionary's bytes, filled with ``SLICES`` slices from across its text. Rows
    with a null id, label or text are left out, as are languages without any letter in the sample;
    more than ``LANGUAGES`` languages are an error. Only ids are ranked; slices of the texts of the
    bounded sample are fetched afterwards.
    """
    fields = docs.select(
        F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), usable.alias("use")
    )
    fields = fields.filter("use AND id IS NOT NULL AND label IS NOT NULL")
    if fields.select("label").distinct().limit(LANGUAGES + 1).count() > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages in {label_col}")
    place = F.xxhash64(F.col("id").cast("string"))
    first = Window.partitionBy("label").orderBy("place", "id")
    ranked = (
        fields.select("id", "label", place.alias("place"))
        .withColumn("rank", F.row_number().over(first))
        .filter(F.col("rank") <= rows)
    )
    # An id that repeats is one sampled row, with one of its texts (the least).
    chosen = ranked.groupBy("id", "label").agg(F.min("rank").alias("rank"))
    taken = F.count(F.lit(1)).over(Window.partitionBy("label"))
    chosen = chosen.withColumn("most", F.ceil(F.lit(DICTIONARY_BYTES // SLICES) / taken).cast("int"))
    texts = docs.select(
        F.col(id_col).alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(text_col).cast("string").alias("text"),
    ).filter("text IS NOT NULL")
    start = lambda i: F.floor(F.length("text") * F.lit(i) / F.lit(SLICES)).cast("int")
    slices = F.array(
        *(
            F.substring(F.col("text"), start(i) + 1, F.least("most", start(i + 1) - start(i)))
            for i in range(SLICES)
        )
    )
    sample = (
        texts.join(F.broadcast(chosen), ["id", "label"])
        .groupBy("id", "label", "rank")
        .agg(F.min(slices).alias("slices"))
    )
    found: dict[str, list] = {}
    for row in sample.collect():
        found.setdefault(row["label"], []).append((row["rank"], row["slices"]))
    out = {}
    for label, parts in found.items():
        # Each slice ends in a line feed.
        size = max(DICTIONARY_BYTES // (SLICES * len(parts)) - 1, 0)
        joined = "".join(_cut(text.lower(), size) + "\n" for _, texts in sorted(parts) for text in texts)
        if any(c.isalpha() for c in joined):
            out[label] = joined.encode()[:DICTIONARY_BYTES]
    return Model(out)


def _cut(text: str, size: int) -> str:
    """The characters of ``text`` that lie whole in its first ``size`` bytes."""
    return text.encode()[:size].decode(errors="ignore")


def _classifier(shared, least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        import zstandard

        names = sorted(shared.value)
        letter = regex.compile(r"\p{L}").search
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL,
            source_size=PIECE,
            dict_size=DICTIONARY_BYTES,
            write_content_size=0,
            write_checksum=0,
            write_dict_id=0,
        )
        raw = zstandard.DICT_TYPE_RAWCONTENT
        packers = [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(shared.value[name], dict_type=raw),
                compression_params=settings,
            ).compress
            for name in names
        ]
        for batch in batches:
            guess, score, rejected = [], [], []
            for text in batch.column(1).to_pylist():
                if not names or not text or not letter(text):
                    guess.append(UNKNOWN)
                    score.append(0.0)
                    rejected.append(True)
                    continue
                data = text.lower().encode()
                pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
                sizes = sorted(
                    (sum(len(pack(piece)) for piece in pieces), name)
                    for pack, name in zip(packers, names)
                )
                best = sizes[0][0]
                second = sizes[1][0] if len(sizes) > 1 else best * 2
                margin = (second - best) / second
                guess.append(sizes[0][1])
                score.append(min(1.0, margin))
                rejected.append(margin < least)
            yield pa.record_batch(
                [batch.column(0), pa.array(guess, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                ["id", "lang_pred", "score", "rejected"],
            )

    return run


def classify(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    margin: float = MARGIN,
) -> DataFrame:
    """``(id_col, lang_pred, score, rejected)`` of each row's whole text.

    ``lang_pred`` is the language whose dictionary gives the smallest size (the first name among
    equals), ``und`` where the text is null or has no letter; ``score`` is by how large a share
    the second smallest size is undercut, ``rejected`` whether that is less than ``margin``. Rows
    are kept one for one, ids may be null or repeat, other columns are ignored. Dictionaries are
    broadcast: 32 KiB a language.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(dict(model.dictionaries))
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )
    return rows.mapInArrow(_classifier(shared, margin), schema).withColumnRenamed("id", id_col)
