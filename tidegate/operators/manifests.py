"""Streaming-manifest analytics: parse, explode, detect, patch, choose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.values import MICROS, iso_duration_micros
from tidegate.operators.blocks import PIECE, explode_range
from tidegate.schemas import MANIFEST

_CORRUPT = "_corrupt_record"


def parse_manifests(manifests: DataFrame, xml: str = "xml", schema: str = MANIFEST) -> DataFrame:
    """Add ``mpd``, the manifest as a struct; NULL where the text cannot be parsed.

    Only the fields of ``schema`` are built, so a job that needs a few of them passes a smaller
    one. The one-element array keeps the parser in a generator: without it the optimizer copies
    the parse into every filter and projection that uses a field of it.
    """
    doc = F.from_xml(
        xml, f"{schema}, {_CORRUPT} STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    parsed = manifests.select("*", F.explode(F.array(doc)).alias("_doc"))
    sound = F.col("_doc").isNotNull() & F.col(f"_doc.{_CORRUPT}").isNull()
    return parsed.withColumn("mpd", F.when(sound, F.col("_doc").dropFields(_CORRUPT))).drop("_doc")


def rejected_manifests(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("mpd").isNull()).drop("mpd")


def all_sets(mpd: str = "mpd") -> Column:
    """Adaptation sets of all Periods, in order."""
    sets = F.transform(f"{mpd}.Period", lambda p: p["AdaptationSet"])
    return F.flatten(F.filter(sets, lambda s: s.isNotNull()))


def union_uint(text: Column) -> Column:
    """An attribute that is an integer or a boolean; an integer wins, anything else is flagged."""
    number = F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))
    truth = F.when(text.isin("t", "T", "true", "TRUE", "True"), F.lit(True)).when(
        text.isin("f", "F", "false", "FALSE", "False"), F.lit(False)
    )
    return F.struct(
        number.alias("u"),
        F.when(number.isNull(), truth).alias("b"),
        (text.isNotNull() & number.isNull() & truth.isNull()).alias("invalid"),
    )


def _periods(parsed: DataFrame, key: str) -> DataFrame:
    """Periods with their length: their duration, else up to the next start, else to the end of the
    presentation. NULL where the manifest doesn't say."""
    kinds = parsed.schema["mpd"].dataType
    inside = kinds["Period"].dataType.elementType.names
    time = lambda holder, field: iso_duration_micros(holder[field])
    periods = parsed.select(key, "mpd", F.posexplode("mpd.Period").alias("period_no", "period"))
    length = F.lit(None).cast("bigint")
    if "_start" in inside:
        first = F.when(F.col("period_no") == 0, F.lit(0).cast("bigint"))
        start = F.coalesce(time(F.col("period"), "_start"), first)
        after = time(F.get("mpd.Period", F.col("period_no") + 1), "_start")
        if "_mediaPresentationDuration" in kinds.names:
            final = F.col("period_no") == F.size("mpd.Period") - 1
            after = F.when(final, time(F.col("mpd"), "_mediaPresentationDuration")).otherwise(after)
        length = after - start
    if "_duration" in inside:
        length = F.coalesce(time(F.col("period"), "_duration"), length)
    return periods.select(key, "period_no", "period", length.alias("period_us"))


def _representations(parsed: DataFrame, key: str) -> DataFrame:
    """Renditions with their positions, and the end of their Period in units of their template."""
    sets = _periods(parsed, key).select(
        key, "period_no", "period_us", F.posexplode("period.AdaptationSet").alias("set_no", "set")
    )
    reps = sets.select(
        key, "period_no", "set_no", "set", "period_us", F.posexplode("set.Representation").alias("rep_no", "rep")
    )
    template = reps.schema["rep"].dataType["SegmentTemplate"].dataType.names
    end = F.lit(None).cast("bigint")
    if {"_timescale", "_presentationTimeOffset"} <= set(template):
        scale = F.coalesce("rep.SegmentTemplate._timescale", F.lit(1).cast("bigint"))
        offset = F.coalesce("rep.SegmentTemplate._presentationTimeOffset", F.lit(0).cast("bigint"))
        units = F.col("period_us").cast("decimal(20,0)") * scale.cast("decimal(18,0)") / MICROS
        end = offset + F.floor(units).try_cast("bigint")
    return reps.withColumn("period_end", end)


def _repeats(start: Column, d: Column, r: Column, bound: Column) -> Column:
    """Segments of a timeline entry. A negative ``r`` fills the time up to ``bound``: the next entry's ``t``,
    else the Period's end; without either, one segment is known."""
    zero = F.lit(0).cast("bigint")
    filled = F.when((d > 0) & bound.isNotNull(), F.greatest(F.ceil((bound - start).cast("decimal(20,0)") / d).cast("bigint"), zero))
    open_ = F.coalesce(filled, F.lit(1).cast("bigint"))
    return F.when(r < 0, open_).otherwise(F.coalesce(r, zero) + 1)


def renditions(parsed: DataFrame, key: str = "manifest_id") -> DataFrame:
    """One row per rendition with its positions (Period, set, rendition) and its segment totals.

    A timeline is folded in place, with the running time that bounds open repeats.
    """
    reps = _representations(parsed, key)
    nothing = F.array().cast("array<struct<_t: bigint, _d: bigint, _r: bigint>>")
    timeline = F.coalesce(F.col("rep.SegmentTemplate.SegmentTimeline.S"), nothing)
    # Each entry learns the time of the one after it.
    bounded = F.zip_with(
        timeline,
        F.concat(
            F.slice(F.transform(timeline, lambda s: s["_t"]), 2, F.greatest(F.size(timeline), F.lit(1))),
            F.array(F.col("period_end")),
        ),
        lambda s, after: F.struct(s.alias("s"), after.alias("after")),
    )
    zero = F.lit(0).cast("bigint")

    def step(state: Column, entry: Column) -> Column:
        s = entry["s"]
        start = F.coalesce(s["_t"], state["time"])
        n = _repeats(start, s["_d"], s["_r"], entry["after"])
        # The array of one binds what the new state uses several times: it is worked out once.
        once = F.array(F.struct(start.alias("start"), n.alias("n")))
        return F.transform(
            once,
            lambda e: F.struct(
                (e["start"] + e["n"] * s["_d"]).alias("time"),
                (state["n"] + e["n"]).alias("n"),
                (state["units"] + e["n"] * s["_d"]).alias("units"),
            ),
        )[0]

    start = F.struct(zero.alias("time"), zero.alias("n"), zero.alias("units"))
    # Entries without a struct come from the longer side of an empty timeline.
    folded = F.aggregate(F.filter(bounded, lambda e: e["s"].isNotNull()), start, step)
    folded = F.when(F.size(timeline) > 0, folded).otherwise(start)
    listed = F.greatest(F.coalesce(F.size("rep.SegmentList.SegmentURL"), F.lit(0)), F.lit(0))
    listed_units = listed * F.coalesce(F.col("rep.SegmentList._duration"), F.lit(0))
    totals = reps.withColumn("timed", folded)
    return totals.select(
        key,
        F.col("period_no").cast("bigint").alias("period_no"),
        F.col("set_no").cast("bigint").alias("set_no"),
        F.col("rep_no").cast("bigint").alias("rep_no"),
        F.col("rep._id").alias("rep_id"),
        F.coalesce("rep._mimeType", "set._mimeType").alias("mime_type"),
        F.col("rep._bandwidth").alias("bandwidth"),
        (listed + F.col("timed.n")).cast("bigint").alias("n_segments"),
        (listed_units + F.col("timed.units")).cast("bigint").alias("duration_units"),
    )


def template_parts(template: Column, fixed: dict[str, Column], later: tuple[str, ...] = ()) -> Column:
    """A URL template taken apart: ``array<struct<text, field, width>>``.

    ``fixed`` maps identifiers to columns; those of ``later`` become parts with a ``field`` and no text, for
    :func:`fill_parts`. ``$Number%05d$`` pads with zeros, ``$$`` is a dollar sign. Unknown identifiers
    and a last dollar sign without its pair stay as they are.
    """
    parts = F.split(template, r"\$")
    last = F.size(parts) - 1

    def one(part: Column, i: Column) -> Column:
        name = F.substring_index(part, "%", 1)
        suffix = F.regexp_extract(part, "^[A-Za-z]+%0?([0-9]+)d$", 1).try_cast("int")
        inside = (i % 2 == 1) & (i < last)
        # Identifiers without a width are the usual case, and need no pattern.
        width = F.when(inside & part.contains("%"), suffix).otherwise(0)
        text = F.lit(None).cast("string")
        for known, value in fixed.items():
            text = F.when(name == known, value.cast("string")).otherwise(text)
        padded = F.when(width == 0, text).otherwise(F.lpad(text, F.greatest(width, F.length(text)), F.lit("0")))
        field = F.when(inside & name.isin(*later) & width.isNotNull(), name) if later else F.lit(None).cast("string")
        whole = (
            F.when(i % 2 == 0, part)
            .when(i == last, F.concat(F.lit("$"), part))
            .when(part == "", F.lit("$"))
            .otherwise(F.coalesce(F.when(width.isNotNull(), padded), F.concat(F.lit("$"), part, F.lit("$"))))
        )
        return F.named_struct(F.lit("text"), whole, F.lit("field"), field, F.lit("width"), width)

    return F.filter(F.transform(parts, one), lambda p: (p["text"] != "") | p["field"].isNotNull())


def fill_parts(parts: Column, values: dict[str, Column]) -> Column:
    """The URL of parts that :func:`template_parts` has left open."""

    def one(part: Column) -> Column:
        text = F.lit(None).cast("string")
        for field, value in values.items():
            text = F.when(part["field"] == field, value.cast("string")).otherwise(text)
        padded = F.lpad(text, F.greatest(part["width"], F.length(text)), F.lit("0"))
        return F.when(part["field"].isNull(), part["text"]).otherwise(padded)

    return F.array_join(F.transform(parts, one), "")


def _packed(parts: Column) -> Column:
    """Parts of a URL as one short text, for rows that are sorted; XML holds no NUL, so that parts them."""
    open_ = lambda p: F.concat(p["field"], F.lit(":"), p["width"].cast("string"))
    texts = F.transform(parts, lambda p: F.when(p["field"].isNull(), F.concat(F.lit("="), p["text"])).otherwise(open_(p)))
    return F.array_join(texts, "\0")


def _unpacked(packed: Column) -> Column:
    def one(part: Column) -> Column:
        # A template without a part is one empty text.
        literal = part.startswith("=") | (part == "")
        return F.struct(
            F.when(literal, F.substr(part, F.lit(2))).alias("text"),
            F.when(~literal, F.substring_index(part, ":", 1)).alias("field"),
            F.when(~literal, F.substring_index(part, ":", -1).cast("int")).alias("width"),
        )

    return F.transform(F.split(packed, "\0"), one)


#: Ends of an identifier in a URL, and what stands for one that is known later: plain, or padded to a width.
_OPEN, _CLOSE = "\0<", "\0>"
_LATER = {"Number": ("\0N", "\0n"), "Time": ("\0T", "\0t")}


def _with_url(df: DataFrame, name: str, template: Column, fixed: dict[str, Column], later: bool = False) -> DataFrame:
    """Add ``name``, the template with its identifiers filled in, and how ``later`` ones are padded.

    The same text as :func:`fill_parts` gives, by whole-text functions, since lambdas over the parts of each template are
    slow. ``later`` identifiers become marks, which XML can't hold, for :func:`_filled`; the width of
    those that are padded is in ``<name>_Number`` and ``<name>_Time``, -1 without any. A width is null where one identifier has
    several widths, or one that is no number: then ``name`` has the parts themselves, packed.
    """
    text, token = f"_{name}", f"_{name}_token"
    marked = F.regexp_replace(template, r"\$([^$]*)\$", f"{_OPEN}$1{_CLOSE}")
    plain = {k: F.coalesce(v.cast("string"), F.lit(f"${k}$")) for k, v in fixed.items()}
    plain |= {k: F.lit(mark) for k, (mark, _) in _LATER.items() if later}
    for known, value in plain.items():
        marked = F.replace(marked, F.lit(f"{_OPEN}{known}{_CLOSE}"), value)
    df = df.withColumn(text, marked)
    for known in plain:
        # Each step is a column of its own, so that none is worked out twice.
        pattern = f"{_OPEN}{known}%0?[0-9]{{1,9}}d{_CLOSE}"
        df = df.withColumn(token, F.when(F.contains(text, F.lit("%")), F.regexp_extract(text, pattern, 0)))
        found = F.coalesce(F.col(token) != "", F.lit(False))
        width = F.regexp_extract(token, "%([0-9]+)d", 1).cast("int")
        if known in fixed:
            value = fixed[known].cast("string")
            padded = F.lpad(value, F.greatest(width, F.length(value)), F.lit("0"))
            bare = F.concat(F.lit("$"), F.substring(token, 3, 1 << 20), F.lit("$"))
            bare = F.replace(bare, F.lit(_CLOSE), F.lit(""))
            padded = F.coalesce(padded, bare)
        else:
            padded = F.lit(_LATER[known][1])
            df = df.withColumn(f"{name}_{known}", F.when(found, width).otherwise(-1))
        df = df.withColumn(text, F.when(found, F.replace(text, F.col(token), padded)).otherwise(F.col(text)))
    left = F.contains(text, F.lit("%")) & F.col(text).rlike(f"{_OPEN}[^\0]*%")
    df = df.withColumn(token, F.coalesce(left, F.lit(False)))
    parts = template_parts(template, fixed, tuple(_LATER) if later else ())
    slow = _packed(parts) if later else fill_parts(parts, {})
    ended = F.replace(F.col(text), F.lit(f"{_OPEN}{_CLOSE}"), F.lit("$"))
    for end in (_OPEN, _CLOSE):
        ended = F.replace(ended, F.lit(end), F.lit("$"))
    df = df.withColumn(name, F.when(F.col(token), slow).otherwise(ended))
    for known in _LATER if later else ():
        df = df.withColumn(f"{name}_{known}", F.when(~F.col(token), F.col(f"{name}_{known}")))
    return df.drop(text, token)


def _filled(name: str, values: dict[str, Column]) -> Column:
    """The URL that :func:`_with_url` has left open; a null value is an empty text, as in :func:`fill_parts`."""
    text = F.col(name)
    for known, (plain, padded) in _LATER.items():
        value, width = values[known].cast("string"), F.col(f"{name}_{known}")
        text = F.replace(text, F.lit(plain), F.coalesce(value, F.lit("")))
        filled = F.coalesce(F.lpad(value, F.greatest(width, F.length(value)), F.lit("0")), F.lit(""))
        text = F.replace(text, F.lit(padded), filled)
    several = F.col(f"{name}_Number").isNull()
    return F.when(several, fill_parts(_unpacked(F.col(name)), values)).otherwise(text)


def segment_times(parsed: DataFrame, key: str = "manifest_id", piece: int = PIECE) -> DataFrame:
    """One row per segment with its number, start, duration and URL.

    ``(key, period_no, set_no, rep_no, rep_id, number, start_units, duration_units, timescale, start_us,
    init_url, url)``: timelines are unrolled, listed segments follow each other. Times run on
    from entry to entry and start anew at each ``t``; ``start_us`` is within the Period, after the
    presentation offset. Numbers begin at the template's start number (1 if it has none), and at
    1 in lists. Times and numbers are running sums over the entries of a rendition, so no fold carries an
    array along. All windows share one sort, whose rows hold the parts of a URL as one short text.
    A manifest is parsed once for timelines and lists.
    """
    place = [key, "period_no", "set_no", "rep_no", "rep_id"]
    reps = _representations(parsed, key).withColumn("rep_id", F.col("rep._id")).drop("set")
    template, listed = F.col("rep.SegmentTemplate"), F.col("rep.SegmentList")
    fixed = {"RepresentationID": F.col("rep_id"), "Bandwidth": F.col("rep._bandwidth")}
    reps = _with_url(reps, "init_url", template["_initialization"], fixed)
    reps = _with_url(reps, "media", template["_media"], fixed, later=True)
    widths = [f"media_{known}" for known in _LATER]
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    entry = "array<struct<entry_no: int, t: bigint, d: bigint, r: bigint, listed_url: string>>"
    nothing = F.array().cast(entry)
    # A listed segment is an entry of its own, without repeats.
    length = F.coalesce(listed["_duration"], zero)
    timeline = F.transform(
        template["SegmentTimeline"]["S"],
        lambda s, i: F.struct(i.alias("entry_no"), s["_t"].alias("t"), s["_d"].alias("d"), s["_r"].alias("r"), F.lit(None).cast("string").alias("listed_url")),
    )
    urls = F.transform(
        listed["SegmentURL"],
        lambda s, i: F.struct(i.alias("entry_no"), F.lit(None).cast("bigint").alias("t"), length.alias("d"), zero.alias("r"), s["_media"].alias("listed_url")),
    )
    kinds = F.array(
        F.struct(
            F.lit(False).alias("listed"),
            F.coalesce(template["_timescale"], one).alias("timescale"),
            F.coalesce(template["_presentationTimeOffset"], zero).alias("offset"),
            F.coalesce(template["_startNumber"], one).alias("start_number"),
            F.col("init_url"),
            F.col("media"),
            *(F.col(c) for c in widths),
            F.coalesce(timeline.cast(entry), nothing).alias("entries"),
        ),
        F.struct(
            F.lit(True).alias("listed"),
            F.coalesce(listed["_timescale"], one).alias("timescale"),
            F.coalesce(listed["_presentationTimeOffset"], zero).alias("offset"),
            one.alias("start_number"),
            listed["Initialization"]["_sourceURL"].alias("init_url"),
            F.lit(None).cast("string").alias("media"),
            *(F.lit(None).cast("int").alias(c) for c in widths),
            F.coalesce(urls.cast(entry), nothing).alias("entries"),
        ),
    )
    heads = reps.select(*place, "period_end", F.inline(kinds))
    entries = heads.select(*[c for c in heads.columns if c != "entries"], F.inline("entries"))
    whole = Window.partitionBy(*place, "listed").orderBy("entry_no")
    upto = whole.rowsBetween(Window.unboundedPreceding, 0)
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    # Only an entry that a ``t`` or the end follows can be open: what comes after it starts anew.
    known = F.when(F.col("r") < 0, 1).otherwise(F.coalesce("r", zero) + 1)
    gone = F.coalesce(F.sum(known * F.col("d")).over(before), zero)
    timed = (
        entries.withColumn("gone", gone)
        .withColumn("after", F.coalesce(F.lead("t").over(whole), F.when(F.lead("entry_no").over(whole).isNull(), F.col("period_end"))))
        # The last ``t`` so far, and what had gone by there.
        .withColumn("base", F.last(F.when(F.col("t").isNotNull(), F.struct("t", "gone")), ignorenulls=True).over(upto))
        .withColumn(
            "start",
            F.coalesce("base.t", F.when(F.col("listed"), F.col("offset")), zero)
            + F.col("gone")
            - F.coalesce("base.gone", zero),
        )
        .withColumn("n", _repeats(F.col("start"), F.col("d"), F.col("r"), F.col("after")))
        .withColumn("first", F.col("start_number") + F.coalesce(F.sum("n").over(before), zero))
    )
    opened = timed.select(
        *place,
        *("listed", "timescale", "offset", "start", "d", "n", "first", "init_url", "listed_url", "media"),
        *widths,
    )
    # All ranges begin at 0, and most are short.
    each = explode_range(opened, zero, F.col("n") - 1, "i", piece, (*place, "first"))
    each = each.withColumn("number", F.col("first") + F.col("i"))
    each = each.withColumn("start_units", F.col("start") + F.col("i") * F.col("d"))
    filled = _filled("media", {"Number": F.col("number"), "Time": F.col("start_units")})
    both = each.select(
        *place,
        "number",
        "start_units",
        F.col("d").alias("duration_units"),
        "timescale",
        "offset",
        "init_url",
        F.when(F.col("listed"), F.col("listed_url")).otherwise(filled).alias("url"),
    )
    within = (F.col("start_units") - F.col("offset")).cast("decimal(20,0)") * MICROS / F.col("timescale")
    return both.withColumns(
        {
            "start_us": F.floor(within).cast("bigint"),
            **{c: F.col(c).cast("bigint") for c in ("period_no", "set_no", "rep_no")},
        }
    ).drop("offset")


def segments(parsed: DataFrame, key: str = "manifest_id") -> DataFrame:
    """One row per listed segment in order."""
    reps = parsed.select(key, F.explode(all_sets()).alias("set")).select(
        key, F.explode("set.Representation").alias("rep")
    )
    return reps.select(
        key,
        F.col("rep._id").alias("rep_id"),
        F.col("rep.SegmentList.Initialization._sourceURL").alias("init_url"),
        F.posexplode("rep.SegmentList.SegmentURL").alias("segment_no", "segment"),
    ).select(
        key,
        "rep_id",
        "init_url",
        F.col("segment_no").cast("bigint").alias("segment_no"),
        F.col("segment._media").alias("media"),
    )


def timeline_segments(parsed: DataFrame, key: str = "manifest_id") -> DataFrame:
    """One row per timeline entry of segment templates."""
    reps = parsed.select(key, F.explode(all_sets()).alias("set")).select(
        key, F.explode("set.Representation").alias("rep")
    )
    return reps.select(
        key,
        F.col("rep._id").alias("rep_id"),
        F.col("rep.SegmentTemplate._timescale").alias("timescale"),
        F.posexplode("rep.SegmentTemplate.SegmentTimeline.S").alias("entry_no", "s"),
    ).select(
        key,
        "rep_id",
        "timescale",
        "entry_no",
        F.col("s._t").alias("t"),
        F.col("s._d").alias("d"),
        (F.coalesce("s._r", F.lit(0)) + 1).alias("repeats"),
    )


def protections(parsed: DataFrame, key: str = "manifest_id") -> DataFrame:
    """Content-protection descriptors of sets (no rendition id) and renditions, in one pass."""
    none = F.array().cast("array<struct<rep_id: string, scheme_id_uri: string, value: string>>")

    def descriptors(owner: Column, rep_id: Column) -> Column:
        found = F.transform(
            owner["ContentProtection"],
            lambda p: F.struct(
                rep_id.alias("rep_id"),
                p["_schemeIdUri"].alias("scheme_id_uri"),
                p["_value"].alias("value"),
            ),
        )
        return F.coalesce(found, none)

    def of_set(adaptation: Column) -> Column:
        of_reps = F.flatten(
            F.transform(adaptation["Representation"], lambda r: descriptors(r, r["_id"]))
        )
        own = descriptors(adaptation, F.lit(None).cast("string"))
        return F.concat(own, F.coalesce(of_reps, none))

    every = F.flatten(F.transform(all_sets(), of_set))
    return parsed.select(key, F.inline(every))


def is_single_audio(mpd: str = "mpd") -> Column:
    """Exactly one set, over all Periods, with one rendition whose own MIME type starts with audio."""
    sets = all_sets(mpd)
    reps = F.try_element_at(sets, F.lit(1))["Representation"]
    mime = F.try_element_at(reps, F.lit(1))["_mimeType"]
    single = (F.size(sets) == 1) & (F.size(reps) == 1) & mime.startswith("audio")
    return F.coalesce(single, F.lit(False))


def patch_manifests(parsed: DataFrame, key: str = "manifest_id") -> DataFrame:
    """Add ``patched`` (struct) and ``patched_xml``.

    A manifest with a single audio rendition gets a copy of it with id 1 and bandwidth 0; all
    manifests are written again, so fields that are not modelled disappear.
    """

    def with_dummy(adaptation: Column) -> Column:
        reps = adaptation["Representation"]
        dummy = F.transform(
            reps,
            lambda r: r.withField("_id", F.lit("1")).withField(
                "_bandwidth", F.lit(0).cast("bigint")
            ),
        )
        return adaptation.withField("Representation", F.concat(reps, dummy))

    def widened(period: Column) -> Column:
        return period.withField("AdaptationSet", F.transform(period["AdaptationSet"], with_dummy))

    periods = F.col("mpd.Period")
    periods = F.when(is_single_audio(), F.transform(periods, widened)).otherwise(periods)
    patched = F.when(F.col("mpd").isNotNull(), F.col("mpd").withField("Period", periods))
    return parsed.withColumn("patched", patched).withColumn(
        "patched_xml", F.to_xml("patched", {"rowTag": "MPD"})
    )


def best_rendition(parsed: DataFrame, key: str = "manifest_id") -> DataFrame:
    """The rendition with the highest bandwidth; the smallest id wins a tie.

    A manifest is one row, so this is a fold over its arrays and needs no window or shuffle.
    """
    listed = F.transform(all_sets(), lambda s: s["Representation"])
    reps = F.flatten(F.filter(listed, lambda r: r.isNotNull()))
    slim = F.transform(
        reps,
        lambda r: F.struct(
            F.coalesce(r["_bandwidth"], F.lit(-1)).alias("bandwidth"), r["_id"].alias("rep_id")
        ),
    )

    def better(best: Column, rep: Column) -> Column:
        higher = rep["bandwidth"] > best["bandwidth"]
        tie = (rep["bandwidth"] == best["bandwidth"]) & (rep["rep_id"] < best["rep_id"])
        return F.when(higher | tie, rep).otherwise(best)

    best = F.reduce(slim, F.try_element_at(slim, F.lit(1)), better)
    return parsed.select(key, best.alias("best")).where(F.col("best").isNotNull()).select(
        key, F.col("best.rep_id").alias("rep_id"), F.col("best.bandwidth").alias("bandwidth")
    )
