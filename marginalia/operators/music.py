"""Operators over music elements of a piece.

elements: doc_id, pos, element_type (note, rest, key_sig, time_sig),
          measure_number, pitch, duration, sharps, time_signature

Every window is partitioned by piece, and a piece is one scanned document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Key names by number of sharps, long and short forms.
KEY_NAMES = {
    0: "C Major / A minor",
    1: "G Major / E minor",
    -1: "F Major / D minor",
    2: "D Major / B minor",
    -2: "Bb Major / G minor",
}
KEYS = {0: "C Major", 1: "G Major", -1: "F Major", 2: "D Major", -2: "Bb Major"}

# Duration buckets in quarter notes, and dotted durations.
DOTTED = (0.75, 1.5, 3.0)
MEASURES_PER_PHRASE = 4

SOUNDING = ("note", "rest")


def _named(sharps: Column, names: dict[int, str], suffix: str) -> Column:
    out = None
    for count, name in names.items():
        out = F.when(sharps == count, name) if out is None else out.when(sharps == count, name)
    return out.otherwise(F.concat(sharps.cast("string"), F.lit(suffix)))


def _last(condition: Column, value: Column) -> Column:
    return F.max_by(F.when(condition, value), F.when(condition, F.col("pos")))


def summarize(elements: DataFrame) -> DataFrame:
    """Counts, signatures (the last one wins) and estimated phrases per piece."""
    kind = F.col("element_type")
    sounding = kind.isin(*SOUNDING)
    sharps = F.coalesce("sharps", F.lit(0))
    time = F.coalesce("time_signature", F.lit("4/4"))
    measured = F.countDistinct(F.when(F.coalesce("measure_number", F.lit(0)) != 0, F.col("measure_number")))
    return elements.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_elements"),
        F.count_if(kind == "note").alias("n_notes"),
        F.count_if(kind == "rest").alias("n_rests"),
        F.countDistinct(F.when(sounding, F.col("measure_number"))).alias("n_measures"),
        measured.alias("measure_count"),
        F.greatest(F.lit(1), F.floor(measured / MEASURES_PER_PHRASE)).alias("phrase_count"),
        _last(kind == "key_sig", _named(sharps, KEYS, " sharps")).alias("key"),
        _last(kind == "key_sig", _named(sharps, KEY_NAMES, " sharps/flats")).alias("key_name"),
        _last(kind == "time_sig", time).alias("time_signature"),
    )


def markdown_summary(summary: DataFrame) -> DataFrame:
    """The metadata section of a music document."""
    unknown = F.lit("Unknown")
    lines = [
        ("Key Signature", F.coalesce("key_name", unknown)),
        ("Time Signature", F.coalesce("time_signature", unknown)),
        ("Tempo", unknown),
        ("Measure Count", F.col("n_measures").cast("string")),
        ("Note Count", F.col("n_notes").cast("string")),
        ("Rest Count", F.col("n_rests").cast("string")),
        ("Total Elements", F.col("n_elements").cast("string")),
    ]
    listed = [F.concat(F.lit(f"- **{name}:** "), value) for name, value in lines]
    files = ["- MusicXML: `music.musicxml`", "- ABC Notation: `music.abc`", "- MIDI: `music.mid`"]
    text = F.concat_ws(
        "\n",
        F.lit("## Music Metadata"),
        F.lit(""),
        *listed,
        F.lit(""),
        F.lit("### Available Formats"),
        F.lit(""),
        *[F.lit(line) for line in files],
        F.lit(""),
    )
    return summary.select("doc_id", text.alias("markdown"))


def has_octave(pitch: Column) -> Column:
    return F.substring(pitch, 2, 1).rlike("^[0-9]$")


def abc_symbol() -> Column:
    """ABC text of a note or rest. A pitch with an accidental counts as the
    middle octave, because the octave is read from the second character."""
    pitch = F.col("pitch")
    octave = F.when(has_octave(pitch), F.substring(pitch, 2, 1).cast("int")).otherwise(4)
    letter = F.substring(pitch, 1, 1)
    letter = F.when(octave >= 5, F.lower(letter)).when(octave <= 3, F.concat(F.upper(letter), F.lit(","))).otherwise(letter)
    sign = F.when(F.length(pitch) > 2, F.when(F.substring(pitch, 2, 1) == "#", "^").when(F.substring(pitch, 2, 1) == "b", "_"))
    head = F.when(F.col("element_type") == "note", F.concat(F.coalesce(sign, F.lit("")), letter)).otherwise("z")
    length = F.when(F.col("duration") == 0.5, "/2").when(F.col("duration") == 2.0, "2").otherwise("")
    return F.concat(head, length)


def to_abc(elements: DataFrame) -> DataFrame:
    """ABC notation per piece: header, symbols, a bar at each new measure.

    One sort by piece serves bars, signatures and the ordered symbols."""
    kind = F.col("element_type")
    lasting = F.col("duration").isNotNull() & (F.col("duration") != 0)
    audible = lasting & ((kind == "rest") | ((kind == "note") & (F.coalesce("pitch", F.lit("")) != "")))
    before = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    last_measure = F.last(F.when(audible, F.col("measure_number")), ignorenulls=True).over(before)
    moved = last_measure != F.col("measure_number")
    symbol = F.when(audible, F.concat(F.when(moved, "|").otherwise(""), abc_symbol()))
    entry = F.when(F.col("t").isNotNull(), F.struct("pos", "t"))
    grouped = (
        elements.withColumn("t", symbol)
        .groupBy("doc_id")
        .agg(
            F.sort_array(F.collect_list(entry)).alias("body"),
            _last(kind == "key_sig", _named(F.coalesce("sharps", F.lit(0)), KEYS, " sharps")).alias("key"),
            _last(kind == "time_sig", F.coalesce("time_signature", F.lit("4/4"))).alias("time"),
        )
    )
    return grouped.select(
        "doc_id",
        F.concat(
            F.lit("X:1\nT:Untitled\nM:"), F.coalesce("time", F.lit("4/4")), F.lit("\nL:1/4\nK:"),
            F.coalesce(F.substring_index("key", " ", 1), F.lit("C")), F.lit("\n"),
            F.array_join(F.transform("body", lambda s: s["t"]), ""), F.lit("|\n"),
        ).alias("abc"),
    )


def phrases(elements: DataFrame, min_rest: float = 1.0) -> DataFrame:
    """Phrases of each piece, closed by measures with a long rest.

    A measure that would close a phrase it also opens does not, so within a run
    of adjacent resting measures only every other one closes: the odd ones, or
    the even measure numbers when the run opens the piece. The last measure
    always closes.
    """
    resting = (F.col("element_type") == "rest") & (F.col("duration") >= min_rest)
    measures = elements.groupBy("doc_id", "measure_number").agg(F.max(resting).alias("rests"))
    # All windows share one order of a piece, so that its measures are sorted once.
    piece = Window.partitionBy("doc_id").orderBy("measure_number")
    upto = piece.rowsBetween(Window.unboundedPreceding, 0)
    goes_on = F.lag("rests").over(piece).eqNullSafe(True) & F.lag("measure_number").over(piece).eqNullSafe(F.col("measure_number") - 1)
    runs = (
        measures.withColumn("is_last", F.lead(F.lit(True)).over(piece).isNull())
        .withColumn("opens", F.when(F.col("rests") & ~goes_on, F.col("measure_number")))
        .withColumn("run_start", F.last("opens", ignorenulls=True).over(upto))
    )
    opens_piece = F.col("run_start") <= 1
    odd_in_run = (F.col("measure_number") - F.col("run_start")) % 2 == 0
    closes = F.col("is_last") | (
        F.col("rests")
        & F.when(opens_piece, (F.col("measure_number") >= 2) & (F.col("measure_number") % 2 == 0)).otherwise(odd_in_run)
    )
    ends = runs.filter(closes)
    return ends.select(
        "doc_id",
        F.row_number().over(piece).alias("phrase_num"),
        (F.coalesce(F.lag("measure_number").over(piece), F.lit(0)) + 1).alias("start_measure"),
        F.col("measure_number").alias("end_measure"),
        F.when(F.col("rests"), "rest").otherwise("measure_group").alias("boundary_type"),
        F.when(F.col("rests"), 0.8).otherwise(0.5).alias("confidence"),
    )


def measure_groups(elements: DataFrame, size: int = MEASURES_PER_PHRASE) -> DataFrame:
    """Fallback segmentation: every ``size`` measures."""
    measures = elements.select("doc_id", "measure_number").distinct()
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("measure_number")) - 1
    return (
        measures.withColumn("phrase_num", F.floor(n / size) + 1)
        .groupBy("doc_id", "phrase_num")
        .agg(F.min("measure_number").alias("start_measure"), F.max("measure_number").alias("end_measure"))
    )


def _offset(lasting: Column) -> Column:
    """What lasted before an element within its measure."""
    start = Window.partitionBy("doc_id", "measure_number").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(lasting).over(start), F.lit(0.0))


def _rhythm_flags(is_note: Column) -> list[Column]:
    """Aggregates over the notes of a piece, from duration and offset."""
    d = F.col("duration")
    flags = {
        "whole": d >= 4.0,
        "half": (d >= 2.0) & (d < 4.0),
        "quarter": (d >= 1.0) & (d < 2.0),
        "eighth": (d >= 0.5) & (d < 1.0),
        "sixteenth": d < 0.5,
        "dotted": d.isin(*DOTTED),
        "triplets": (F.abs(d - 1 / 3) < 0.01) | (F.abs(d - 2 / 3) < 0.01),
        "syncopation": F.col("offset") != F.floor("offset"),
    }
    return [F.max(F.when(is_note, flag)).alias(name) for name, flag in flags.items()]


def _rhythm_words() -> Column:
    lengths = F.array_compact(
        F.array(*[F.when(F.col(n), f"{n} notes") for n in ("whole", "half", "quarter", "eighth", "sixteenth")])
    )
    words = F.concat_ws(
        ", ",
        F.slice(lengths, 1, 3),
        F.when(F.col("dotted"), "dotted rhythms"),
        F.when(F.col("triplets"), "triplets"),
        F.when(F.col("syncopation"), "syncopation"),
    )
    return F.when(words == "", "regular rhythmic pattern").otherwise(words)


def rhythm(elements: DataFrame) -> DataFrame:
    """Rhythm words per piece, from the durations of its notes."""
    sounding = elements.filter(F.col("element_type").isin(*SOUNDING)).withColumn("offset", _offset(F.col("duration")))
    flags = sounding.filter("element_type = 'note'").groupBy("doc_id").agg(*_rhythm_flags(F.lit(True)))
    return flags.select("doc_id", _rhythm_words().alias("rhythm"))


def midi_number(pitch: Column) -> Column:
    """Pitch name such as ``C4`` or ``F#5`` to its MIDI number."""
    steps = F.create_map(*[F.lit(x) for pair in zip("CDEFGAB", (0, 2, 4, 5, 7, 9, 11)) for x in pair])
    shift = F.when(F.substring(pitch, 2, 1) == "#", 1).when(F.substring(pitch, 2, 1) == "b", -1).otherwise(0)
    octave = F.regexp_extract(pitch, "([0-9])$", 1).cast("int")
    return (octave + 1) * 12 + F.try_element_at(steps, F.upper(F.substring(pitch, 1, 1))) + shift


def _opening(is_note: Column) -> list[Column]:
    """Aggregates over the notes of a piece, from their number: how many, and the pitches of the first five."""
    return [F.count_if(is_note).alias("n_notes"), *[F.max(F.when(is_note & (F.col("n") == i), F.col("pitch"))).alias(f"pitch{i}") for i in range(1, 6)]]


def _traits() -> Column:
    midi = [midi_number(F.col(f"pitch{i}")) for i in range(1, 6)]
    steps = [after - before for before, after in zip(midi, midi[1:])]
    size = (
        F.when(F.col("n_notes") < 10, "simple melody")
        .when(F.col("n_notes") < 30, "moderate complexity")
        .otherwise("complex passage")
    )
    shape = F.when(F.least(*steps) > 0, "ascending melodic pattern").when(F.greatest(*steps) < 0, "descending melodic pattern")
    return F.concat_ws(", ", size, F.when(F.col("n_notes") >= 4, shape))


def characteristics(elements: DataFrame) -> DataFrame:
    """Complexity by note count, and a rising or falling opening of five notes."""
    order = Window.partitionBy("doc_id").orderBy("pos")
    notes = elements.filter("element_type = 'note'").withColumn("n", F.row_number().over(order))
    return notes.groupBy("doc_id").agg(*_opening(F.lit(True))).select("doc_id", _traits().alias("characteristics"))


def describe(elements: DataFrame, harmony: DataFrame | None = None) -> DataFrame:
    """Sentence used to embed a piece as text; the first time signature counts.

    ``harmony`` (doc_id, tonic, mode, chords array) comes from a pluggable
    analysis; without it the defaults C major and the tonic chord stand in.
    Signature, rhythm and characteristics are one pass over the elements.
    """
    kind = F.col("element_type")
    signed, is_note = kind == "time_sig", F.coalesce(kind == "note", F.lit(False))
    upto = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = elements.withColumns(
        {"offset": _offset(F.when(kind.isin(*SOUNDING), F.col("duration"))), "n": F.count(F.when(is_note, 1)).over(upto)}
    )
    first = F.min_by(F.when(signed, F.coalesce("time_signature", F.lit("4/4"))), F.when(signed, F.col("pos")))
    base = placed.groupBy("doc_id").agg(first.alias("time_signature"), *_rhythm_flags(is_note), *_opening(is_note))
    # A piece without an id has no words of its own, as it meets no harmony either.
    told = F.col("doc_id").isNotNull() & (F.col("n_notes") > 0)
    base = base.select(
        "doc_id", "time_signature", F.when(told, _rhythm_words()).alias("rhythm"), F.when(told, _traits()).alias("characteristics")
    )
    if harmony is not None:
        base = base.join(harmony, "doc_id", "left")
        tonic, mode, chords = F.coalesce("tonic", F.lit("C")), F.coalesce("mode", F.lit("major")), F.slice("chords", 1, 8)
    else:
        tonic, mode, chords = F.lit("C"), F.lit("major"), F.array(F.lit("I"))
    text = F.concat(
        F.lit("Music phrase in "), tonic, F.lit(" "), mode, F.lit(", "), F.coalesce("time_signature", F.lit("4/4")),
        F.lit(" time signature. Harmonic progression: "), F.coalesce(F.array_join(chords, " - "), F.lit("I")),
        F.lit(". Rhythmic pattern: "), F.coalesce("rhythm", F.lit("no rhythmic content")),
        F.lit(". Musical characteristics: "), F.coalesce("characteristics", F.lit("simple melody")), F.lit("."),
    )
    return base.select("doc_id", text.alias("description"))


def page_regions(pages: DataFrame) -> DataFrame:
    """One whole-page region per page of pages(doc_id, page_count, is_music)."""
    return pages.filter("page_count > 0").select(
        "doc_id",
        F.explode(F.sequence(F.lit(1), F.col("page_count").cast("int"))).alias("page_num"),
        F.when(F.col("is_music"), "music").otherwise("text").alias("region_type"),
        F.when(F.col("is_music"), 0.85).otherwise(0.90).alias("confidence"),
    )
