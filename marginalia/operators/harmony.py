"""Key and chords of pieces, from notes that sound: doc_id, pitch, onset, duration.

The key is the one whose profile agrees best with how long each pitch class
sounds. Chords are what sounds together between any two onsets or ends, named
by their Roman numeral in that key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.operators.music import midi_number

# Published probe-tone ratings of the twelve degrees, major and minor.
PROFILES = {
    "major": (6.35, 2.23, 3.48, 2.33, 4.38, 4.09, 2.52, 5.19, 2.39, 3.66, 2.29, 2.88),
    "minor": (6.33, 2.68, 3.52, 5.38, 2.60, 3.53, 2.54, 4.75, 3.98, 2.69, 3.34, 3.17),
}
# Usual names of tonics by pitch class.
TONICS = {
    "major": ("C", "D-", "D", "E-", "E", "F", "F#", "G", "A-", "A", "B-", "B"),
    "minor": ("C", "C#", "D", "E-", "E", "F", "F#", "G", "G#", "A", "B-", "B"),
}
# Triads by the steps above their root, with the form of their numeral.
TRIADS = {(4, 7): "", (3, 7): "", (3, 6): "o", (4, 8): "+"}
UPPER = ((4, 7), (4, 8))
# Degrees by semitones above the tonic, major and minor scale.
DEGREES = {
    "major": ("I", "#I", "II", "#II", "III", "IV", "#IV", "V", "#V", "VI", "#VI", "VII"),
    "minor": ("I", "#I", "II", "III", "#III", "IV", "#IV", "V", "VI", "#VI", "VII", "#VII"),
}
CHORDS = 8
DIGITS = 9
# All numbers that ``midi_number`` gives, C flat 0 to B sharp 9.
MIDI = range(11, 133)


def pitch_class(pitch: Column) -> Column:
    return F.pmod(midi_number(pitch), F.lit(12)).cast("int")


def _standard(profile: tuple[float, ...]) -> list[float]:
    """Ratings less their mean, in units of their length."""
    mean = sum(profile) / 12
    length = math.sqrt(sum((x - mean) ** 2 for x in profile))
    return [(x - mean) / length for x in profile]


def key_profiles() -> Column:
    """Array of 24 keys: place, name, mode and the ratings of the 12 pitch classes."""
    keys = []
    for place, (mode, profile) in enumerate(PROFILES.items()):
        rated = _standard(profile)
        for tonic in range(12):
            ratings = F.array(*[F.lit(rated[(pc - tonic) % 12]) for pc in range(12)])
            keys.append(F.struct(F.lit(12 * place + tonic).alias("place"), F.lit(TONICS[mode][tonic]).alias("name"), F.lit(mode).alias("mode"), ratings.alias("ratings")))
    return F.array(*keys)


def keys_of(notes: DataFrame) -> DataFrame:
    """doc_id, tonic, mode, fit (correlation). Equal fits go to major keys and lower tonics first.

    A piece whose pitch classes all sound equally long has no key and is C major.
    One aggregate by piece gives the twelve weights; the keys are tried on that row.
    """
    heard = notes.select("doc_id", pitch_class(F.col("pitch")).alias("pc"), "duration").filter("doc_id IS NOT NULL AND pc IS NOT NULL")
    weights = heard.groupBy("doc_id").agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col("pc") == pc, F.col("duration"))), F.lit(0)).cast("double") for pc in range(12)]).alias("w")
    )
    zero = F.lit(0.0)
    # Profiles have mean zero, so the weights' own mean cancels in the sum; it only counts in their length.
    squares, total = (F.aggregate("w", zero, f) for f in (lambda s, w: s + w * w, lambda s, w: s + w))
    length = F.sqrt(F.greatest(zero, squares - total * total / 12))

    def tried(key: Column) -> Column:
        agreement = F.aggregate(F.zip_with("w", key["ratings"], lambda w, r: w * r), zero, lambda s, x: s + x)
        fit = F.when(F.col("length") > 1e-9, F.round(agreement / F.col("length"), DIGITS)).otherwise(0.0)
        return F.struct(fit.alias("fit"), (-key["place"]).alias("order"), key["name"].alias("name"), key["mode"].alias("mode"))

    best = weights.withColumn("length", length).select("doc_id", F.array_max(F.transform(key_profiles(), tried)).alias("k"))
    return best.select("doc_id", F.when(F.col("k.fit") == 0.0, "C").otherwise(F.col("k.name")).alias("tonic"),
                       F.when(F.col("k.fit") == 0.0, "major").otherwise(F.col("k.mode")).alias("mode"), F.col("k.fit").alias("fit"))


def sonorities(notes: DataFrame) -> DataFrame:
    """doc_id, start, classes (sorted pitch classes), bass: what sounds between neighbouring onsets and ends.

    A sweep over the events of a piece: the cuts are its distinct onsets and
    ends, and running sums of what begins and ends there say what sounds on.
    Both steps go by piece, and no note is repeated for the stretches it covers.
    """
    heard = notes.select(
        "doc_id", midi_number(F.col("pitch")).alias("midi"), F.col("onset").alias("begin"), (F.col("onset") + F.col("duration")).alias("end")
    ).filter("doc_id IS NOT NULL AND midi IS NOT NULL AND end > begin")
    turns = F.array(F.struct(F.col("begin").alias("start"), F.lit(1).alias("change")), F.struct(F.col("end").alias("start"), F.lit(-1).alias("change")))
    events = heard.select("doc_id", "midi", F.inline(turns))
    counted = {f"class{c}": F.pmod("midi", F.lit(12)) == c for c in range(12)} | {f"midi{m}": F.col("midi") == m for m in MIDI}
    cuts = events.groupBy("doc_id", "start").agg(*[F.sum(F.when(is_it, F.col("change"))).alias(name) for name, is_it in counted.items()])
    upto = Window.partitionBy("doc_id").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    sums = cuts.select("doc_id", "start", *[F.sum(name).over(upto).alias(name) for name in counted])
    sounding = sums.filter(F.greatest(*[f"class{c}" for c in range(12)]) > 0).withColumns({name: F.col(name) > 0 for name in counted})
    classes = F.array_compact(F.array(*[F.when(F.col(f"class{c}"), F.lit(c)) for c in range(12)]))
    bass = F.coalesce(*[F.when(F.col(f"midi{m}"), F.lit(m % 12)) for m in MIDI])
    return sounding.select("doc_id", "start", classes.alias("classes"), bass.alias("bass"))


def triads() -> list[tuple[list[int], int, str, bool]]:
    """Sorted pitch classes, root, mark and case of all triads; an augmented one takes its lowest class as root."""
    found = {}
    for root in range(12):
        for steps, mark in TRIADS.items():
            classes = tuple(sorted((root + s) % 12 for s in (0, *steps)))
            found.setdefault(classes, (list(classes), root, mark, steps in UPPER))
    return list(found.values())


def _figured(notes: DataFrame, keys: DataFrame) -> DataFrame:
    """keys with the numerals of the first triads of each piece.

    Within a piece equal numerals are equal triads, so repeats go before the key
    is known, and only the few chords that stay meet it.
    """
    spark = notes.sparkSession
    shapes = spark.createDataFrame(triads(), "classes array<int>, root int, mark string, upper boolean")
    order = Window.partitionBy("doc_id").orderBy("start")
    named = sonorities(notes).select("doc_id", "start", "classes").join(F.broadcast(shapes), "classes")
    changes = named.withColumn("last", F.lag("classes").over(order)).filter(~F.col("classes").eqNullSafe(F.col("last")))
    kept = changes.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= CHORDS)
    listed = kept.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("n", "root", "mark", "upper"))).alias("triads"))
    tonic = F.create_map(*[F.lit(x) for m, names in TONICS.items() for pc, name in enumerate(names) for x in (f"{name} {m}", pc)])
    degrees = F.create_map(*[x for m, names in DEGREES.items() for x in (F.lit(m), F.array(*map(F.lit, names)))])
    based = keys.join(listed, "doc_id", "left").withColumns(
        {"_pc": F.try_element_at(tonic, F.concat_ws(" ", "tonic", "mode")), "_degrees": F.try_element_at(degrees, F.col("mode"))}
    )

    def numeral(chord: Column) -> Column:
        degree = F.get(F.col("_degrees"), F.pmod(chord["root"] - F.col("_pc"), F.lit(12)).cast("int"))
        return F.concat(F.when(chord["upper"], degree).otherwise(F.lower(degree)), chord["mark"])

    found = F.when(F.col("_pc").isNotNull(), F.transform("triads", numeral))
    return based.withColumn("chords", F.coalesce(found, F.array(F.lit("I")))).drop("_pc", "_degrees", "triads")


def progressions(notes: DataFrame, keys: DataFrame) -> DataFrame:
    """doc_id, chords: numerals of the triads of a piece in order, repeats in a row once, at most eight.

    Other sonorities are passed over; a piece without a triad gets I.
    """
    return _figured(notes, keys).select("doc_id", "chords")


def analysis(notes: DataFrame) -> DataFrame:
    """doc_id, tonic, mode, chords: what ``music.describe`` takes as harmony."""
    return _figured(notes, keys_of(notes)).select("doc_id", "tonic", "mode", "chords")
