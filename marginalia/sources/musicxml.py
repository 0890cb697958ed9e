"""MusicXML documents to music elements, with Spark's own XML functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NOTE = (
    "struct<rest:string,chord:string,grace:string,pitch:struct<step:string,alter:int,octave:int>,duration:double,"
    "voice:string,tie:array<struct<_type:string>>,type:string>"
)
ATTRIBUTES = "struct<divisions:double,key:struct<fifths:int>,time:struct<beats:string,`beat-type`:string>>"
MEASURE = f"struct<_number:int,attributes:{ATTRIBUTES},note:array<{NOTE}>>"
SCORE = f"struct<part:array<struct<_id:string,measure:array<{MEASURE}>>>>"


def musicxml_elements(scores: DataFrame) -> DataFrame:
    """scores(doc_id, xml) to element rows.

    Durations are in quarter notes: a part's divisions hold until they change.
    """
    parsed = scores.select("doc_id", F.from_xml("xml", SCORE).alias("score"))
    measures = parsed.select("doc_id", F.posexplode("score.part").alias("part", "p")).select(
        "doc_id", "part", F.posexplode("p.measure").alias("place", "m")
    )
    order = F.col("part") * F.lit(1_000_000_000_000).cast("long") + F.col("place") * F.lit(1_000_000).cast("long")
    sofar = Window.partitionBy("doc_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    based = measures.withColumn(
        "divisions", F.coalesce(F.last("m.attributes.divisions", ignorenulls=True).over(sofar), F.lit(1.0))
    ).withColumn("base", order)
    number = F.coalesce("m._number", F.col("place") + 1).cast("long")
    blank_text, blank_int = F.lit(None).cast("string"), F.lit(None).cast("int")
    key = based.filter("m.attributes.key.fifths IS NOT NULL").select(
        "doc_id", F.col("base").alias("pos"), F.lit("key_sig").alias("element_type"), number.alias("measure_number"),
        blank_text.alias("pitch"), F.lit(None).cast("double").alias("duration"),
        F.col("m.attributes.key.fifths").alias("sharps"), blank_text.alias("time_signature"),
    )
    time = based.filter("m.attributes.time.beats IS NOT NULL").select(
        "doc_id", (F.col("base") + 1).alias("pos"), F.lit("time_sig").alias("element_type"), number.alias("measure_number"),
        blank_text.alias("pitch"), F.lit(None).cast("double").alias("duration"), blank_int.alias("sharps"),
        F.concat_ws("/", "m.attributes.time.beats", "m.attributes.time.`beat-type`").alias("time_signature"),
    )
    notes = based.select("doc_id", "base", "divisions", number.alias("measure_number"), F.posexplode("m.note").alias("i", "n"))
    sign = F.when(F.col("n.pitch.alter") == 1, "#").when(F.col("n.pitch.alter") == -1, "b").otherwise("")
    pitched = F.col("n.pitch.step").isNotNull()
    sounding = notes.select(
        "doc_id",
        (F.col("base") + F.col("i") + 2).alias("pos"),
        F.when(pitched, "note").otherwise("rest").alias("element_type"),
        "measure_number",
        F.when(pitched, F.concat("n.pitch.step", sign, F.col("n.pitch.octave").cast("string"))).alias("pitch"),
        (F.col("n.duration") / F.col("divisions")).alias("duration"),
        blank_int.alias("sharps"),
        blank_text.alias("time_signature"),
    )
    return key.unionByName(time).unionByName(sounding)


# A measure's events in their order: notes, and the moves of the cursor between voices.
EVENT = r"(?s)<(note|backup|forward)\b[^>]*?(?:/>|>(.*?)</\1>)"


def timeline(scores: DataFrame) -> DataFrame:
    """Notes of scores(doc_id, xml) with their onset in quarter notes from the start of the piece.

    doc_id, part, measure_number, voice, n (order in the part), pitch, onset,
    duration, grace, tie_start, tie_stop; rests have no pitch. A chord member
    starts with the note before it and moves nothing, a grace note lasts no
    time, ``backup`` and ``forward`` move the cursor. Measures begin where the
    longest voice of the one before ends. Windows stay within one part of one
    document, which is one row of its source.
    """
    parts = scores.select("doc_id", F.posexplode(F.expr(r"regexp_extract_all(xml, '(?s)<part\\b[^>]*>(.*?)</part>', 1)")).alias("part", "body"))
    measures = parts.select(
        "doc_id", "part", F.posexplode(F.expr(r"regexp_extract_all(body, '(?s)<measure\\b([^>]*>.*?)</measure>', 1)")).alias("place", "m")
    )
    whole = Window.partitionBy("doc_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    divisions = F.regexp_extract("m", r"<divisions>\s*([0-9.]+)", 1)
    based = measures.withColumns(
        {
            "divisions": F.coalesce(F.last(F.when(divisions != "", divisions.cast("double")), ignorenulls=True).over(whole), F.lit(1.0)),
            "measure_number": F.coalesce(F.try_to_number(F.regexp_extract("m", r'number="([0-9]+)"', 1), F.lit("999999")).cast("long"), F.col("place") + 1),
        }
    )
    events = based.select(
        "doc_id", "part", "place", "measure_number", "divisions", F.posexplode(F.regexp_extract_all("m", F.lit(EVENT), F.lit(0))).alias("i", "e")
    )

    def tag(name: str) -> Column:
        found = F.regexp_extract("e", rf"(?s)<{name}>\s*(.*?)\s*</{name}>", 1)
        return F.when(found != "", found)

    def has(name: str) -> Column:
        return F.col("e").rlike(rf"<{name}\b")

    length = F.coalesce(tag("duration").cast("double") / F.col("divisions"), F.lit(0.0))
    alter = tag("alter").cast("double").cast("int")
    sign = F.when(alter > 0, F.repeat(F.lit("#"), alter)).when(alter < 0, F.repeat(F.lit("b"), -alter)).otherwise("")
    told = events.select(
        "doc_id",
        "part",
        "place",
        "measure_number",
        "i",
        F.regexp_extract("e", r"^<(\w+)", 1).alias("kind"),
        F.when(has("step"), F.concat(tag("step"), sign, tag("octave"))).alias("pitch"),
        F.coalesce(tag("voice"), F.lit("1")).alias("voice"),
        has("grace").alias("grace"),
        has("chord").alias("chord"),
        F.col("e").rlike(r'<tie [^>]*type="start"').alias("tie_start"),
        F.col("e").rlike(r'<tie [^>]*type="stop"').alias("tie_stop"),
        F.when(has("grace"), 0.0).otherwise(length).alias("duration"),
    )
    # How far each event moves the cursor; a chord member does not.
    move = F.when(F.col("kind") == "backup", -F.col("duration")).when(F.col("chord"), 0.0).otherwise(F.col("duration"))
    inside = Window.partitionBy("doc_id", "part", "place").orderBy("i")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    moved = told.withColumn("move", move).withColumn("at", F.coalesce(F.sum("move").over(before), F.lit(0.0)))
    # A chord member starts where the last note that is no member does.
    lead = F.last(F.when((F.col("kind") == "note") & ~F.col("chord"), F.col("at")), ignorenulls=True)
    placed = moved.withColumn("at", F.when(F.col("chord"), lead.over(inside.rowsBetween(Window.unboundedPreceding, 0))).otherwise(F.col("at")))
    ends = placed.groupBy("doc_id", "part", "place").agg(F.max(F.when(F.col("kind") != "backup", F.col("at") + F.col("duration"))).alias("size"))
    # All parts share their bar lines: a measure lasts as long as the longest part of it.
    sizes = ends.groupBy("doc_id", "place").agg(F.max("size").alias("size"))
    earlier = Window.partitionBy("doc_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("doc_id", "place", F.coalesce(F.sum("size").over(earlier), F.lit(0.0)).alias("start"))
    order = Window.partitionBy("doc_id", "part").orderBy("place", "i")
    return (
        placed.join(starts, ["doc_id", "place"])
        .filter("kind = 'note'")
        .select(
            "doc_id", "part", "measure_number", "voice", F.row_number().over(order).alias("n"), "pitch",
            (F.col("start") + F.col("at")).alias("onset"), "duration", "grace", "tie_start", "tie_stop",
        )
    )


def sounding(notes: DataFrame) -> DataFrame:
    """Notes of a timeline as they sound: tied ones are one note, rests and grace notes are left out.

    doc_id, part, voice, pitch, onset, duration.
    """
    keys = ["doc_id", "part", "voice", "pitch"]
    order = Window.partitionBy(*keys).orderBy("onset", "n")
    heard = notes.filter(F.col("pitch").isNotNull() & ~F.col("grace"))
    ended = F.lag(F.col("onset") + F.col("duration")).over(order)
    goes_on = F.col("tie_stop") & F.coalesce(F.lag("tie_start").over(order) & (F.abs(ended - F.col("onset")) < 1e-9), F.lit(False))
    run = F.sum(F.when(goes_on, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        heard.withColumn("run", run)
        .groupBy(*keys, "run")
        .agg(F.min("onset").alias("onset"), (F.max(F.col("onset") + F.col("duration")) - F.min("onset")).alias("duration"))
        .drop("run")
    )
