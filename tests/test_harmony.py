"""Onsets of polyphonic scores, keys and chords."""

import pytest

from marginalia.operators import harmony, music
from marginalia.sources.musicxml import sounding, timeline


def note(step, octave, duration, extra="", voice=1, alter=None):
    alter = "" if alter is None else f"<alter>{alter}</alter>"
    return f"<note>{extra}<pitch><step>{step}</step>{alter}<octave>{octave}</octave></pitch><duration>{duration}</duration><voice>{voice}</voice></note>"


def score(*measures, parts=None):
    bodies = parts or [measures]
    out = []
    for p, body in enumerate(bodies):
        inner = "".join(f'<measure number="{i + 1}">{m}</measure>' for i, m in enumerate(body))
        out.append(f'<part id="P{p}">{inner}</part>')
    return f"<score-partwise>{''.join(out)}</score-partwise>"


DIVISIONS = "<attributes><divisions>2</divisions></attributes>"


def told(spark, xml):
    rows = timeline(spark.createDataFrame([("d", xml)], "doc_id string, xml string")).orderBy("part", "n").collect()
    return [(r["pitch"], r["onset"], r["duration"], r["voice"]) for r in rows]


def test_chords_voices_and_grace_notes(spark):
    xml = score(
        DIVISIONS + note("C", 4, 2) + note("E", 4, 2, "<chord/>") + note("G", 4, 2, "<chord/>")
        + "<note><grace/><pitch><step>A</step><octave>4</octave></pitch><voice>1</voice></note>" + note("F", 4, 6, alter=1)
        + "<backup><duration>8</duration></backup>" + note("C", 3, 4, voice=2) + "<forward><duration>2</duration></forward>" + note("D", 3, 2, voice=2),
        note("B", 4, 8, alter=-1),
    )
    assert told(spark, xml) == [
        ("C4", 0.0, 1.0, "1"), ("E4", 0.0, 1.0, "1"), ("G4", 0.0, 1.0, "1"), ("A4", 1.0, 0.0, "1"), ("F#4", 1.0, 3.0, "1"),
        ("C3", 0.0, 2.0, "2"), ("D3", 3.0, 1.0, "2"), ("Bb4", 4.0, 4.0, "1"),
    ]


def test_parts_share_bar_lines_and_ties_sound_once(spark):
    one = [DIVISIONS + note("C", 4, 8, '<tie type="start"/>'), note("C", 4, 2, '<tie type="stop"/>') + "<note><rest/><duration>6</duration></note>"]
    two = [note("E", 4, 1) + note("F", 4, 1), note("G", 4, 4)]
    xml = score(parts=[one, two])
    assert told(spark, xml) == [("C4", 0.0, 4.0, "1"), ("C4", 4.0, 1.0, "1"), (None, 5.0, 3.0, "1"), ("E4", 0.0, 1.0, "1"), ("F4", 1.0, 1.0, "1"), ("G4", 4.0, 4.0, "1")]
    heard = sounding(timeline(spark.createDataFrame([("d", xml)], "doc_id string, xml string"))).collect()
    assert sorted((r["pitch"], r["onset"], r["duration"]) for r in heard) == [("C4", 0.0, 5.0), ("E4", 0.0, 1.0), ("F4", 1.0, 1.0), ("G4", 4.0, 4.0)]


def notes(spark, pieces):
    rows = [(d, p, float(o), float(n)) for d, piece in pieces.items() for p, o, n in piece]
    return spark.createDataFrame(rows, "doc_id string, pitch string, onset double, duration double")


def scale(names, octave=4):
    return [(f"{n}{octave}", i, 2 if i in (0, 4, 7) else 1) for i, n in enumerate(names)]


def test_keys(spark):
    pieces = {
        "c": scale("C D E F G A B C".split()),
        "a": scale("A B C D E F G# A".split()),
        "d": scale("D E F# G A B C# D".split()),
        "eb": scale("Eb F G Ab Bb C D Eb".split()),
        "flat": [(f"{p}4", i, 1) for i, p in enumerate("C C# D D# E F F# G G# A A# B".split())],
    }
    got = {r["doc_id"]: (r["tonic"], r["mode"]) for r in harmony.keys_of(notes(spark, pieces)).collect()}
    assert got == {"c": ("C", "major"), "a": ("A", "minor"), "d": ("D", "major"), "eb": ("E-", "major"), "flat": ("C", "major")}


def chord(names, at, length=1):
    return [(n, at, length) for n in names.split()]


def test_progressions(spark):
    piece = chord("C4 E4 G4", 0, 2) + chord("C4 F4 A4", 2) + chord("B3 D4 G4", 3) + chord("B3 D4 G4", 4) + chord("C4 E4 G4 C5", 5, 4)
    moving = chord("C4 G4", 0, 4) + [("E4", 0, 1), ("D4", 1, 1), ("E4", 2, 2)]
    many = [n for i in range(20) for n in chord("C4 E4 G4" if i % 2 else "D4 F4 A4", i)]
    found = notes(spark, {"x": piece, "held": moving, "many": many, "one": [("C4", 0, 1)]})
    keys = spark.createDataFrame([(d, "C", "major") for d in ("x", "held", "many", "one")], "doc_id string, tonic string, mode string")
    got = {r["doc_id"]: r["chords"] for r in harmony.progressions(found, keys).collect()}
    # A passing tone makes no triad, so the chord before and after it is one.
    assert got == {"x": ["I", "IV", "V", "I"], "held": ["I"], "many": ["ii", "I"] * 4, "one": ["I"]}
    minor = spark.createDataFrame([("x", "A", "minor")], "doc_id string, tonic string, mode string")
    assert harmony.progressions(found.filter("doc_id = 'x'"), minor).first()["chords"] == ["III", "VI", "VII", "III"]


def test_sonorities_of_a_sweep(spark):
    # Two notes of one pitch overlap, and a gap is silent.
    found = notes(spark, {"p": [("C4", 0, 2), ("C4", 1, 3), ("G3", 1, 1), ("E5", 6, 1)], None: [("C4", 0, 1)]})
    got = [tuple(r) for r in harmony.sonorities(found).orderBy("start").collect()]
    assert got == [("p", 0.0, [0], 0), ("p", 1.0, [0, 7], 7), ("p", 2.0, [0], 0), ("p", 6.0, [4], 4)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_chords_need_no_exchange_of_notes(spark):
    found = notes(spark, {"x": chord("C4 E4 G4", 0, 2)}).repartition(4, "doc_id")
    plan = plan_of(harmony.progressions(found, harmony.keys_of(found)))
    # The two given ones, and the broadcast table of triads; notes are not repeated per stretch.
    assert plan.count("Exchange hashpartitioning") == 2 and "sequence" not in plan


def test_description_uses_the_analysis(spark):
    piece = chord("A3 C4 E4", 0, 2) + chord("D4 F4 A4", 2, 2) + chord("E4 G#4 B4", 4, 2) + chord("A3 C4 E4", 6, 2)
    found = notes(spark, {"m": piece})
    elements = spark.createDataFrame(
        [("m", 0, "note", 1, "A3", 2.0, None, None)],
        "doc_id string, pos long, element_type string, measure_number long, pitch string, duration double, sharps int, time_signature string",
    )
    text = music.describe(elements, harmony.analysis(found)).first()["description"]
    assert text.startswith("Music phrase in A minor, 4/4 time signature. Harmonic progression: i - iv - V - i.")


ELEMENTS = "doc_id string, pos long, element_type string, measure_number long, pitch string, duration double, sharps int, time_signature string"


def test_description_is_one_pass_over_the_elements(spark):
    rising = [("up", i, "note", 1 + i // 4, f"{p}4", 1.5, None, None) for i, p in enumerate("CDEFG")]
    # A null pitch among the first notes breaks neither steps nor counts; a rest shifts what follows off the beat.
    falling = [("down", i, "note", 1, p, 2.0, None, None) for i, p in enumerate(["G4", None, "E4", "D4"])] + [("down", 9, "rest", 2, None, 0.5, None, None), ("down", 10, "note", 2, "B3", 1.0, None, None)]
    others = [("rests", 0, "rest", 1, None, 4.0, None, None), ("rests", 1, "time_sig", 1, None, None, None, "3/4"), (None, 0, "note", 1, "C4", 1.0, None, None), ("odd", 0, "note", 1, "C4", None, None, None)]
    elements = spark.createDataFrame(rising + falling + others, ELEMENTS)
    found = music.describe(elements)
    got = {r["doc_id"]: r["description"].split("Rhythmic pattern: ")[1] for r in found.collect()}
    assert got == {
        "up": "quarter notes, dotted rhythms, syncopation. Musical characteristics: simple melody, ascending melodic pattern.",
        "down": "half notes, quarter notes, syncopation. Musical characteristics: simple melody, descending melodic pattern.",
        "rests": "no rhythmic content. Musical characteristics: simple melody.",
        None: "no rhythmic content. Musical characteristics: simple melody.",
        "odd": "regular rhythmic pattern. Musical characteristics: simple melody.",
    }
    parts = {r["doc_id"]: r["rhythm"] for r in music.rhythm(elements).collect()}
    assert all(got[d].startswith(f"{parts[d]}.") for d in ("up", "down", "odd"))
    plan = plan_of(music.describe(elements))
    assert plan.count("Exchange") == 1 and "Join" not in plan
