"""Formulas and music, derived from the lines and words of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginalia.functions import formulas as fx
from marginalia.functions.text import tokenize
from marginalia.operators import formulas, harmony, music
from marginalia.plans.registry import query, table, texts, texts_by_id
from marginalia.plans.relations import TOKEN_SQL

# --- formulas: every line of a document is one ------------------------------


def _formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = texts(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    n = F.length("line")
    word = F.translate(F.substring_index("line", " ", 1), "{}$^_\\", "")
    latex = F.concat(
        F.lit("  \\alpha_{"), word, F.lit("}^{"), n.cast("string"), F.lit("} \\leq\n \\frac{\\pi}{"), word,
        F.lit("} \\quad \\sqrt{"), n.cast("string"), F.lit("} \\infty\\,"), F.when(n % 7 == 0, "").otherwise("{x}"),
        F.when(n % 11 == 0, "}").otherwise(""),
    )
    return lines.filter("line <> ''").select(
        "doc_id",
        F.col("pos").cast("long").alias("pos"),
        F.floor(F.col("pos") / 5).alias("page_num"),
        (n % 97).cast("double").alias("x1"),
        (n % 53).cast("double").alias("y1"),
        F.when(n % 2 == 0, "inline").otherwise("display").alias("kind"),
        latex.alias("latex"),
    )


FORMULA_SQL = r"""
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents
),
words AS (
  SELECT *, length(line) AS n, translate(split_part(line, ' ', 1), '{}$^_\', '') AS w FROM lines WHERE line <> ''
),
formulas AS (
  SELECT doc_id, pos, pos // 5 AS page_num, n % 97 AS x1, n % 53 AS y1,
         CASE WHEN n % 2 = 0 THEN 'inline' ELSE 'display' END AS kind,
         '  \alpha_{' || w || '}^{' || n || '} \leq' || chr(10) || ' \frac{\pi}{' || w || '} \quad \sqrt{' || n || '} \infty\,'
         || CASE WHEN n % 7 = 0 THEN '' ELSE '{x}' END || CASE WHEN n % 11 = 0 THEN '}' ELSE '' END AS latex,
         'W' || w AS tag, n, w
  FROM words
)"""


@query(
    "formula_counts",
    """
WITH c AS (
  SELECT doc_id, ((length(t) - length(replace(t, '$$', ''))) // 2) // 2 AS display, length(t) - length(replace(t, '$', '')) AS dollars
  FROM (SELECT doc_id, replace(text, '. ', ' $$ ') || CASE WHEN doc_id % 3 = 0 THEN ' $x$' ELSE '' END AS t FROM documents)
)
SELECT doc_id, display::BIGINT AS display, ((dollars - display * 4) // 2)::BIGINT AS inline,
       (display + (dollars - display * 4) // 2)::BIGINT AS total,
       CASE WHEN display + (dollars - display * 4) // 2 > 0
            THEN doc_id || '_formula_0001_' || format('{:03d}', (display + (dollars - display * 4) // 2)::BIGINT) ELSE '' END AS last_id FROM c
""",
)
def formula_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose sentence ends were turned into display fences."""
    body = F.concat(
        F.replace("text", F.lit(". "), F.lit(" $$ ")), F.when(F.col("doc_id") % 3 == 0, " $x$").otherwise("")
    )
    counted = table(spark, sf_dir, "documents").select("doc_id", fx.formula_counts(body).alias("c"))
    ids = fx.formula_ids(F.col("doc_id").cast("string"), F.lit(1), F.col("c.total"))
    return counted.select(
        "doc_id",
        F.col("c.display").cast("long").alias("display"),
        F.col("c.inline").cast("long").alias("inline"),
        F.col("c.total").cast("long").alias("total"),
        F.coalesce(F.try_element_at(ids, F.lit(-1)), F.lit("")).alias("last_id"),
    )


@query(
    "latex_format",
    f"""
WITH {FORMULA_SQL}, c AS (SELECT *, trim(regexp_replace(latex, '\\s+', ' ', 'g')) AS b FROM formulas)
SELECT doc_id, pos, format('formula_{{:04d}}_{{:04d}}', page_num, pos) AS formula_id,
       CASE WHEN n % 11 = 0 THEN '' ELSE CASE WHEN kind = 'inline' THEN '$' || b || '$' ELSE '$$' || b || '$$' END END AS formatted,
       CASE WHEN n % 11 = 0 THEN 'unbalanced braces' ELSE '' END AS error FROM c
""",
)
def latex_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _formulas(spark, sf_dir)
    return rows.select(
        "doc_id",
        "pos",
        fx.element_id(F.col("page_num"), F.col("pos")).alias("formula_id"),
        F.coalesce(fx.format_latex(F.col("latex"), F.col("kind")), F.lit("")).alias("formatted"),
        F.coalesce(fx.latex_error(fx.clean_latex(F.col("latex"))), F.lit("")).alias("error"),
    )


@query(
    "latex_plaintext",
    f"""
WITH {FORMULA_SQL}
SELECT doc_id, pos, 'alpha' || CASE WHEN w = '' THEN '_' ELSE '_' || w END || '^' || n || ' <= /pi' || w || ' sqrt' || n || ' infinity'
       || CASE WHEN n % 7 = 0 THEN '' ELSE ' x' END AS plain FROM formulas
""",
)
def latex_plaintext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _formulas(spark, sf_dir).select("doc_id", "pos", fx.latex_to_plain(F.col("latex")).alias("plain"))


@query(
    "formula_summary",
    f"""
WITH {FORMULA_SQL}
SELECT doc_id, count(*) AS formula_count, count(*) FILTER (kind = 'inline') AS inline_count, count(*) FILTER (kind = 'display') AS display_count,
       CASE WHEN count(*) < 5 THEN 'simple' WHEN count(*) < 15 THEN 'moderate' ELSE 'complex' END AS complexity
FROM formulas GROUP BY doc_id
""",
)
def formula_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formulas.summarize(_formulas(spark, sf_dir))


@query(
    "formula_page_index",
    f"""
WITH {FORMULA_SQL}
SELECT doc_id, pos, page_num, row_number() OVER (PARTITION BY doc_id, page_num ORDER BY y1, x1, pos) AS page_index FROM formulas
""",
)
def formula_page_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formulas.number_by_page(_formulas(spark, sf_dir)).select("doc_id", "pos", "page_num", "page_index")


@query(
    "formula_merge",
    f"""
WITH {FORMULA_SQL},
num AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_num ORDER BY y1, x1, pos) AS i FROM formulas),
ent AS (SELECT doc_id, page_num, i, CASE WHEN kind = 'inline' THEN 'Formula ' || i || ': $' || latex || '$' || chr(10)
          ELSE 'Formula ' || i || ':' || chr(10) || '$$' || chr(10) || latex || chr(10) || '$$' || chr(10) END AS t FROM num),
pg AS (SELECT doc_id, page_num, chr(10) || '## Formulas from Page ' || (page_num + 1) || chr(10) || chr(10) || string_agg(t, chr(10) ORDER BY i) AS s FROM ent GROUP BY doc_id, page_num),
doc AS (SELECT doc_id, string_agg(s, chr(10) ORDER BY page_num) AS s FROM pg GROUP BY doc_id)
SELECT d.doc_id, md5(text || coalesce(chr(10) || s, '')) AS digest FROM documents d LEFT JOIN doc ON doc.doc_id = d.doc_id
""",
)
def formula_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("markdown"))
    merged = formulas.merge_into_markdown(docs, _formulas(spark, sf_dir))
    return merged.select("doc_id", F.md5(F.col("markdown").cast("binary")).alias("digest"))


@query(
    "formula_appendix",
    f"""
WITH {FORMULA_SQL},
num AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i, regexp_replace(latex, '^\\s+|\\s+$', '', 'g') AS b FROM formulas),
doc AS (SELECT doc_id, string_agg(CASE WHEN kind = 'inline' THEN 'Formula ' || i || ' (page ' || (page_num + 1) || '): $' || b || '$' || chr(10) || chr(10)
   ELSE 'Formula ' || i || ' (page ' || (page_num + 1) || '):' || chr(10) || chr(10) || '$$' || b || '$$' || chr(10) || chr(10) END, '' ORDER BY i) AS s FROM num GROUP BY doc_id)
SELECT d.doc_id, md5(coalesce(text || chr(10) || chr(10) || '## Mathematical Formulas' || chr(10) || chr(10) || s, text)) AS digest
FROM documents d LEFT JOIN doc ON doc.doc_id = d.doc_id
""",
)
def formula_appendix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("markdown"))
    merged = formulas.appendix(docs, _formulas(spark, sf_dir))
    return merged.select("doc_id", F.md5(F.col("markdown").cast("binary")).alias("digest"))


@query(
    "formula_regions",
    """
WITH b AS (SELECT event_id, value AS x1, value / 2 AS y1, value + user_id * 4 AS x2, value / 2 + 1 + event_id % 60 AS y2 FROM events)
SELECT event_id, CASE WHEN abs((x1 + x2) / 2 - 500) < 200 AND x2 - x1 > 300 THEN 'display' ELSE 'inline' END AS kind FROM b
WHERE (x2 - x1) * (y2 - y1) >= 200 AND (x2 - x1) / greatest(y2 - y1, 1) BETWEEN 0.5 AND 20
""",
)
def formula_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as boxes on a page 1000 wide."""
    boxes = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("value").alias("x1"),
        (F.col("value") / 2).alias("y1"),
        (F.col("value") + F.col("user_id") * 4).alias("x2"),
        (F.col("value") / 2 + 1 + F.col("event_id") % 60).alias("y2"),
    )
    kept = boxes.filter(fx.region_kept(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")))
    return kept.select("event_id", fx.region_kind(F.col("x1"), F.col("x2"), F.lit(1000.0)).alias("kind"))


# --- music: the words of a document are the notes of a piece -----------------


def _music(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words starting with a..g are notes, others rests; every 50 words a key
    and a time signature. Four elements make a measure."""
    words = texts_by_id(spark, sf_dir).select("doc_id", F.posexplode(tokenize(F.col("text"))).alias("pos", "word"))
    n = F.length("word")
    kind = (
        F.when(F.col("pos") % 50 == 7, "key_sig")
        .when(F.col("pos") % 50 == 8, "time_sig")
        .when(F.substring("word", 1, 1).between("a", "g"), "note")
        .otherwise("rest")
    )
    words = words.withColumn("element_type", kind)
    kind = F.col("element_type")
    sign = F.when(F.substring("word", 2, 1) == "r", "#").when(F.substring("word", 2, 1) == "n", "b").otherwise("")
    pitch = F.concat(F.upper(F.substring("word", 1, 1)), sign, (n % 4 + 2).cast("string"))
    lengths = F.array(*[F.lit(x) for x in (0.5, 1.0, 2.0, 1.5, 0.25, 4.0)])
    return words.select(
        "doc_id",
        F.col("pos").cast("long").alias("pos"),
        "element_type",
        (F.floor(F.col("pos") / 4) + 1).alias("measure_number"),
        F.when(kind == "note", pitch).alias("pitch"),
        F.when(kind.isin("note", "rest"), F.get(lengths, n % 6)).alias("duration"),
        F.when(kind == "key_sig", (n % 7 - 3).cast("int")).alias("sharps"),
        F.when(kind == "time_sig", F.concat((n % 3 + 2).cast("string"), F.lit("/4"))).alias("time_signature"),
    )


MUSIC_SQL = (
    TOKEN_SQL
    + """,
el0 AS (
  SELECT doc_id, unnest(tokens) AS word, unnest(range(0, len(tokens))) AS pos FROM tok
),
el1 AS (
  SELECT doc_id, pos, word, length(word) AS n, pos // 4 + 1 AS m,
         CASE WHEN pos % 50 = 7 THEN 'key_sig' WHEN pos % 50 = 8 THEN 'time_sig'
              WHEN substr(word, 1, 1) IN ('a','b','c','d','e','f','g') THEN 'note' ELSE 'rest' END AS et FROM el0
),
el AS (
  SELECT doc_id, pos, m, et, n,
         upper(substr(word, 1, 1)) AS letter, CASE substr(word, 2, 1) WHEN 'r' THEN '#' WHEN 'n' THEN 'b' ELSE '' END AS acc,
         n % 4 + 2 AS octave, CASE WHEN et IN ('note', 'rest') THEN [0.5, 1.0, 2.0, 1.5, 0.25, 4.0][(n % 6) + 1]::DOUBLE END AS d,
         n % 7 - 3 AS sharps, (n % 3 + 2) || '/4' AS ts FROM el1
),
summ AS (
  SELECT doc_id, count(*) AS n_elements, count(*) FILTER (et = 'note') AS n_notes, count(*) FILTER (et = 'rest') AS n_rests,
         count(DISTINCT m) FILTER (et IN ('note', 'rest')) AS n_measures, count(DISTINCT m) AS measure_count,
         arg_max(sharps, pos) FILTER (et = 'key_sig') AS sharps, arg_max(ts, pos) FILTER (et = 'time_sig') AS ts
  FROM el GROUP BY doc_id
)"""
)

KEY_SQL = """CASE sharps WHEN 0 THEN 'C Major' WHEN 1 THEN 'G Major' WHEN -1 THEN 'F Major' WHEN 2 THEN 'D Major'
  WHEN -2 THEN 'Bb Major' ELSE sharps || ' sharps' END"""


@query(
    "music_metadata",
    f"""
WITH {MUSIC_SQL}
SELECT doc_id, n_elements, n_notes, n_rests, n_measures, measure_count, greatest(1, measure_count // 4) AS phrase_count,
       coalesce(CASE WHEN sharps IS NOT NULL THEN {KEY_SQL} END, '') AS key, coalesce(ts, '') AS time_signature FROM summ
""",
)
def music_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = music.summarize(_music(spark, sf_dir)).drop("key_name")
    return rows.withColumn("key", F.coalesce("key", F.lit(""))).withColumn(
        "time_signature", F.coalesce("time_signature", F.lit(""))
    )


@query(
    "music_markdown",
    f"""
WITH {MUSIC_SQL}
SELECT doc_id, md5('## Music Metadata' || chr(10) || chr(10) || '- **Key Signature:** '
  || CASE WHEN sharps IS NULL THEN 'Unknown' ELSE CASE sharps WHEN 0 THEN 'C Major / A minor' WHEN 1 THEN 'G Major / E minor' WHEN -1 THEN 'F Major / D minor'
       WHEN 2 THEN 'D Major / B minor' WHEN -2 THEN 'Bb Major / G minor' ELSE sharps || ' sharps/flats' END END || chr(10)
  || '- **Time Signature:** ' || coalesce(ts, 'Unknown') || chr(10) || '- **Tempo:** Unknown' || chr(10) || '- **Measure Count:** ' || n_measures || chr(10)
  || '- **Note Count:** ' || n_notes || chr(10) || '- **Rest Count:** ' || n_rests || chr(10) || '- **Total Elements:** ' || n_elements || chr(10) || chr(10)
  || '### Available Formats' || chr(10) || chr(10) || '- MusicXML: `music.musicxml`' || chr(10) || '- ABC Notation: `music.abc`' || chr(10) || '- MIDI: `music.mid`' || chr(10)) AS digest
FROM summ
""",
)
def music_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = music.markdown_summary(music.summarize(_music(spark, sf_dir)))
    return text.select("doc_id", F.md5(F.col("markdown").cast("binary")).alias("digest"))


@query(
    "music_abc",
    f"""
WITH {MUSIC_SQL},
sym AS (
  SELECT doc_id, pos, CASE WHEN lag(m) OVER (PARTITION BY doc_id ORDER BY pos) <> m THEN '|' ELSE '' END
    || CASE WHEN et = 'rest' THEN 'z' WHEN acc = '#' THEN '^' || letter WHEN acc = 'b' THEN '_' || letter
       WHEN octave >= 5 THEN lower(letter) WHEN octave <= 3 THEN letter || ',' ELSE letter END
    || CASE d WHEN 0.5 THEN '/2' WHEN 2.0 THEN '2' ELSE '' END AS t
  FROM el WHERE et IN ('note', 'rest')
),
body AS (SELECT doc_id, string_agg(t, '' ORDER BY pos) AS b FROM sym GROUP BY doc_id)
SELECT s.doc_id, 'X:1' || chr(10) || 'T:Untitled' || chr(10) || 'M:' || coalesce(ts, '4/4') || chr(10) || 'L:1/4' || chr(10) || 'K:'
   || coalesce(split_part(CASE WHEN sharps IS NOT NULL THEN {KEY_SQL} END, ' ', 1), 'C') || chr(10) || coalesce(b, '') || '|' || chr(10) AS abc
FROM summ s LEFT JOIN body USING (doc_id)
""",
)
def music_abc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.to_abc(_music(spark, sf_dir))


RHYTHM_SQL = """
off AS (
  SELECT *, coalesce(sum(d) OVER (PARTITION BY doc_id, m ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o
  FROM el WHERE et IN ('note', 'rest')
),
fl AS (
  SELECT doc_id, bool_or(d >= 4) AS w, bool_or(d >= 2 AND d < 4) AS h, bool_or(d >= 1 AND d < 2) AS q, bool_or(d >= 0.5 AND d < 1) AS e,
         bool_or(d < 0.5) AS s, bool_or(d IN (0.75, 1.5, 3.0)) AS dot, bool_or(o <> floor(o)) AS syn FROM off WHERE et = 'note' GROUP BY doc_id
),
rhythm AS (
SELECT doc_id, array_to_string(list_concat(
  list_filter([CASE WHEN w THEN 'whole notes' END, CASE WHEN h THEN 'half notes' END, CASE WHEN q THEN 'quarter notes' END,
    CASE WHEN e THEN 'eighth notes' END, CASE WHEN s THEN 'sixteenth notes' END], lambda x: x IS NOT NULL)[1:3],
  list_filter([CASE WHEN dot THEN 'dotted rhythms' END, CASE WHEN syn THEN 'syncopation' END], lambda x: x IS NOT NULL)), ', ') AS rhythm FROM fl
)"""


@query("music_rhythm", f"WITH {MUSIC_SQL}, {RHYTHM_SQL} SELECT doc_id, rhythm FROM rhythm")
def music_rhythm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.rhythm(_music(spark, sf_dir))


CHARACTER_SQL = """
nt AS (
  SELECT doc_id, pos, (octave + 1) * 12 + (CASE letter WHEN 'C' THEN 0 WHEN 'D' THEN 2 WHEN 'E' THEN 4 WHEN 'F' THEN 5 WHEN 'G' THEN 7 WHEN 'A' THEN 9 ELSE 11 END)
         + CASE acc WHEN '#' THEN 1 WHEN 'b' THEN -1 ELSE 0 END AS midi,
         row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r FROM el WHERE et = 'note'
),
st AS (SELECT *, midi - lag(midi) OVER (PARTITION BY doc_id ORDER BY pos) AS step FROM nt),
c AS (SELECT doc_id, count(*) AS n, min(step) FILTER (r BETWEEN 2 AND 5) AS lo, max(step) FILTER (r BETWEEN 2 AND 5) AS hi FROM st GROUP BY doc_id),
traits AS (
SELECT doc_id, CASE WHEN n < 10 THEN 'simple melody' WHEN n < 30 THEN 'moderate complexity' ELSE 'complex passage' END
  || CASE WHEN n >= 4 AND lo > 0 THEN ', ascending melodic pattern' WHEN n >= 4 AND hi < 0 THEN ', descending melodic pattern' ELSE '' END AS characteristics FROM c
)"""


@query("music_characteristics", f"WITH {MUSIC_SQL}, {CHARACTER_SQL} SELECT doc_id, characteristics FROM traits")
def music_characteristics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.characteristics(_music(spark, sf_dir))


def _profile_rows() -> str:
    return ", ".join(f"('{mode}', {place}, {i}, {x})" for place, (mode, rates) in enumerate(harmony.PROFILES.items()) for i, x in enumerate(rates))


# Three voices: every third element of a document sounds after the last one of its voice.
KEYS_SQL = f"""
mn AS (
  SELECT *, coalesce(sum(d) OVER (PARTITION BY doc_id, pos % 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM el WHERE et IN ('note', 'rest')
),
hn AS (
  SELECT doc_id, ((CASE letter WHEN 'C' THEN 0 WHEN 'D' THEN 2 WHEN 'E' THEN 4 WHEN 'F' THEN 5 WHEN 'G' THEN 7 WHEN 'A' THEN 9 ELSE 11 END)
         + CASE acc WHEN '#' THEN 1 WHEN 'b' THEN -1 ELSE 0 END + 12) % 12 AS pc, b, b + d AS e FROM mn WHERE et = 'note'
),
rated(mode, mp, degree, x) AS (VALUES {_profile_rows()}),
centred AS (SELECT *, x::DOUBLE - avg(x::DOUBLE) OVER (PARTITION BY mode) AS c FROM rated),
profile AS (SELECT *, c / sqrt(sum(c * c) OVER (PARTITION BY mode)) AS r FROM centred),
keys24 AS (SELECT mode, t AS tonic, 12 * mp + t AS place, (t + degree) % 12 AS pc, r FROM profile, range(12) u(t)),
wt AS (SELECT doc_id, pc, sum(e - b) AS w FROM hn GROUP BY doc_id, pc),
ln AS (SELECT doc_id, sqrt(greatest(0, sum(w * w) - sum(w) * sum(w) / 12)) AS l FROM wt GROUP BY doc_id),
fits AS (
  SELECT doc_id, mode, tonic, place, CASE WHEN l > 1e-9 THEN round(sum(w * r) / l, 9) ELSE 0 END AS fit
  FROM wt JOIN keys24 USING (pc) JOIN ln USING (doc_id) GROUP BY doc_id, mode, tonic, place, l
),
keyed AS (
  SELECT doc_id, mode, tonic, fit, CASE mode WHEN 'major' THEN {list(harmony.TONICS["major"])} ELSE {list(harmony.TONICS["minor"])} END[tonic + 1] AS name
  FROM fits QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY fit DESC, place) = 1
)"""

CHORDS_SQL = f"""
cut AS (SELECT DISTINCT doc_id, unnest([b, e]) AS s FROM hn),
stretch AS (SELECT doc_id, s, lead(s) OVER (PARTITION BY doc_id ORDER BY s) AS t FROM cut),
son AS (
  SELECT x.doc_id, s, list_sort(list_distinct(list(pc))) AS cl FROM stretch x JOIN hn ON hn.doc_id = x.doc_id AND hn.b <= s AND hn.e > s
  WHERE t IS NOT NULL GROUP BY x.doc_id, s
),
tri AS (
  SELECT list_sort([r, (r + p) % 12, (r + q) % 12]) AS cl, min(r) AS root, mark, up
  FROM range(12) u(r), (VALUES (4, 7, '', true), (3, 7, '', false), (3, 6, 'o', false), (4, 8, '+', true)) y(p, q, mark, up) GROUP BY cl, mark, up
),
figured AS (
  SELECT doc_id, s, CASE WHEN up THEN deg ELSE lower(deg) END || mark AS num FROM (
    SELECT son.doc_id, s, up, mark,
           CASE mode WHEN 'major' THEN {list(harmony.DEGREES["major"])} ELSE {list(harmony.DEGREES["minor"])} END[(root - tonic + 12) % 12 + 1] AS deg
    FROM son JOIN tri ON list_transform(son.cl, lambda z: z::BIGINT) = tri.cl JOIN keyed ON keyed.doc_id = son.doc_id)
),
changed AS (SELECT *, lag(num) OVER (PARTITION BY doc_id ORDER BY s) AS last FROM figured),
kept AS (SELECT doc_id, num, row_number() OVER (PARTITION BY doc_id ORDER BY s) AS n FROM changed WHERE num IS DISTINCT FROM last),
chords AS (SELECT doc_id, string_agg(num, ' - ' ORDER BY n) AS progression FROM kept WHERE n <= 8 GROUP BY doc_id)"""


def _voices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes of three voices with their onsets."""
    voice = Window.partitionBy("doc_id", F.pmod("pos", F.lit(3))).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    sounding = _music(spark, sf_dir).filter(F.col("element_type").isin(*music.SOUNDING))
    placed = sounding.withColumn("onset", F.coalesce(F.sum("duration").over(voice), F.lit(0.0)))
    return placed.filter("element_type = 'note'").select("doc_id", "pitch", "onset", "duration")


@query("music_keys", f"WITH {MUSIC_SQL}, {KEYS_SQL} SELECT doc_id, name AS tonic, mode, round(fit, 6) AS fit FROM keyed")
def music_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of 24 keys the one whose profile agrees best with a document's pitch classes."""
    return harmony.keys_of(_voices(spark, sf_dir)).withColumn("fit", F.round("fit", 6))


@query(
    "music_progressions",
    f"WITH {MUSIC_SQL}, {KEYS_SQL}, {CHORDS_SQL} SELECT doc_id, coalesce(progression, 'I') AS progression FROM keyed LEFT JOIN chords USING (doc_id)",
)
def music_progressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numerals of the triads that three voices form, in order."""
    notes = _voices(spark, sf_dir)
    found = harmony.progressions(notes, harmony.keys_of(notes))
    return found.select("doc_id", F.array_join("chords", " - ").alias("progression"))


@query(
    "music_description",
    f"""
WITH {MUSIC_SQL}, {RHYTHM_SQL}, {CHARACTER_SQL}, {KEYS_SQL}, {CHORDS_SQL},
opened AS (SELECT doc_id, arg_min(ts, pos) FILTER (et = 'time_sig') AS first_ts FROM el GROUP BY doc_id)
SELECT s.doc_id, 'Music phrase in ' || coalesce(name, 'C') || ' ' || coalesce(mode, 'major') || ', ' || coalesce(first_ts, '4/4')
  || ' time signature. Harmonic progression: ' || coalesce(progression, 'I') || '. Rhythmic pattern: '
  || coalesce(rhythm, 'no rhythmic content') || '. Musical characteristics: ' || coalesce(characteristics, 'simple melody') || '.' AS description
FROM summ s JOIN opened USING (doc_id) LEFT JOIN rhythm USING (doc_id) LEFT JOIN traits USING (doc_id)
LEFT JOIN keyed USING (doc_id) LEFT JOIN chords USING (doc_id)
""",
)
def music_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence used to embed a piece, with the key and the chords of its voices."""
    return music.describe(_music(spark, sf_dir), harmony.analysis(_voices(spark, sf_dir)))


@query(
    "phrase_segments",
    f"""
WITH RECURSIVE {MUSIC_SQL},
me AS (SELECT doc_id, m, bool_or(et = 'rest' AND d >= 1.0) AS rests FROM el GROUP BY doc_id, m),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY m) AS i, lead(m) OVER (PARTITION BY doc_id ORDER BY m) IS NULL AS last FROM me),
walk AS (
  SELECT doc_id, i, m, rests, last, last AS closes, CASE WHEN last THEN m + 1 ELSE 1 END::BIGINT AS start, 1::BIGINT AS opened FROM o WHERE i = 1
  UNION ALL
  SELECT o.doc_id, o.i, o.m, o.rests, o.last, o.last OR (o.rests AND o.m > w.start),
         CASE WHEN o.last OR (o.rests AND o.m > w.start) THEN o.m + 1 ELSE w.start END, w.start
  FROM walk w JOIN o ON o.doc_id = w.doc_id AND o.i = w.i + 1
)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY m) AS phrase_num, opened AS start_measure, m AS end_measure,
       CASE WHEN rests THEN 'rest' ELSE 'measure_group' END AS boundary_type, CASE WHEN rests THEN 0.8 ELSE 0.5 END::DOUBLE AS confidence
FROM walk WHERE closes
""",
)
def phrase_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.phrases(_music(spark, sf_dir))


@query(
    "measure_groups",
    f"""
WITH {MUSIC_SQL}, me AS (SELECT DISTINCT doc_id, m FROM el),
o AS (SELECT *, (row_number() OVER (PARTITION BY doc_id ORDER BY m) - 1) // 4 + 1 AS g FROM me)
SELECT doc_id, g AS phrase_num, min(m) AS start_measure, max(m) AS end_measure FROM o GROUP BY doc_id, g
""",
)
def measure_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.measure_groups(_music(spark, sf_dir))


@query(
    "page_regions",
    """
SELECT page_id AS doc_id, unnest(range(1, 2 + length(html) // 4000)) AS page_num,
       CASE WHEN page_id % 4 = 0 THEN 'music' ELSE 'text' END AS region_type, CASE WHEN page_id % 4 = 0 THEN 0.85 ELSE 0.9 END::DOUBLE AS confidence FROM pages
""",
)
def page_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One printed page per 4000 characters; every fourth document is music."""
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("doc_id"),
        (F.floor(F.length("html") / 4000) + 1).alias("page_count"),
        (F.col("page_id") % 4 == 0).alias("is_music"),
    )
    return music.page_regions(pages)
