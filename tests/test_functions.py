import hashlib

import pytest
from pyspark.sql import functions as F

from marginalia.functions import citations, formulas, hashing, markup, render, text, toolcalls, yaml_text
from marginalia.sources.parsers import html_nodes


def apply(spark, function, values, types="v string"):
    rows = [v if isinstance(v, tuple) else (v,) for v in values]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {types}")
    columns = [F.col(c) for c in frame.columns[1:]]
    return [r["out"] for r in frame.select("i", function(*columns).alias("out")).orderBy("i").collect()]


def test_slugify(spark):
    names = ["Report_2024.pdf", "Q3 Financial Report.pdf", "Annual_Review_2024_FINAL.pdf", "Café Ä.pdf", ".bashrc", "a/b/C d.tar.gz", "--x--y--.md", ""]
    assert apply(spark, text.slugify, names) == [
        "report-2024", "q3-financial-report", "annual-review-2024-final", "caf", "bashrc", "c-dtar", "x-y", "",
    ]


def test_collection_names(spark):
    names = ["science", "music-theory", "Science", "a--b", "-a", "a-", "a b", "", None, "a\n", "x9-1"]
    assert apply(spark, text.is_collection_name, names) == [True, True, False, False, False, False, False, False, False, True, True]


def test_normalize_markdown(spark):
    values = ["", "\n\n", "a \t\r\nb\r\rc  ", "x \n y \n \n", "\n a\n", "é\u0085b\n"]
    assert apply(spark, text.normalize_markdown, values) == ["", "", "a\nb\n\nc\n", "x\n\u2003y\n", "\n a\n", "é\u0085b\n"]


def test_strip_and_blank(spark):
    values = ["", " \n\t", " a b ", "\x1cx\x1f"]
    assert apply(spark, text.strip, values) == [v.strip() for v in values]
    assert apply(spark, text.is_blank, values + [None]) == [True, True, False, False, True]


def test_front_matter_roundtrip(spark):
    frame = spark.range(1).select(text.front_matter({"b": F.lit("x"), "a": F.lit(True), "n": F.lit(3)}).alias("t"))
    assert frame.first()["t"] == "---\na: true\nb: x\nn: 3\n---\n\n"
    bodies = ["---\na: 1\n---\n\nbody", "no header", "---\n---\nx", " ---\na\n---\n"]
    assert apply(spark, text.strip_front_matter, bodies) == ["body", "no header", "x", " ---\na\n---\n"]


def test_fallback_flag(spark):
    values = ["---\nfallback: true\n---\nx", "---\nfallback: false\n---\nx", "fallback: true", None]
    assert apply(spark, text.is_fallback, values) == [True, False, False, False]


def test_hashes(spark):
    value = "añ\n"
    assert apply(spark, hashing.sha1, [value]) == [hashlib.sha1(value.encode()).hexdigest()]
    assert apply(spark, hashing.content_hash, [value]) == [hashlib.sha256(value.encode()).hexdigest()]
    with pytest.raises(Exception, match="40"):
        apply(spark, hashing.short_id, ["abc"])
    with pytest.raises(ValueError):
        hashing.content_hash(F.lit("x"), "md5")


def test_chunk_ids_widen(spark):
    frame = spark.range(1).select(hashing.chunk_id(F.lit("d"), F.lit(7)), hashing.chunk_id(F.lit("d"), F.lit(12345)), hashing.embedding_id(F.lit("d"), F.lit(3)))
    assert tuple(frame.first()) == ("d-0007", "d-12345", "d_ch_0003")


def test_citation_prefixes(spark):
    cases = [
        (("alpha-paper", 247, 249, "3.2 Bootstrap Methods"), "[alpha-paper, p.247–249, §3.2 Bootstrap Methods]"),
        (("alpha-paper.pdf", 3, 3, "Intro"), "[alpha-paper, p.3, §Intro]"),
        (("Alpha Paper.PDF", 3, None, None), "[alpha-paper, p.3]"),
        (("alpha-paper", None, 9, " Methods "), "[alpha-paper, §Methods]"),
        (("alpha-paper", None, None, "  "), "[alpha-paper]"),
        (("", None, None, None), "[]"),
        (("v1.2-notes", 1, 2, None), "[v1, p.1–2]"),
    ]
    got = apply(spark, citations.citation_prefix, [c for c, _ in cases], "s string, a int, b int, h string")
    assert got == [want for _, want in cases]


def test_number_text_is_rounded_from_the_binary_value(spark):
    values = [0.125, 2.675, 1234.5, 0.0005, 70.18765]
    assert apply(spark, lambda v: text.fixed(v, 2), [(v,) for v in values], "v double") == [f"{v:.2f}" for v in values]


def test_short_query(spark):
    values = ["  a\nb|c ", "x" * 80, "y" * 81, "z" * 78 + " zz"]
    assert apply(spark, render.short_query, values) == ["a b\\|c", "x" * 80, "y" * 79 + "…", "z" * 78 + "…"]


def test_clamp_top_k(spark):
    assert apply(spark, render.clamp_top_k, ["3", "0", "99", "-4", "x", None]) == [3, 1, 20, 1, 5, 5]


def test_delta_arrow(spark):
    assert apply(spark, render.delta_arrow, [(0.0,), (1e-7,), (0.0625,), (-0.5,), (None,)], "v double") == ["=", "=", "↑0.062", "↓0.500", ""]


def test_formula_counts_and_ids(spark):
    got = apply(spark, formulas.formula_counts, ["$$a$$ and $b$ $c$", "none", "$$x", "$ $ $"])
    assert [(r["display"], r["inline"], r["total"]) for r in got] == [(1, 2, 3), (0, 0, 0), (0, 1, 1), (0, 1, 1)]
    ids = spark.range(1).select(formulas.formula_ids(F.lit("d"), F.lit(2), F.lit(2)).alias("v")).first()["v"]
    assert ids == ["d_formula_0002_001", "d_formula_0002_002"]


def test_latex_plain_text(spark):
    values = ["\\alpha^{2} + x_{i}", "\\frac{a}{b} \\leq \\infty", "\\left( x \\right) \\, y \\quad \\qquad z", "a \\; b", "\\int_{0}^{1}"]
    assert apply(spark, formulas.latex_to_plain, values) == [
        "alpha^2 + x_i", "/ab <= infinity", "( x ) y z", "a b", "integral_0^1",
    ]


def test_latex_format(spark):
    got = apply(spark, formulas.format_latex, [(" a \n b ", "inline"), ("{x}", "display"), ("{x", "inline"), (" ", "inline")], "v string, k string")
    assert got == ["$a b$", "$${x}$$", None, None]


def test_yaml_scalars_equal_the_library(spark):
    yaml = pytest.importorskip("yaml")
    values = [
        "plain", "two words", "12345678", "0777", "0x1F", "1e5", "1.5", "true", "No", "null", "~", "", " lead", "trail ",
        "a: b", "a #b", "#x", "- x", "-x", "it's", '"q"', "§ Ünï", "tab\there", "2024-06-01T00:00:00+00:00",
        "2024-06-01", "a,b", "[x]", "{x}", "x:", "back\\slash", "%x", "@x", "*x", "&x", "!x", "|x", ">x", "=", "<<", "1:30",
        "nbsp\xa0x", "emoji \U0001f600", "?x", "? x", "---", "...", "1_000", "08", "0b11", ".5", ".inf", "on", "y",
    ]
    want = []
    for value in values:
        dumped = yaml.safe_dump(value, default_flow_style=True, allow_unicode=False).strip()
        want.append(dumped[:-3].strip() if dumped.endswith("...") else dumped)
    got = apply(spark, yaml_text.yaml_text, values)
    assert dict(zip(values, got)) == dict(zip(values, want))
    assert apply(spark, yaml_text.unquote, got) == values
    broken = apply(spark, yaml_text.yaml_text, ["line\nbreak"])
    assert broken == ['"line\\nbreak"'] and apply(spark, yaml_text.unquote, broken) == ["line\nbreak"]


def test_html_text_equals_a_parser(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    for row in pages.select("html", markup.html_text(F.col("html")).alias("t")).collect():
        assert row["t"] == "\n\n".join(html_nodes(row["html"]))


def test_tool_call_shapes(spark):
    values = [
        '{"message":{"tool_calls":[{"function":{"name":"a","arguments":{"q":1}}}]}}',
        '{"choices":[{"message":{"tool_calls":[{"function":{"name":"b","arguments":"{\\"q\\": 2}"}}]}}]}',
        '{"message":{"tool_calls":[{"function":{"name":"c","arguments":"oops"}}]}}',
        '{"message":{"content":"x"}}',
        "{}",
    ]
    got = apply(spark, toolcalls.tool_calls, values)
    assert [[c["name"] for c in calls] for calls in got] == [["a"], ["b"], ["c"], [], []]
    assert got[0][0]["arguments"] == '{"q":1}' and got[1][0]["arguments"] == '{"q": 2}'
    assert got[2][0]["arguments"] == '{"raw":"oops"}' and got[2][0]["is_raw"]


def test_display_names(spark):
    values = ["corp-dev-friendly", "ceo", "ip-counsel", "QA-lead"]
    assert apply(spark, text.display_name, values) == ["Corp Dev Friendly", "CEO", "IP Counsel", "QA Lead"]


LONG = [
    "plain words " * 20 + "end",
    "it's: quoted " + "and long, quite long indeed " * 8,
    "caf\u00e9 " * 30 + "end",
    "\u4e2d\u6587" * 40,
    "a" * 100 + " " + "b" * 100 + "  two spaces " + "c" * 90 + " d",
    "line\nbreak " * 15,
    "tab\there " + "x" * 80 + " \u00e9 yy " + "z" * 70 + "\u00e9 q",
    " leading " + "w" * 90 + " trailing ",
]


def test_long_yaml_scalars_are_folded(spark):
    got = apply(spark, yaml_text.yaml_text, LONG)
    assert apply(spark, yaml_text.unquote, got) == LONG
    words = "plain words plain words plain words plain words plain words plain words plain words"
    assert got[0].split("\n")[:2] == [words, "  " + words]
    assert got[2].split("\n")[0] == '"' + "caf\\xE9 " * 10 + "caf\\xE9\\"


def test_folded_scalars_equal_the_library(spark):
    import random

    yaml = pytest.importorskip("yaml")
    rng = random.Random(7)
    letters = ["word", "a", "longer-word", "it's", "caf\u00e9", "x" * 30, " ", "\u00fc", "q: r", "\U0001f600"]
    values = LONG + [" ".join(rng.choices(letters, k=rng.randrange(1, 60))) for _ in range(150)]

    def dumped(value):
        out = yaml.safe_dump(value, default_flow_style=True, allow_unicode=False).strip()
        return out[:-3].strip() if out.endswith("...") else out

    values = [v for v in values if "\n" not in v]
    assert apply(spark, yaml_text.yaml_text, values) == [dumped(v) for v in values]
    mapped = spark.createDataFrame([(v,) for v in values], "v string").select(
        yaml_text.render_meta(F.col("v"), F.lit("s"), F.col("v"), F.lit("2024-01-01").cast("timestamp"), F.create_map(F.lit("some_key"), F.col("v")), *[F.create_map(F.lit("k"), F.lit("x"))] * 2)
    )
    for v, (text,) in zip(values, mapped.collect()):
        stamp = "2024-01-01T00:00:00+00:00"
        inner = {"some_key": v}
        want = {"doc_id": v, "slug": "s", "orig_name": v, "created_utc": stamp, "tooling": inner, "params": {"k": "x"}, "hashes": {"k": "x"}}
        assert text == yaml.safe_dump(want, default_flow_style=False, sort_keys=False, allow_unicode=False)
