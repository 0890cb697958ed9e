"""Trees of files appear whole or not at all."""

import json
import os

import pytest
from pyspark.sql import functions as F

from marginalia.sources import export


def tree(root):
    return {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f), "rb").read() for d, _, names in os.walk(root) for f in names}


def files(spark, rows, partitions=4):
    return spark.createDataFrame(rows, "relative_path string, content string").repartition(partitions)


def test_all_files_of_a_job_appear(spark, tmp_path):
    root = str(tmp_path / "out")
    export.write_tree(files(spark, [(f"c{i % 3}/d{i}.md", f"text {i}\n") for i in range(50)]), root)
    assert tree(root) == {f"c{i % 3}/d{i}.md": f"text {i}\n".encode() for i in range(50)}
    export.write_tree(files(spark, [("c0/d0.md", "new"), ("empty.md", None)]), root)
    found = tree(root)
    assert found["c0/d0.md"] == b"new" and found["empty.md"] == b"" and len(found) == 51


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    export.write_tree(files(spark, [("kept.md", "kept")]), root)
    rows = files(spark, [(f"d{i}.md", str(i)) for i in range(20)])
    bad = rows.withColumn("content", F.when(F.col("content") == "13", F.raise_error(F.lit("broken"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="broken"):
        export.write_tree(bad, root)
    assert tree(root) == {"kept.md": b"kept"}
    for rows in ([("../x", "1")], [("/x", "1")], [("same", "1"), ("same", "2")]):
        with pytest.raises(Exception, match="inside the tree|two files"):
            export.write_tree(files(spark, rows), root)
    assert tree(root) == {"kept.md": b"kept"} and os.listdir(root) == ["kept.md"]


def test_side_files_and_reports(spark, tmp_path):
    root = str(tmp_path / "out")
    music = spark.createDataFrame(
        [("c", "s", "abc", b"X:1"), ("c", "s", "midi", b"\x00\xff"), ("c", "s", "other", b"-")], "collection string, slug string, format string, content binary"
    )
    formulas = spark.createDataFrame(
        [("c", "s", "latex", "p1_f1", "E=mc^2"), ("c", "s", "mathml", "p1_f1", "<math/>")],
        "collection string, slug string, format string, formula_id string, content string",
    )
    figures = spark.createDataFrame([(2, 0.5, None)], "n_items int, mrr double, note string")
    lines = spark.createDataFrame([(2, "- b"), (1, "# Run"), (3, "- c")], "place int, line string")
    everything = export.music_files(music).unionByName(export.formula_files(formulas))
    reports = export.run_files("run-1", figures, lines)
    export.write_tree(everything.unionByName(reports.withColumn("content", F.encode("content", "UTF-8"))), root)
    found = tree(root)
    assert json.loads(found.pop("run-1.json")) == {"n_items": 2, "mrr": 0.5, "note": None}
    assert found == {
        "c/s/music.abc": b"X:1", "c/s/music.mid": b"\x00\xff", "c/s/formulas/p1_f1.tex": b"E=mc^2", "c/s/formulas/p1_f1.mathml": b"<math/>",
        "run-1.md": b"# Run\n- b\n- c\n",
    }
