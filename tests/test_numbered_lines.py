"""Lines of files numbered a piece at a time."""

from tallyguard.catalog import source_queries
from tallyguard.sources import files


def test_lines_are_numbered_a_piece_at_a_time(spark):
    rows = [(g, f, s, 10 * p + k) for p, (g, f, s) in enumerate(
        [("b", "f2", 0), ("a", "f1", 7), ("a", "f2", 0), ("a", "f1", 0), (None, "f1", 0)]) for k in range(3)]
    lines = spark.createDataFrame(rows, "g string, file string, start long, line long")
    out = files.numbered_lines(lines, "g", "file", "start", "line", "position")
    assert [(r.g, r.file, r.start, r.line) for r in out.where("g = 'a'").orderBy("position").collect()] == [
        ("a", "f1", 0, k) for k in (30, 31, 32)] + [("a", "f1", 7, k) for k in (10, 11, 12)] + [("a", "f2", 0, k) for k in (20, 21, 22)]
    assert sorted(r.position for r in out.where("g IS NULL OR g = 'b'").collect()) == [1, 1, 2, 2, 3, 3]


def test_no_window_holds_a_whole_split(spark, sf_dir):
    plan = source_queries.s7_write_jsonl(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    numbering = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert numbering and all("file" in line.split("AS position")[1] for line in numbering)
