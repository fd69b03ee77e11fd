from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sievework.sources import readers


def test_plain_text_leaves_out_bad_bytes_alone(spark, tmp_path):
    files = {"good": "a�b é".encode(), "bad": b"a\xff\xfeb \xef\xbf\xbd \xc3", "empty": b""}
    for name, content in files.items():
        (tmp_path / f"{name}.txt").write_bytes(content)
    got = {r.path.rsplit("/", 1)[1]: r.text for r in readers.plain(spark, str(tmp_path)).collect()}
    assert got == {f"{name}.txt": content.decode("utf-8", "ignore") for name, content in files.items() if content}  # Spark passes over empty files


def test_numbers_follow_an_order_over_parts(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("name"), F.lit("x").alias("more")).repartition(7)
    out = readers.numbered(rows, "name").collect()
    assert sorted((r.no, r.name) for r in out) == [(i + 1, i) for i in range(5000)]
    assert readers.numbered(rows.limit(0), "name").collect() == []


def test_cache_makes_what_changed_and_survives_a_write_that_fails(spark, tmp_path):
    calls, path = tmp_path / "calls", str(tmp_path / "cache")
    calls.mkdir()

    def made(lost: str | None = None):
        @F.udf("string")
        def one(key: int, content: str) -> str:
            if content == lost:
                raise ValueError("lost")
            with open(calls / f"{key}-{content}", "a") as f:
                f.write("x")
            return content.upper()

        return lambda rows: rows.select("k", "digest", one("k", "c").alias("text"))

    def run(rows, **more):
        frame = spark.createDataFrame(rows, "k int, c string").repartition(4)
        return sorted((r.k, r.text) for r in readers.cached(frame, ["k"], "c", made(**more), path).collect())

    first = [(i, f"c{i}") for i in range(8)]
    with pytest.raises(Exception, match="lost"):
        run(first, lost="c5")
    assert run([*first, (0, "c0")]) == [(i, f"C{i}") for i in range(8)]
    before = {p.name: len(p.read_text()) for p in calls.iterdir()}
    changed = [(i, f"c{i}" if i != 3 else "new") for i in range(8)]
    assert run(changed) == [(i, f"C{i}" if i != 3 else "NEW") for i in range(8)]
    assert {p.name: len(p.read_text()) for p in calls.iterdir()} == before | {"3-new": 1}
    assert run(first[:2]) == [(0, "C0"), (1, "C1")]


def test_files_that_cannot_be_read_are_told(spark, tmp_path):
    (tmp_path / "good.csv").write_text("a,b\n1,2\n")
    (tmp_path / "bad.csv").write_text('a,b\n"open')
    (tmp_path / "bad.xlsx").write_bytes(b"no workbook")
    (tmp_path / "bad.tsv").write_text("a\tb\n1\t2\t3\t4\n1\n2\t2\t3\t4\t5\n")
    got = {(r.path.rsplit("/", 1)[1], r.source) for r in readers.unreadable(spark, str(tmp_path)).collect()}
    assert got >= {("bad.csv", "csv"), ("bad.xlsx", "xlsx")} and ("good.csv", "csv") not in got
    assert [r.context for r in readers.supplementary(spark, str(tmp_path)).where("source = 'csv'").collect()] == ["1 | 2"]


def test_items_of_many_files_are_handed_on_before_the_last_file():
    """A batch of files may hold many items; a task holds those of one file and a bounded number beside."""
    import pandas as pd

    class Frame:
        def select(self, *columns):
            return self

        def mapInPandas(self, run, schema):
            return run

    run = readers.parsed(Frame(), lambda content: [(i,) for i in range(400)], "no int")
    sizes = [len(x) for x in run(iter([pd.DataFrame({"path": [str(i) for i in range(50)], "content": [b""] * 50})]))]
    assert sum(sizes) == 20_000 and max(sizes) < readers.ITEMS + 400
