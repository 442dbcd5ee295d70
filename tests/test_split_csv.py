"""CSV files cut at any byte, and positions in split files."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from pairwright.operators.numbering import sums_before, with_file_position
from pairwright.operators.pairs import load_pairs
from pairwright.plans.labelling import open_requests
from pairwright.settings import LabelSettings
from pairwright.sources import tables
from pairwright.sources.split_csv import records
from pairwright.sources.tables import read_csv, read_log, read_selected


def cells(rng):
    words = ["a", "", "x,y", 'say "hi"', "two\nlines", "\n", "a\r\nb", '"', "é𝄞", "end\n\n", "," * 9, "plain words here", 'q""q\n"']
    return "".join(rng.choice(words) for _ in range(rng.randrange(0, 4)))


def written(folder, files, line_end):
    rng, want = random.Random(4), []
    for name, n in files:
        out = io.StringIO(newline="")
        rows = csv.writer(out, lineterminator=line_end)
        rows.writerow(["id", "first one", "second\nof two"])
        for i in range(n):
            row = [f"{name}{i}", cells(rng), cells(rng)]
            rows.writerow(row)
            want.append(row)
            if i % 7 == 0:
                out.write(line_end)
        (folder / f"{name}.csv").write_bytes(out.getvalue().encode())
    return want


@pytest.fixture
def ranges(spark):
    """Sets the bytes of a range."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    yield lambda size: [spark.conf.set(n, v) for n, v in zip(names, (str(size), "1"), strict=True)]
    for n in names:
        spark.conf.unset(n)


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_records_do_not_depend_on_the_ranges(spark, ranges, tmp_path, line_end):
    want = written(tmp_path, [("a", 60), ("b", 0), ("c", 25)], line_end)
    found = {}
    for size in (16, 61, 1 << 20):
        ranges(size)
        rows = read_csv(spark, str(tmp_path), {}, tokens=()).orderBy("input_order").collect()
        found[size] = rows
        assert [list(r)[:3] for r in rows] == want
        assert [r.input_order for r in rows] == [*range(1, 61), *range(63, 88)]  # headers have places too
    assert found[16] == found[61] == found[1 << 20]
    if line_end == "\r\n":  # the whole-file reader takes blank lines of this kind for rows
        return
    whole = read_csv(spark, str(tmp_path), {}, tokens=(), split=False)
    assert sorted(tuple(r)[:3] for r in whole.collect()) == sorted(map(tuple, want))


def test_a_cell_over_many_ranges_and_an_open_quote(spark, ranges, tmp_path):
    long = "line\n" * 200
    (tmp_path / "a.csv").write_text(f'id,text\n1,"{long}"\n2,b\n3,"never closed\nx\n')
    ranges(32)
    rows = read_csv(spark, str(tmp_path / "a.csv"), {}, tokens=()).orderBy("input_order").collect()
    assert [(r.id, r.text) for r in rows][:2] == [("1", long), ("2", "b")] and rows[2].id == "3" and rows[2].text.startswith("never closed\nx")
    (tmp_path / "b.csv").write_text("id,text\n")
    assert read_csv(spark, str(tmp_path / "b.csv"), {}).collect() == [] and records(spark, str(tmp_path / "b.csv")).collect() == []


def test_sums_before_over_many_groups(spark):
    rows = spark.range(3000).select(F.pmod(F.col("id") * 7, F.lit(3000)).alias("k"), (F.col("id") % 5).alias("n"), F.lit(1).alias("one"))
    got = sums_before(rows, ["k"], {"n": "before", "one": "place"}).orderBy("k").collect()
    total = 0
    for i, r in enumerate(got):
        assert (r.k, r.place, r.before) == (i, i, total)
        total += r.n


def pairs_table(spark, codes):
    row = lambda i, c: (c, f"name {c}", "cat", f"v{i}", f"variable {i}", "text", 0.5, 1.0)
    names = "target_code string, target_name string, target_category string, accession string, name string, description string, score double, target_rank double"
    return spark.createDataFrame([row(i, c) for i, c in enumerate(codes)], names)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_first_targets_by_first_appearance_in_split_files(spark, ranges, tmp_path, fmt):
    codes = ["9"] * 30 + ["250.1"] * 20 + ["9"] + ["1"] * 40 + ["40"] * 9
    path = str(tmp_path / "rows")
    table = pairs_table(spark, codes).coalesce(1).withColumn("at", F.monotonically_increasing_id())
    table.repartitionByRange(5, "at").sortWithinPartitions("at").drop("at").write.option("escape", '"').option("header", True).format(fmt).save(path)
    ranges(900)
    rows = read_selected(spark, path, fmt, ordered=True)
    assert [r.target_code for r in rows.orderBy("input_order").collect()] == codes
    for n, want in ((1, {"9"}), (2, {"9", "250.1"}), (3, {"9", "250.1", "1"})):
        settings = LabelSettings(first_targets=n)
        made = open_requests(load_pairs(rows, settings), read_log(spark, str(tmp_path / "none")), settings)
        assert {r.target_code for r in made.collect()} == want
    by_code = LabelSettings(first_targets=1, top_n=3)
    made = open_requests(load_pairs(rows, by_code), read_log(spark, str(tmp_path / "none")), by_code)
    assert {r.target_code for r in made.collect()} == {"1"}
    assert tables.read_selected(spark, path, fmt).columns.count("input_order") == (fmt == "csv")


def test_file_positions_are_dense(spark, ranges, tmp_path):
    spark.range(1000).repartition(7).write.parquet(str(tmp_path / "t"))
    ranges(300)
    got = with_file_position(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert sorted(r.input_order for r in got) == list(range(1000)) and len({r.id for r in got}) == 1000
