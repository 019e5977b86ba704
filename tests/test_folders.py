"""The sink that writes several folders from one evaluation."""

import json

import pytest
from pyspark.sql import functions as F

from corpusmill.sources import folders


def lines(path):
    return sorted(x for f in path.glob("*.jsonl") for x in f.read_text().splitlines())


def test_rows_are_evaluated_once_and_put_in_all_their_folders(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(100).repartition(3).mapInArrow(count, "id long").select("id", F.element_at(F.array(F.lit("latin"), F.lit("cyrillic"), F.lit("other"), F.lit(None).cast("string")), (F.col("id") % 4 + 1).cast("int")).alias("alphabet"))
    out = tmp_path / "o"
    folders.write_by_alphabet(df, f"file:{out}")
    assert seen.value == 100
    assert sorted(json.loads(x)["id"] for x in lines(out / "all")) == list(range(100))
    assert sorted(json.loads(x)["id"] for x in lines(out / "by_alphabet/alphabet=latin")) == list(range(0, 100, 4))
    assert {p.name for p in (out / "by_alphabet").iterdir()} == {"alphabet=latin", "alphabet=cyrillic"}
    assert spark.read.json(f"{out}/by_alphabet").where("alphabet = 'cyrillic'").count() == 25
    assert [p.name for p in tmp_path.iterdir()] == ["o"]


def test_a_task_that_fails_leaves_the_old_files(spark, tmp_path):
    out = tmp_path / "o"
    rows = spark.createDataFrame([("old", ["a", "a"])], "line string, folders array<string>")
    folders.write_folders(rows, str(out))

    def fail(batches):
        for b in batches:
            yield b
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        folders.write_folders(rows.union(rows).mapInArrow(fail, "line string, folders array<string>"), str(out))
    with pytest.raises(Exception, match="outside the target"):
        folders.write_folders(rows.withColumn("folders", F.array(F.lit("../x"))), str(out))
    assert lines(out / "a") == ["old"] and [p.name for p in tmp_path.iterdir()] == ["o"]
    with pytest.raises(Exception, match="FileExistsError"):
        folders.write_folders(rows, str(out), overwrite=False)
    folders.write_folders(rows.withColumn("line", F.lit("é new")), str(out))
    assert lines(out / "a") == ["é new"]
    folders.write_folders(rows.limit(0), str(out))
    assert lines(out / "a") == [] and out.exists()


def test_files_of_a_task_that_ran_twice_count_once(tmp_path):
    import pyarrow as pa

    w = folders.FolderWriter(str(tmp_path / "o"), True)
    batch = pa.RecordBatch.from_pydict({"line": ["x"], "folders": [["a"]]})
    w.write(iter([batch]))  # an attempt whose answer was lost
    w.commit([w.write(iter([batch])), None])
    assert lines(tmp_path / "o/a") == ["x"]
