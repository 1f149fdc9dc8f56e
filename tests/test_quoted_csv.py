from __future__ import annotations

import csv
from pathlib import Path

import pytest

from quotewell.sources.stages import Stages
from quotewell.sources.tables import read_raw_quotes


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_records_are_not_written_again(spark, tmp_path, small_splits):
    rows = [(f"M{k}", f'stall "{k}",\n\nrow {k}\n' if k % 2 else "plain", str(k))
            for k in range(4000)]
    # One cell is longer than several splits, one lies at the end of the file.
    rows[7] = ("long", "a line\n" * 3000, "7")
    rows.append(("last", "end\n", "8"))
    path = tmp_path / "quotes.csv"
    with path.open("w", newline="") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerows([("market\nname", "note", "n"), *rows])
    stages = Stages(spark, str(tmp_path / "stages"))
    found = read_raw_quotes(spark, str(path), stages)
    assert found.columns == ["market\nname", "note", "n"]
    assert sorted(map(tuple, found.collect())) == sorted(rows)
    # Only the pieces of records that cross a split are written, not the 4,001 records.
    kept = [spark.read.parquet(str(folder)) for folder in sorted(Path(stages.root).iterdir())]
    texts = [table.where("length(value) < 10000").count() for table in kept
             if "value" in table.columns]
    assert texts and max(texts) < 400
