"""Files, stage tables, and the steps run through the command line."""

from __future__ import annotations

import csv
import datetime
import random

import pytest
from pyspark.errors import AnalysisException

from quotewell.__main__ import main
from quotewell.plans.steps import STEPS, Workspace
from quotewell.sources import runlog, tables
from quotewell.sources.schemas import BASELINE_PREDICTIONS, CLEANED, SchemaError, schema_problems
from quotewell.sources.stages import Stages, shared_folder

HEADER = [
    "State", "District Name", "Market Name", "Commodity", "Variety", "Grade",
    "Min. Price", " Max. Price", "Modal Price", "Price Date",
]


@pytest.fixture(scope="module")
def raw_csv(tmp_path_factory):
    rng = random.Random(4)
    path = tmp_path_factory.mktemp("raw") / "raw.csv"
    with open(path, "w", newline="") as handle:
        writer = csv.writer(handle)
        writer.writerow(HEADER)
        ends = {"Onion": 400, "Potato": 400, "Tomato": 150, "Rice": 300}
        for state in ("Kerala", " Punjab", "Tamilnadu"):
            for commodity, end in ends.items():
                price = 2000.0
                for day in range(0, end, 3):
                    price = max(100.0, price + rng.gauss(0, 40))
                    date = datetime.date(2023, 6, 6) + datetime.timedelta(days=day)
                    writer.writerow([
                        state, "D", f"M{day % 2}", commodity, "V", "FAQ",
                        round(price * 0.9, 2), round(price * 1.1, 2),
                        round(price, 2) if day % 50 else "NA", f"{date.month}/{date.day}/{date.year}",
                    ])
    return str(path)


def test_raw_file_is_text_with_missing_cells(spark, raw_csv):
    raw = tables.read_raw_quotes(spark, raw_csv)
    assert raw.columns == HEADER
    assert {kind for _, kind in raw.dtypes} == {"string"}
    assert raw.where("`Modal Price` is null").count() > 0
    assert raw.where("State = ' Punjab'").count() > 0


def test_date_that_stays_text_is_an_error(spark, tmp_path):
    row = ("s", "d", "m", "c", "v", "g", 1.0, datetime.date(2024, 1, 1))
    good = spark.createDataFrame([row], CLEANED)
    tables.write_table(good, f"{tmp_path}/good")
    assert tables.read_table(spark, f"{tmp_path}/good", CLEANED).collect() == good.collect()
    tables.write_table(good.withColumn("price_date", good["price_date"].cast("string")),
                       f"{tmp_path}/text")
    with pytest.raises(SchemaError, match="price_date: string instead of date"):
        tables.read_table(spark, f"{tmp_path}/text", CLEANED)
    tables.write_table(good.drop("grade"), f"{tmp_path}/short")
    with pytest.raises(SchemaError, match="grade"):
        tables.read_table(spark, f"{tmp_path}/short", CLEANED)
    tables.write_table(good.selectExpr(
        "state", "district_name", "market_name", "commodity", "variety", "grade", "modal_price",
        "'junk' as price_date"), f"{tmp_path}/csv", "csv")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        tables.read_table(spark, f"{tmp_path}/csv", CLEANED, "csv").collect()


def test_labels_that_look_like_numbers_survive_as_folder_names(spark, tmp_path):
    row = ("s", "d", "m", "007", "v", "g", 1.0, datetime.date(2024, 1, 1))
    tables.write_table(spark.createDataFrame([row], CLEANED), f"{tmp_path}/t",
                       partition_by=["commodity"])
    back = tables.read_table(spark, f"{tmp_path}/t", CLEANED, partitioned_by=["commodity"])
    assert [tuple(r) for r in back.collect()] == [row]


def test_saved_row_count(spark, tmp_path):
    path = f"{tmp_path}/baseline"
    assert tables.saved_row_count(spark, path, BASELINE_PREDICTIONS) is None
    rows = [("s", "c", datetime.date(2024, 1, 1), 1.0, 2.0)] * 2
    tables.write_baseline_predictions(spark.createDataFrame(rows, BASELINE_PREDICTIONS), path)
    assert tables.saved_row_count(spark, path, BASELINE_PREDICTIONS) == 2


def test_stages_are_written_once_below_the_shared_folder(spark):
    stages = Stages(spark)
    assert stages.root.startswith(shared_folder(spark))
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    first, second = stages.once("t", build), stages.once("t", build)
    assert first is second
    assert (len(built), first.count()) == (1, 3)


def test_steps_hand_over_through_tables(spark, raw_csv, tmp_path):
    folder = f"{tmp_path}/ws"
    main(["all", "--folder", folder, "--raw", raw_csv, "--trees", "2"])
    ws = Workspace(spark, folder)
    cleaned = ws.cleaned()
    assert schema_problems(cleaned, CLEANED) == []
    assert {r[0] for r in cleaned.select("state").distinct().collect()} == {
        "Kerala", "Punjab", "Tamil Nadu",
    }
    assert "Rice" not in {r[0] for r in cleaned.select("commodity").distinct().collect()}
    assert ws.features().count() == cleaned.count() > 800  # one quote per group and date
    report = spark.read.parquet(f"{folder}/reports/residual/comparison")
    assert report.where("mae_direct is null").count() == 0
    assert runlog.read_run_records(spark, f"{folder}/run_log").count() == 2
    steps = {r.step: r.n for r in spark.read.parquet(f"{folder}/reports/clean/steps").collect()}
    assert steps["outlier removal"] == cleaned.count()
    checked = spark.read.parquet(f"{folder}/reports/residual/cross_check").collect()
    assert all(r.logged is not None for r in checked)


def test_all_reports_of_a_workspace_share_one_read_of_the_raw_file(spark, raw_csv, tmp_path):
    ws = Workspace(spark, f"{tmp_path}/ws", raw_csv)
    reports = {**STEPS["clean"](ws), **STEPS["gaps"](ws)}
    for name, report in reports.items():
        files = report.inputFiles()
        assert files and all(path.endswith(".parquet") for path in files), name
    assert ws.raw() is ws.raw()
    ws.stages.close()


def test_a_step_without_its_input_fails_and_reports_can_be_csv(spark, raw_csv, tmp_path):
    with pytest.raises(ValueError, match="raw quote file"):
        main(["clean", "--folder", f"{tmp_path}/a"])
    with pytest.raises(AnalysisException):
        main(["features", "--folder", f"{tmp_path}/a"])
    main(["clean", "granularity", "--folder", f"{tmp_path}/b", "--raw", raw_csv, "--reports", "csv"])
    verdict = spark.read.csv(f"{tmp_path}/b/reports/granularity/verdict", header=True)
    assert {r.granularity for r in verdict.collect()} == {"market_commodity", "state_commodity"}
    assert Workspace(spark, f"{tmp_path}/b").saved_model("DIRECT") is None


def test_doubled_quotes_and_commas_in_cells(spark, tmp_path):
    path = tmp_path / "quoted.csv"
    path.write_text('State,Modal Price,Min Price\n"He said ""x"", y",6,2\n')
    assert [tuple(r) for r in tables.read_raw_quotes(spark, str(path)).collect()] == [
        ('He said "x", y', "6", "2")
    ]


def test_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("State,Modal Price\nGoa,1\n\nAssam,NA\n")
    (tmp_path / "b.csv").write_text("\ufeffmodal_price,STATE,Grade\r\n2,Kerala,FAQ\r\n")
    (tmp_path / "c.csv").write_text('\n"Grade"\n"A\nB"\n')
    (tmp_path / "d.csv").write_text("")
    found = tables.read_raw_quotes(spark, str(tmp_path))
    assert found.columns == ["State", "Modal Price", "Grade"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted([
        ("Goa", "1", None), ("Assam", None, None), ("Kerala", "2", "FAQ"), (None, None, "A\nB"),
    ], key=str)


@pytest.mark.parametrize("split", [60, 1 << 20])
def test_line_breaks_in_quoted_cells(spark, tmp_path, split):
    rng = random.Random(split)
    cells = ["plain", "", "a,b", 'say ""hi""', "two\nlines", "\n\n", 'end ""\n"" x', ",\n,", "é\n"]
    rows = [[rng.choice(cells) for _ in range(3)] for _ in range(30)]

    def shown(cell: str) -> str:
        return f'"{cell}"' if set(cell) & set('",\n') or rng.random() < 0.2 else cell

    body = "\n".join(",".join(shown(c) for c in row) for row in rows)
    (tmp_path / "a.csv").write_text(f'x,"y",z\n{body}\n')
    (tmp_path / "b.csv").write_text('z,y,x\nin "quotes" here,5" pipe,1\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        found = tables.read_raw_quotes(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expected = [tuple(c.replace('""', '"') or None for c in row) for row in rows]
    expected.append(("1", '5" pipe', 'in "quotes" here'))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_a_cell_that_is_not_closed_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('State,Modal Price\n"Goa,1\nAssam,2\n')
    with pytest.raises(ValueError, match="not closed"):
        tables.read_raw_quotes(spark, str(tmp_path))


def test_a_repeated_name_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("State,state \nGoa,1\n")
    with pytest.raises(ValueError, match="repeats a name"):
        tables.read_raw_quotes(spark, str(tmp_path))
