import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from strata.jobs import main


@pytest.fixture
def run(spark, tmp_path, capsys):
    def call(*arguments):
        code = main(["--root", str(tmp_path / "lake"), *arguments])
        return code, capsys.readouterr().out

    yield call
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP SCHEMA IF EXISTS {layer} CASCADE")


def test_events_from_nothing_to_sql(run):
    code, out = run("events", "--n", "100", "--day", "2026-03-02")
    assert code == 0 and "rows=100" in out
    run("register", "bronze", "sample_events", "--day", "2026-03-02")
    run("register", "silver", "sample_events", "--partition-by", "event_date")
    run("register", "gold", "daily_event_counts")
    assert "|100|" in run("count", "bronze", "sample_events")[1]
    assert "|100|" in run("count", "silver", "sample_events")[1]
    assert run("tables", "silver")[1].strip() == "demo_sample_events"
    assert "event_count|bigint" in run("describe", "gold", "daily_event_counts")[1].replace(" ", "")
    assert "2026-03-02" in run("sample", "gold", "daily_event_counts", "--n", "1")[1]
    assert "|100" in run("sql", "SELECT sum(event_count) AS s FROM gold.demo_daily_event_counts")[1]
    assert run("sync", "silver", "sample_events")[0] == 0
    assert run("drop", "bronze", "sample_events")[0] == 0
    assert run("tables", "bronze")[1].strip() == ""
    assert ".parquet" in run("files", "silver/demo/sample_events")[1]


def test_flights_and_models(run, flights_csv):
    assert run("flights", flights_csv)[0] == 0
    run("register", "silver", "flights", "--project", "aviation")
    assert run("models", "--project", "aviation")[1].split() == ["carrier_delay_spread", "carrier_summary"]
    assert run("build", "carrier_delay_spread", "--project", "aviation")[0] == 0
    assert run("build-all", "--project", "aviation")[0] == 0
    assert run("build", "nothing", "--project", "aviation")[0] == 2
    assert "|3" in run("count", "gold", "carrier_summary", "--project", "aviation")[1]


def test_any_csv(run, flights_csv):
    assert "rows=3" in run("ingest", "raw_flights", flights_csv)[1]


def test_topics(run):
    assert run("produce", "demo.events", "--n", "10")[0] == 0
    assert run("produce", "other", "--n", "2", "--prefix", "x")[0] == 0
    out = run("consume", "demo.events", "--n", "3")[1]
    assert "event_3" in out and "event_4" not in out
    listing = run("topics")[1]
    assert "demo.events" in listing and "other" in listing


def test_models_are_found_inside_a_zip(tmp_path):
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "strata", tmp_path / "pack" / "strata", ignore=shutil.ignore_patterns("__pycache__"))
    archive = shutil.make_archive(str(tmp_path / "strata"), "zip", tmp_path / "pack")
    code = "from strata.plans import list_models; print(list_models('aviation'), list_models('x'))"
    out = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": archive}, capture_output=True, text=True, timeout=120
    )
    assert out.stdout.strip() == "['carrier_delay_spread', 'carrier_summary'] []", out.stderr


def test_all_rows_are_given(spark, tmp_path, capsys):
    root = str(tmp_path / "lake")
    assert main(["--root", root, "sql", "SELECT * FROM range(100)"]) == 0
    assert len([x for x in capsys.readouterr().out.splitlines() if x.startswith("|")]) == 101
    assert main(["--root", root, "produce", "t", "--n", "60"]) == 0
    capsys.readouterr()
    assert main(["--root", root, "consume", "t", "--n", "50"]) == 0
    assert capsys.readouterr().out.count("|event_") == 50
    out = str(tmp_path / "out")
    assert main(["--root", root, "sql", "SELECT * FROM range(100)", "--out", out]) == 0
    assert spark.read.parquet(out).count() == 100


def test_any_dataset_by_mapping(spark, tmp_path, capsys):
    root, source = str(tmp_path / "lake"), tmp_path / "in.csv"
    source.write_text("Id,Amount,Note\n1,2.5,a\n2,n/a,b\n3,4.5\n")
    assert main(["--root", root, "ingest-text", "sales", str(source)]) == 0
    assert "'malformed': 1" in capsys.readouterr().out
    columns = ["--column", "id:bigint", "--column", "amount:double:paid"]
    assert main(["--root", root, "silver", "sales", *columns]) == 0
    assert "'rejects': 1" in capsys.readouterr().out
    assert main(["--root", root, "gold", "total", f"SELECT sum(paid) AS paid FROM parquet.`{root}/silver/demo/sales`"]) == 0
    assert [r.paid for r in spark.read.parquet(f"{root}/gold/demo/total").collect()] == [7.0]
    assert main(["--root", root, "files", "silver"]) == 0
    assert ".parquet" in capsys.readouterr().out
    assert main(["--root", root, "produce", "t", "--n", "4"]) == 0
    assert main(["--root", root, "stream-topic", "t", "messages"]) == 0
    assert spark.read.parquet(f"{root}/bronze/demo/messages").count() == 4
    spark.sql("DROP TABLE IF EXISTS gold.demo_total")


def test_new_files_gate_compaction_and_drift(spark, tmp_path, capsys):
    source, root = tmp_path / "in", str(tmp_path / "lake")
    source.mkdir()
    (source / "a.csv").write_text("Id,Amount\n1,10\n2,n/a\n")

    def run(*arguments):
        assert main(["--root", root, *arguments]) == 0
        return capsys.readouterr().out

    assert "rows=2" in run("ingest-new", "orders", str(source))
    assert "rows=0" in run("ingest-new", "orders", str(source))
    columns = ["--column", "id:bigint", "--column", "amount:double"]
    assert run("stream-silver", "orders", *columns).splitlines() == ["|column_name|row_count|", "|amount|1|"]
    assert "|amount|string|1|2|0|" in run("drift", "bronze", "orders")
    for k in range(3):
        spark.range(2).selectExpr(f"{k} AS n", "'x' AS dt").coalesce(1).write.mode("append").partitionBy(
            "dt"
        ).parquet(f"{root}/silver/demo/many")
    assert run("compact", "silver", "many", "--key", "dt").strip() == "dt=x: (3, 1)"


def test_throughput_of_a_topic(spark, tmp_path, capsys):
    root = str(tmp_path / "lake")
    assert main(["--root", root, "produce", "t", "--n", "5"]) == 0
    assert main(["--root", root, "stream-throughput", "t", "counts", "--late-by", "0 seconds", "--every", "1 second"]) == 0
    assert "|window_start|window_end|event_date|event_count|late_count|" in capsys.readouterr().out
