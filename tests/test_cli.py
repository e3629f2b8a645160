from faresight.__main__ import main
from faresight.plans import ingest
from tests.conftest import SF_SMALL


def test_cli_list_and_run(spark, capsys, tmp_dir):
    assert main(["list"]) == 0
    assert "monthly_zone_revenue" in capsys.readouterr().out
    assert main(["run", "trips_on_day", "--data", SF_SMALL, "--show", "5"]) == 0
    assert "trips" in capsys.readouterr().out
    out = f"{tmp_dir}/zf"
    assert main(["run", "zone_frequency", "--data", SF_SMALL, "--out", out]) == 0
    assert spark.read.parquet(out).count() == 25


def test_ingest_cli_rejects_missing_arguments(capsys):
    import pytest
    with pytest.raises(SystemExit):
        ingest.main(["--service", "yellow"])
