"""The command line, from a CSV file of the older version to stored results."""

import pytest

from fleetscope.__main__ import main
from fleetscope.schema import TELEMETRY_V1
from fleetscope.sinks.writers import replace_table
from tests.fixture import READINGS, rows


@pytest.fixture
def csv(spark, tmp_path):
    good = [r for r in READINGS if r[3] == "FL_01" and r[-1] is not None]
    replace_table(rows(spark, good).select(*TELEMETRY_V1.fieldNames()), str(tmp_path / "in"), "csv")
    return ["--input", str(tmp_path / "in"), "--format", "csv", "--start", "2026-04-01"]


def test_load_analyse_review_query(csv, tmp_path, capsys):
    target = str(tmp_path / "out")
    main(["validate", *csv])
    assert "Validation passed" in capsys.readouterr().out
    main(["load", *csv, "--target", target])
    assert "written=4, stored=4" in capsys.readouterr().out
    main(["analyse", "--input", f"{target}/telemetry", "--target", target])
    assert "zone_counts: 2 rows" in capsys.readouterr().out
    main(["export", "--input", f"{target}/telemetry", "--target", f"{target}/csv"])
    main(["publish", "--input", f"{target}/csv", "--target", target])
    assert capsys.readouterr().out.count("analysis_zone_counts") == 1
    main(["review", "--target", target])
    assert (tmp_path / "out" / "review_report").is_dir()
    main(["query", *csv, "--name", "zone_risk"])
    assert "|Storage|1" in capsys.readouterr().out.replace(" ", "")
    main(["query", *csv, "--name", "top_unauthorized_forklifts"])
    assert "FL_01" in capsys.readouterr().out


def test_unknown_query_is_refused(csv):
    with pytest.raises(SystemExit):
        main(["query", *csv, "--name", "nothing"])
