import pytest

from cohortlake.__main__ import main
from cohortlake.sources.csvfiles import MissingInputs
from cohortlake.sources import layers, reporttext
from tests.fixture import AS_OF


def test_whole_run(spark, csv_folder, tmp_path, capsys):
    root = str(tmp_path / "warehouse")
    main(["build", "--input", csv_folder, "--warehouse", root, "--as-of", AS_OF])
    assert "users: 6 kept, 4 excluded" in capsys.readouterr().out
    with pytest.raises(MissingInputs):
        main(["compare", "--warehouse", root])
    for layer in ("raw", "staging"):
        main(["check", "--warehouse", root, "--layer", layer, "--as-of", AS_OF])
    out = capsys.readouterr().out
    assert "| `A1` | `users` | **6** |" in out and "| TOTAL | 5 | 7 |" in out
    main(["compare", "--warehouse", root])
    assert "| After | 7 |" in capsys.readouterr().out
    main(["preview", "--warehouse", root])
    out = capsys.readouterr().out
    assert "2024-01-01 | 2 | 5700 | 2850.0 | None" in out
    stored = spark.read.text(f"{root}/quality/compare_report").collect()
    assert any("| `A16` | 2 | 0 | -2 | -100% | secondary |" in r.value for r in stored)
    rows = reporttext.load_compare(spark, f"{root}/quality/compare").collect()
    assert ("A16", 2, 0, -2, -100.0, "secondary") in [tuple(r) for r in rows]
    main(["export", "--warehouse", root, "--to", str(tmp_path / "lists"), "--as-of", AS_OF])
    listed = spark.read.option("header", True).csv(str(tmp_path / "lists/active_students"))
    assert listed.columns[:3] == ["user_id", "email", "enrollment_id"] and listed.count() > 0


def test_load(spark, csv_folder, tmp_path, capsys):
    root = str(tmp_path / "kept")
    main(["load", "--input", csv_folder, "--warehouse", root, "--as-of", AS_OF])
    out = capsys.readouterr().out
    assert "load 1, as of" in out and any(
        line.split() == ["stg_users", "6", "+6"] for line in out.splitlines()
    )


def test_register(spark, csv_folder, tmp_path):
    root = str(tmp_path / "listed")
    main(["build", "--input", csv_folder, "--warehouse", root, "--as-of", AS_OF, "--register"])
    main(["build", "--input", csv_folder, "--warehouse", root, "--as-of", AS_OF, "--register", "--replace"])
    assert "mart_revenue" in layers.list_tables(spark, "marts")
    assert spark.table("staging.stg_users").count() == 6
    for layer in ("raw", "staging", "marts"):
        spark.sql(f"DROP DATABASE {layer} CASCADE")
