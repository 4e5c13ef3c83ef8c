"""The command line runs a report and the audit over a folder of parquet tables."""

from __future__ import annotations

from wardline.__main__ import main
from wardline.sources.tables import write_hospital


def test_cli_report_and_audit(spark, hospital, tmp_path):
    root = str(tmp_path / "h")
    write_hospital(hospital, root)
    assert main(["Q15", "--root", root, "--out", str(tmp_path / "q15")]) == 0
    assert spark.read.parquet(str(tmp_path / "q15")).count() == 4  # level 2 in two departments, levels 1 and 3
    assert main(["Q8", "--root", root, "--arg", "2025-05-20", "--arg", "1", "--out", str(tmp_path / "q8")]) == 0
    assert spark.read.parquet(str(tmp_path / "q8")).count() == 7
    assert main(["rules", "--root", root, "--suffix", "", "--out", str(tmp_path / "rules")]) == 0
    assert spark.read.parquet(str(tmp_path / "rules")).count() > 0


def test_cli_keeps_leading_zero_keys():
    import datetime as dt

    from wardline.__main__ import _value

    assert _value("01234567890") == "01234567890"
    assert _value("1") == 1 and _value("-3") == -3
    assert _value("2025-05-20") == dt.date(2025, 5, 20)
    assert _value("Χειρουργική") == "Χειρουργική"
