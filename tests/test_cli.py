"""The command line on small files."""

from __future__ import annotations

import json

import frames as f

from tickline.__main__ import main


def test_command_line(spark, tmp_path, capsys):
    catalog, streams = tmp_path / "catalog.csv", tmp_path / "streams"
    catalog.write_text("instrument_id,market,security_id_source,security_id\n1,SH,,600000\n")
    streams.write_text("# Shanghai\n4.101.24\n")
    common = ["--trade-date", "20260806", "--catalog", str(catalog), "--stream-config", str(streams)]
    assert main([*common, "--validate-only"]) == 0
    assert json.loads(capsys.readouterr().out) == {"valid": True, "instruments": 1, "streams": 1}
    assert main(["--trade-date", "20260231", "--catalog", str(catalog), "--validate-only"]) == 2
    assert main([*common[:2], "--catalog", str(streams), "--validate-only"]) == 2
    assert main(common) == 2
    f.table(spark, [f.sh_tick(2), f.sh_tick(1), f.sz_order(1)]).write.parquet(str(tmp_path / "frames"))
    capsys.readouterr()
    assert main([*common, "--frames", str(tmp_path / "frames"), "--out", str(tmp_path / "out"), "--strict"]) == 0
    stats = json.loads(capsys.readouterr().out)
    assert (stats["callbacks"], stats["admitted"], stats["rejected"], stats["decoded_ticks"]) == (3, 2, 1, 2)
    assert spark.read.parquet(str(tmp_path / "out/rejected")).first()["admission_result"] == "disabled_message"
