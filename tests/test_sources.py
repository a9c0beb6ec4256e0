from __future__ import annotations

import pytest

from tickline.operators.catalog import build_catalog
from tickline.operators.dispatch import lower_percentiles
from tickline.sources.catalog_file import HEADER, load_catalog
from tickline.sources.stream_config import load_streams, parse_streams
from tickline.sources.synthetic import arrivals


def test_catalog_file(spark, tmp_path):
    path = tmp_path / "catalog.csv"
    path.write_text(HEADER + "\r\n1,SH,,600000\n2,SZ,102,000001\r\n")
    rows = load_catalog(spark, str(path)).orderBy("instrument_ordinal").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "SH", "", "600000"), (2, 1, "SZ", "102", "000001")]


@pytest.mark.parametrize("text", ["id,market\n", HEADER + "\n1,SH,,600000\n\n2,SZ,102,000001\n", HEADER + "\nx,SH,,600000\n", HEADER + "\n1,SH,600000\n", HEADER + "\n1,SH,,6,7\n", HEADER + "\n", HEADER + "\n1,SH,102,600000\n", HEADER + "\n1,SZ,,000001\n", HEADER + "\n1,HK,,1\n", HEADER + "\n1,SH,,1\n1,SH,,2\n", HEADER + "\n1,SH,,1\n2,SH,,1\n", HEADER + "\n0,SH,,1\n"])
def test_bad_catalog_files(spark, tmp_path, text):
    path = tmp_path / "catalog.csv"
    path.write_text(text)
    with pytest.raises(ValueError):
        load_catalog(spark, str(path))


def test_empty_catalog(spark):
    with pytest.raises(ValueError, match="empty"):
        build_catalog(spark.createDataFrame([], "ordinal bigint, instrument_id bigint, market string, security_id_source string, security_id string"))


def test_streams(spark, tmp_path):
    assert parse_streams("# all\n 4.101.24\t\n\n6.101.33\r\n") == ((4, 101, 24), (6, 101, 33))
    for bad in ("", "# none\n", "4.101", "4.101.24\n004.101.24", "1.2.3", "4.101.24 # x", "a.b.c"):
        with pytest.raises(ValueError):
            parse_streams(bad)
    path = tmp_path / "streams.conf"
    path.write_text("4.101.4\n")
    assert load_streams(spark, str(path)) == ((4, 101, 4),)


def test_synthetic_orders(spark):
    for window in (1, 4):
        rows = arrivals(spark, 48, 3, window).collect()
        for c in (1, 2, 3):
            seqs = [r["native_sequence"] for r in sorted(rows, key=lambda r: r["ingress_sequence"]) if r["channel"] == c]
            assert sorted(seqs) == list(range(1, 17))
            assert seqs == [b * window + window - i for b in range(16 // window) for i in range(window)]


def test_lower_percentiles(spark):
    df = spark.createDataFrame([("a", x) for x in (4, 1, 3, 2, None)] + [("b", 7)] * 5, "k string, x int")
    rows = {r["k"]: list(r)[1:] for r in lower_percentiles(df, ["k"], "x", {"least": 0, "half": 0.5, "most": 0.9, "all": 1}).collect()}
    assert rows == {"a": [1, 2, 3, 4], "b": [7] * 4}
