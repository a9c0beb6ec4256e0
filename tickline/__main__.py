"""python -m tickline: one run over a table of frames, with its counters as a line of JSON."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from tickline.plans.config import FROM_OPEN, PARTIAL, EngineConfig
from tickline.plans.pipeline import run, strict
from tickline.sources.catalog_file import load_catalog
from tickline.sources.stream_config import load_streams

OUTPUTS = ("ticks", "snapshots", "late", "gaps", "faults", "rejected", "engine_faults")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tickline", description=__doc__)
    p.add_argument("--mode", choices=("from-open", "partial"), default="from-open")
    p.add_argument("--trade-date", type=int, required=True, help="YYYYMMDD")
    p.add_argument("--catalog", required=True, help="catalog file")
    p.add_argument("--stream-config", help="file of the streams to take; all five without it")
    p.add_argument("--owners", type=int, default=1)
    p.add_argument("--frames", help="Parquet table of frames")
    p.add_argument("--out", help="folder for the outputs; without it only the counters are computed")
    p.add_argument("--strict", action="store_true", help="fail on what would stop a live engine")
    p.add_argument("--validate-only", action="store_true", help="check settings, catalog and streams, and stop")
    return p


def main(args: list[str] | None = None) -> int:
    """0 if all is well, 2 for settings or files that no run can have, 1 for a fault under --strict."""
    o = parser().parse_args(args)
    spark = SparkSession.builder.appName("tickline").getOrCreate()
    try:
        config = EngineConfig(trade_date=o.trade_date, mode=FROM_OPEN if o.mode == "from-open" else PARTIAL, owners=o.owners)
        if o.stream_config:
            config = replace(config, streams=load_streams(spark, o.stream_config))
        catalog = load_catalog(spark, o.catalog)
        if not o.validate_only and not o.frames:
            raise ValueError("--frames is needed")
    except (OSError, ValueError) as e:
        print(f"invalid: {e}", file=sys.stderr)
        return 2
    if o.validate_only:
        print(json.dumps({"valid": True, "instruments": catalog.count(), "streams": len(config.streams)}))
        return 0
    out = run(spark.read.parquet(o.frames), catalog, config, folder=f"{o.out}/work" if o.out else None)
    if o.out:
        for name in OUTPUTS:
            getattr(out, name).write.mode("overwrite").parquet(f"{o.out}/{name}")
    print(json.dumps(out.stats().first().asDict()))
    if o.strict:
        try:
            strict(out)
        except RuntimeError as e:
            print(f"fault: {e}", file=sys.stderr)
            return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
