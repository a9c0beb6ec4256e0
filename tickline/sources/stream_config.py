"""The stream selection: one `service.version.message` a line."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from tickline.functions.fixed import KINDS


def parse_streams(text: str) -> tuple[tuple[int, int, int], ...]:
    """Selected keys in the order of lines.

    Blanks and tabs around a line, empty lines and lines that begin with # do
    not count. ValueError for a line that is no key, a key that is not
    supported or comes twice (leading zeros do not make it another), or no key.
    """
    known, out = {k.key for k in KINDS}, []
    for number, line in enumerate(text.split("\n"), 1):
        line = line.removesuffix("\r").strip(" \t")
        if not line or line.startswith("#"):
            continue
        if not re.fullmatch(r"\d+\.\d+\.\d+", line, re.ASCII):
            raise ValueError(f"line {number} is no stream: {line!r}")
        key = tuple(map(int, line.split(".")))
        if key not in known:
            raise ValueError(f"line {number} selects an unsupported stream: {line}")
        if key in out:
            raise ValueError(f"line {number} selects {line} again")
        out.append(key)
    if not out:
        raise ValueError("no stream is selected")
    return tuple(out)


def load_streams(spark: SparkSession, path: str) -> tuple[tuple[int, int, int], ...]:
    row = spark.read.text(path, wholetext=True).first()
    return parse_streams(row["value"] if row else "")
