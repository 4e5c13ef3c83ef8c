"""Run a report or the audit suite from the command line.

    python -m wardline Q15 --root /data/hospital --show 20
    python -m wardline Q2 --root /data/hospital --arg "Χειρουργική" --out /data/out/q2
    python -m wardline audit --root /data/hospital --out /data/out/audit

``--root`` holds one Parquet folder (or ``<table>.parquet``) per hospital
table.  Positional report arguments go in ``--arg`` (repeatable, parsed as
date, int or text); ``--out`` writes Parquet, otherwise rows are shown.  The
session comes from ``SparkSession.builder`` (cluster settings win); a local
one is created only when not launched by ``spark-submit`` and no ``--master`` is given.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

from pyspark.sql import SparkSession


def _value(text: str):
    """A date (YYYY-MM-DD), an integer written without leading zeros, or the text itself (keys like 01234567890)."""
    try:
        return dt.date.fromisoformat(text)
    except ValueError:
        pass
    try:
        number = int(text)
    except ValueError:
        return text
    return number if str(number) == text else text


def main(argv: list[str] | None = None) -> int:
    from wardline.plans import reports, rules
    from wardline.session import ensure_checkpoint_dir, local_session
    from wardline.sources.schemas import SCHEMAS
    from wardline.sources.tables import TableSet, write_table

    ap = argparse.ArgumentParser(prog="wardline", description=__doc__.splitlines()[0])
    ap.add_argument("what", help="Q1..Q15, 'audit' (all constraints and trigger rules) or 'rules' (triggers only)")
    ap.add_argument("--root", required=True, help="folder with one parquet table per hospital table")
    ap.add_argument("--arg", action="append", default=[], help="positional report argument (repeatable)")
    ap.add_argument("--out", help="write the result as parquet here instead of showing it")
    ap.add_argument("--show", type=int, default=20, help="rows to show when --out is not given")
    ap.add_argument("--master", help="Spark master; default: the submitting cluster's, else local[*]")
    ap.add_argument("--suffix", help="table folder suffix, e.g. '' or '.parquet' (default: detect on a local root)")
    ns = ap.parse_args(argv)

    if ns.master:
        spark = SparkSession.builder.master(ns.master).getOrCreate()
    elif os.environ.get("SPARK_ENV_LOADED") or os.environ.get("PYSPARK_GATEWAY_PORT"):
        spark = SparkSession.builder.getOrCreate()  # launched by spark-submit: keep its settings
    else:
        spark = local_session()
    ensure_checkpoint_dir(spark)
    tables = TableSet(spark, ns.root, schemas=SCHEMAS, suffix=ns.suffix)
    what = ns.what.upper()
    if what in reports.REPORTS:
        df = reports.REPORTS[what](tables, *[_value(a) for a in ns.arg])
    elif what == "AUDIT":
        df = rules.audit_all(tables)
    elif what == "RULES":
        df = rules.trigger_rules(tables)
    else:
        ap.error(f"unknown report {ns.what!r}; use Q1..Q15, audit or rules")
        return 2
    if ns.out:
        write_table(df, ns.out)
    else:
        df.show(ns.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
