"""Command line: run the pipeline (or one stage of it) over a JSON contract.

    spark-submit -m dimwright.cli run --contract metadata.json \
        --input s3a://order-drops --root s3a://warehouse --run-id 2025-01-15

Stages: ``ingest``, ``dimensions``, ``warehouse``, ``dq`` or ``run`` (all).
Prints the stage report as one JSON line.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from dimwright.contract import contract_from_dict
from dimwright.plans.job import Pipeline
from dimwright.session import build_session


def load_contract(spark: SparkSession, path: str):
    """Read through Spark: the contract may lie on any filesystem the cluster knows."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise ValueError(f"empty contract: {path}")
    return contract_from_dict(json.loads(text["value"]))


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="dimwright")
    ap.add_argument("stage", choices=["run", "ingest", "dimensions", "warehouse", "dq"])
    ap.add_argument("--contract", required=True)
    ap.add_argument("--input", required=True, help="root holding batch-YYYY-MM-DD/ directories")
    ap.add_argument("--root", required=True, help="output root (feed, dims, warehouse, control)")
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--master", default=None, help="only for local runs; spark-submit sets it")
    a = ap.parse_args(argv)
    spark = build_session(a.master, app="dimwright")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    run_id = a.run_id or now.strftime("run-%Y%m%dT%H%M%S")
    p = Pipeline(spark, load_contract(spark, a.contract), a.input, a.root)
    stage = {"run": lambda: p.run(run_id, now),
             "ingest": lambda: p.run_ingestion(run_id, now),
             "dimensions": lambda: p.run_dimensions(run_id, now),
             "warehouse": lambda: p.run_warehouse(run_id, now),
             "dq": lambda: p.run_dq(run_id, now)}[a.stage]
    out = stage()
    print(json.dumps(out, default=str, sort_keys=True))
    return out


if __name__ == "__main__":
    main()
