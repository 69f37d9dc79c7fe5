"""Stages of the registry as a Spark job.

    spark-submit lamina/__main__.py run --root s3a://bucket/registry --run-id 2024-01
    spark-submit lamina/__main__.py load --root ... --run-id ... --jdbc-url jdbc:postgresql://host/db

The database user and password are read from the variables LAMINA_DB_USER and LAMINA_DB_PASSWORD.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from lamina.plans import registry  # noqa: E402
from lamina.schemas import ENRICHED, KEY, STAGES  # noqa: E402
from lamina.session import build_session  # noqa: E402
from lamina.sinks import publish_jdbc  # noqa: E402
from lamina.sources import read_manifest  # noqa: E402


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="lamina", description="Run stages of the registry.")
    parser.add_argument("stage", choices=["run", *STAGES], help="run: all stages that are still to do")
    parser.add_argument("--root", required=True, help="folder of the layers")
    parser.add_argument("--run-id", required=True)
    parser.add_argument("--companies", action="append", default=[], help="archive to use instead of raw/<run>")
    parser.add_argument("--partners", action="append", default=[], help="archive to use instead of raw/<run>")
    parser.add_argument("--manifest", help="file of URLs, one per line, that must have arrived")
    parser.add_argument("--entry-suffix", default=".csv")
    parser.add_argument("--multi-line", action="store_true", help="allow line breaks inside quotes")
    parser.add_argument("--order-by", help="column whose greatest value picks one row of a duplicate key")
    parser.add_argument("--target", help="folder of the published table")
    parser.add_argument("--jdbc-url", help="publish to this database instead")
    parser.add_argument("--jdbc-table", default="cnpj_resultado")
    parser.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    return parser.parse_args(argv)


def execute(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    """Run one stage, or what the ledger shows as pending; returns the stages that ran."""

    def to_database(result: DataFrame) -> None:
        login = {"user": os.environ["LAMINA_DB_USER"], "password": os.environ["LAMINA_DB_PASSWORD"]}
        properties = {"driver": args.jdbc_driver, **login}
        publish_jdbc(result, args.jdbc_url, args.jdbc_table, ENRICHED, KEY, args.run_id, properties, args.order_by)

    explicit = {"empresas": args.companies, "socios": args.partners}
    return registry.run(
        spark,
        args.root,
        args.run_id,
        publish=to_database if args.jdbc_url else None,
        target=args.target,
        manifest=read_manifest(spark, args.manifest) if args.manifest else None,
        order_by=args.order_by,
        stages=STAGES if args.stage == "run" else [args.stage],
        again=args.stage != "run",
        explicit=explicit if any(explicit.values()) else None,
        entry_suffix=args.entry_suffix,
        multi_line=args.multi_line,
    )


if __name__ == "__main__":
    options = arguments()
    session = build_session(f"lamina-{options.stage}")
    print("stages run:", ", ".join(execute(session, options)) or "none")
    session.stop()
