"""Command-line jobs: one triggered pipeline run, one ingestion run, or a synthetic delivery.

    python -m quarterdeck run --landing L --new-unit-json J --master M --lake OUT --checkpoints C
    python -m quarterdeck ingest --control C.parquet --source S --landing L --audit A --run-group daily
    python -m quarterdeck generate --root DIR --days 10 --seed 44

On a cluster, submit the same module with spark-submit; the session comes from the
environment (its settings, including ``spark.checkpoint.dir``, are used as given).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from quarterdeck.session import ensure_utc


def run_ingest_job(spark: SparkSession, control_path: str, source: str, landing: str, audit_path: str, run_group: str | None = None) -> None:
    """One ingestion run over a control table: landing files, audit rows, advanced watermarks.

    Source objects are Parquet folders ``{source}/{source_schema}/{source_table}``; a database is
    read by passing another reader to ``run_ingestion``.
    """
    from quarterdeck.schemas import INGESTION_CONTROL
    from quarterdeck.sources.ingest import append_run_audit, run_ingestion

    def reader(session: SparkSession, row):
        return session.read.parquet("/".join(x.rstrip("/") for x in (source, row["source_schema"], row["source_table"])))

    # the control table is configuration: one row per object, held while its file is replaced
    control = spark.createDataFrame(spark.read.schema(INGESTION_CONTROL).parquet(control_path).collect(), INGESTION_CONTROL)
    audit, updated = run_ingestion(spark, control, reader, landing, run_group)
    append_run_audit(audit, audit_path)
    spark.createDataFrame(updated.collect(), INGESTION_CONTROL).coalesce(1).write.mode("overwrite").parquet(control_path)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="quarterdeck")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="one triggered run of the medallion pipeline")
    for name in ("landing", "new-unit-json", "master", "lake", "checkpoints"):
        run.add_argument(f"--{name}", required=True)
    run.add_argument("--max-files-per-trigger", type=int, default=None)
    run.add_argument("--date-grain", choices=("day", "month"), default="day")
    ing = sub.add_parser("ingest", help="extract every active object of the control table into the landing area")
    for name in ("control", "source", "landing", "audit"):
        ing.add_argument(f"--{name}", required=True)
    ing.add_argument("--run-group", default=None)
    gen = sub.add_parser("generate", help="land a synthetic delivery (POS CSV, JSON, energy, masters)")
    gen.add_argument("--root", required=True)
    gen.add_argument("--days", type=int, default=10)
    gen.add_argument("--seed", type=int, default=44)
    gen.add_argument("--countries", type=int, default=38)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"quarterdeck-{args.cmd}").getOrCreate()
    ensure_utc(spark)
    if args.cmd == "run":
        from quarterdeck.streaming.pipeline import LakeLayout, run_pipeline

        layout = LakeLayout(
            landing=args.landing,
            new_unit_json=args.new_unit_json,
            master=args.master,
            lake=args.lake,
            checkpoints=args.checkpoints,
            max_files_per_trigger=args.max_files_per_trigger,
            date_grain=args.date_grain,
        )
        run_pipeline(spark, layout)
    elif args.cmd == "ingest":
        run_ingest_job(spark, args.control, args.source, args.landing, args.audit, args.run_group)
    else:
        from quarterdeck.sources.synthetic import write_landing

        for k, v in write_landing(spark, args.root, args.days, args.seed, args.countries).items():
            print(f"{k}\t{v}")


if __name__ == "__main__":
    main()
