"""Command line for spark-submit: one subcommand per job of the chain.

    spark-submit zonehour/plans/cli.py clean-trips --input RAW.parquet --output OUT
    spark-submit zonehour/plans/cli.py clean-weather --input 'RAW/*.gz' --output OUT
    spark-submit zonehour/plans/cli.py profile-trips --input RAW.parquet --output OUT
    spark-submit zonehour/plans/cli.py profile-weather --input 'RAW/*.gz' --output OUT
    spark-submit zonehour/plans/cli.py analyze --taxi-input T --weather-input W \\
        (--output-root OUT | --features-output P --baseline-output P --model-output P --metrics-output P) \\
        [--train-end-date D]
    spark-submit zonehour/plans/cli.py all --raw-trips RAW.parquet --raw-weather 'RAW/*.gz' --output-root OUT

Windows, zone and split date default to the January 2024 study (``Config()``).
The session comes from spark-submit; only a missing checkpoint folder is filled in.
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pyspark.sql import SparkSession  # noqa: E402

from zonehour.config import Config  # noqa: E402
from zonehour.operators.forecast import split_counts  # noqa: E402
from zonehour.operators.profile import profile_trips, profile_weather  # noqa: E402
from zonehour.plans.pipeline import (  # noqa: E402
    PipelinePaths,
    clean_trips_job,
    clean_weather_job,
    evaluate_job,
    features_job,
    run_pipeline,
)
from zonehour.session import ensure_checkpoint_dir, scratch_path  # noqa: E402
from zonehour.sources.readers import read_clean, read_trips, read_weather_lines, stage_weather_lines  # noqa: E402
from zonehour.sources.sinks import write_table  # noqa: E402


def _show(spark: SparkSession, path: str, n: int) -> None:
    """Print ``n`` rows of a written parquet table. ``show`` fetches
    incrementally (one split, then more only if needed), so a preview of a
    100 TB table reads a split, not the table."""
    if n > 0:
        read_clean(spark, path).show(n, truncate=False)


def _config(args) -> Config:
    return Config().with_windows(
        tuple(args.trip_window) if getattr(args, "trip_window", None) else None,
        tuple(args.weather_window) if getattr(args, "weather_window", None) else None,
        getattr(args, "train_end_date", None),
    )


def _windows(p: argparse.ArgumentParser) -> None:
    p.add_argument("--trip-window", nargs=2, metavar=("FIRST_DAY", "LAST_DAY"))
    p.add_argument("--weather-window", nargs=2, metavar=("FIRST_DAY", "LAST_DAY"))


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="zonehour", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--show", type=int, default=0, metavar="N", help="print N rows of each main output")
    sub = ap.add_subparsers(dest="command", required=True)
    for name in ("clean-trips", "clean-weather", "profile-trips", "profile-weather"):
        p = sub.add_parser(name)
        p.add_argument("--input", required=True)
        p.add_argument("--output", required=True)
        _windows(p)
    a = sub.add_parser("analyze")
    a.add_argument("--taxi-input", required=True)
    a.add_argument("--weather-input", required=True)
    a.add_argument("--output-root", help="folder for every output not given its own path")
    for out in ("features", "baseline", "model", "metrics"):
        a.add_argument(f"--{out}-output")
    a.add_argument("--train-end-date")
    _windows(a)
    w = sub.add_parser("all")
    w.add_argument("--raw-trips", required=True)
    w.add_argument("--raw-weather", required=True)
    w.add_argument("--output-root", required=True)
    w.add_argument("--train-end-date")
    w.add_argument("--no-profile", action="store_true")
    w.add_argument("--resume", action="store_true", help="skip stages that an earlier call finished on the same inputs")
    w.add_argument("--drifting", action="store_true", help="the trip files may differ in types and columns")
    _windows(w)
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    ap = parser()
    args = ap.parse_args(argv)
    if args.command == "analyze" and args.output_root is None:
        missing = [f"--{o}-output" for o in ("features", "baseline", "model", "metrics") if not getattr(args, f"{o}_output")]
        if missing:
            ap.error(f"analyze needs --output-root or all of: {', '.join(missing)}")
    spark = spark or SparkSession.builder.appName(f"zonehour-{args.command}").getOrCreate()
    ensure_checkpoint_dir(spark)
    cfg = _config(args)
    if args.command == "clean-trips":
        result = clean_trips_job(spark, args.input, args.output, cfg)
        _show(spark, args.output, args.show)
    elif args.command == "clean-weather":
        result = clean_weather_job(spark, args.input, args.output, cfg)
        _show(spark, args.output, args.show)
    elif args.command in ("profile-trips", "profile-weather"):
        frames = (
            profile_trips(read_trips(spark, args.input), cfg.trips)
            if args.command == "profile-trips"
            else profile_weather(stage_weather_lines(read_weather_lines(spark, args.input), scratch_path(spark, "weather-lines")), cfg.weather)
        )
        result = {}
        for name, df in frames.items():
            write_table(df, f"{args.output.rstrip('/')}/{name}")
            result[name] = f"{args.output.rstrip('/')}/{name}"
    elif args.command == "analyze":
        overrides = tuple(
            (name, path)
            for name, path in (
                ("features", args.features_output),
                ("baseline_predictions", args.baseline_output),
                ("model_predictions", args.model_output),
                ("metrics", args.metrics_output),
            )
            if path
        )
        paths = PipelinePaths(args.taxi_input, args.weather_input, args.output_root or "", overrides)
        features = features_job(spark, args.taxi_input, args.weather_input, paths.out("features"), cfg)
        _show(spark, paths.out("features"), args.show)
        metrics = evaluate_job(spark, features, paths, cfg)
        sides = split_counts(features, cfg.forecast.train_end).first()
        result = {
            "counts": {"features": features.count(), "train": sides.train_rows, "test": sides.test_rows},
            "metrics": [r.asDict() for r in metrics.collect()],  # two rows, one per model
        }
    else:
        paths = PipelinePaths(args.raw_trips, args.raw_weather, args.output_root, drifting=args.drifting)
        out = run_pipeline(spark, paths, cfg, profile=not args.no_profile, resume=args.resume)
        result = {"counts": out["counts"], "metrics": [r.asDict() for r in out["metrics"].collect()]}
    print(json.dumps(result, default=str))
    return result


def run() -> None:
    """Console-script entry point (exit status 0 on success)."""
    main()


if __name__ == "__main__":
    run()
