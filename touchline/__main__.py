"""The two jobs, for ``spark-submit`` or ``python -m touchline``."""

from __future__ import annotations

import argparse

from touchline.plans import daily
from touchline.plans.jobs import REPORTS
from touchline.session import LARGE_STATE, build
from touchline.sources import read_stream, read_teams
from touchline.streaming import run_all


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="touchline", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    batch = jobs.add_parser("daily", help="raw JSON to flat Parquet, then the reports")
    batch.add_argument("--raw", required=True, help="root of the raw zone")
    batch.add_argument("--silver", required=True, help="root of the flat Parquet")
    batch.add_argument("--report", action="append", choices=REPORTS, help="one report; may be repeated")
    batch.add_argument("--mode", default="PERMISSIVE", choices=["PERMISSIVE", "FAILFAST"], help="FAILFAST stops at bad text")
    batch.add_argument("--max-rejects", type=float, default=0.01, help="share of bad records beyond which the run fails")
    batch.add_argument("--lines", action="store_true", help="raw files hold one record per line")
    batch.add_argument("--checkpoint", help="remember which match files have been read here, and read new ones only")

    live = jobs.add_parser("live", help="a stream of score payloads into three collections")
    live.add_argument("--source", required=True, help="format of the stream, such as kafka")
    live.add_argument("--source-option", action="append", default=[], metavar="KEY=VALUE")
    live.add_argument("--teams", help="Parquet of teams to enrich the scores with, by team_name")
    live.add_argument("--checkpoint", required=True)
    live.add_argument("--once", action="store_true", help="stop when all there is has been read")

    for job in (batch, live):
        job.add_argument("--out", help="folder of the results; without, the format is a connector")
        job.add_argument("--format", default="parquet")
        job.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="for the result format")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    # Open windows of a live job may outgrow the heap.
    spark = build(f"touchline {args.job}", **(LARGE_STATE if args.job == "live" else {}))
    sink = {"fmt": args.format, **_options(args.option)}
    if args.job == "daily":
        counts = daily.run_all(
            spark, args.raw, args.silver, args.out, args.report or tuple(REPORTS), not args.lines, args.mode,
            args.max_rejects, args.checkpoint, **sink,
        )
        for name, found in counts.items():
            print(name, *[f"{key}={n}" for key, n in found.items()])
    else:
        payloads = read_stream(spark, args.source, **_options(args.source_option))
        teams = read_teams(spark, args.teams) if args.teams else None
        run_all(payloads, args.checkpoint, teams, root=args.out, available_now=args.once, **sink)


if __name__ == "__main__":
    main()
