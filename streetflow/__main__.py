"""Command line: ``python -m streetflow speed ...`` / ``python -m streetflow batch ...``."""

from __future__ import annotations

import argparse

from streetflow.session import build_session


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(p.split("=", 1) for p in pairs)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="streetflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sp = sub.add_parser("speed", help="messages -> lake + realtime keyed table")
    sp.add_argument("--format", default="kafka", help="kafka, text, json, parquet ...")
    sp.add_argument("--path", help="landing folder for file formats")
    sp.add_argument("--option", action="append", default=[], help="source option key=value")
    sp.add_argument("--lake", required=True)
    sp.add_argument("--realtime", required=True)
    sp.add_argument("--checkpoints", required=True)
    sp.add_argument("--available-now", action="store_true")
    bp = sub.add_parser("batch", help="one batch cycle over the lake")
    bp.add_argument("--lake", required=True)
    bp.add_argument("--mapping", required=True)
    bp.add_argument("--daily", required=True)
    bp.add_argument("--as-of", required=True)
    bp.add_argument("--cycle", type=int, required=True)
    bp.add_argument("--checkpoints", required=True, help="folder that remembers which lake files earlier cycles have read")
    args = ap.parse_args(argv)

    spark = build_session("streetflow-" + args.cmd)
    if args.cmd == "speed":
        from streetflow.jobs import run_speed_layer
        from streetflow.streaming.jobs import kafka_source

        options = _options(args.option)
        if args.format == "kafka":
            servers, topic = options.pop("kafka.bootstrap.servers"), options.pop("subscribe")
            messages = kafka_source(spark, servers, topic, **options)
        else:
            r = spark.readStream.format(args.format).options(**options)
            messages = r.load(args.path) if args.path else r.load()
        run_speed_layer(messages, args.lake, args.realtime, args.checkpoints, args.available_now)
    else:
        from streetflow.jobs import batch_cycle

        batch_cycle(spark, args.lake, args.mapping, args.daily, args.as_of, args.cycle, args.checkpoints)


if __name__ == "__main__":
    main()
