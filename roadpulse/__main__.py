"""``spark-submit -m``-style entry: ``python -m roadpulse JOB [ARGUMENTS]``."""

from __future__ import annotations

import argparse

from roadpulse.plans import jobs
from roadpulse.session import build_session

# job: (function, its arguments)
JOBS = {
    "copy-lines": (jobs.copy_lines, ("source", "out")),
    "filter-sensor": (jobs.filter_sensor, ("source", "out")),
    "fan-out-sensor": (jobs.fan_out_sensor, ("source", "out")),
    "reduce-sensor": (jobs.reduce_sensor, ("source", "out")),
    "rolling-sensor": (jobs.rolling_sensor, ("source", "out?")),
    "sliding-sensor": (jobs.sliding_sensor, ("source", "out")),
    "radar": (jobs.radar, ("source", "out")),
    "average-speed": (jobs.average_speed, ("source", "out")),
    "accidents": (jobs.find_accidents, ("source", "out")),
    "telematics": (jobs.full("telematics"), ("source", "out")),
    "telematics-opt": (jobs.full("opt"), ("source", "out")),
    "telematics-compact": (jobs.full("compact"), ("source", "out")),
    "word-count": (jobs.count_words, ("source?", "out?")),
    "socket-word-count": (jobs.count_words_of_socket, ("host", "port")),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="roadpulse", description=__doc__)
    commands = top.add_subparsers(dest="job", required=True)
    for name, (run, arguments) in JOBS.items():
        command = commands.add_parser(name, help=run.__doc__)
        for argument in arguments:
            optional = argument.endswith("?")
            command.add_argument(argument.rstrip("?"), nargs="?" if optional else None)
        if name.startswith("telematics"):
            command.add_argument("--single-file", action="store_true")
    return top


def main(argv: list[str] | None = None) -> None:
    options = vars(parser().parse_args(argv))
    run, _ = JOBS[options.pop("job")]
    query = run(build_session(), **options)
    if query is not None:
        query.awaitTermination()


if __name__ == "__main__":
    main()
