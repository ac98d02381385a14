"""Run a job: ``spark-submit ... -m skylag JOB --argument value ...``.

A job's arguments are those of its function in ``plans/jobs.py``, with dashes for
underscores; ``python -m skylag JOB --help`` lists them. Options of a store are given
as ``--distances-options key=value,key=value``; what a job passes on to a store or to the
forest, such as a database or the number of trees, as ``--options key=value,key=value``.
"""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql.streaming import StreamingQuery

from skylag.plans import jobs
from skylag.session import build_session
from skylag.streaming import sinks

JOBS = {
    name.removeprefix("run_").replace("_", "-"): job
    for name, job in vars(jobs).items()
    if name.startswith("run_")
}


def _options(text: str) -> dict[str, str]:
    return dict(part.split("=", 1) for part in text.split(","))


def _value(text: str) -> str | int | float | bool:
    """A setting as a number or a truth value, where it reads as one."""
    if text.lower() in ("true", "false"):
        return text.lower() == "true"
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def _kind(annotation: str):
    for word, kind in (("dict", _options), ("bool", lambda x: x.lower() == "true"), ("int", int), ("float", float)):
        if word in annotation:
            return kind
    return str


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skylag", description=__doc__)
    names = top.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        one = names.add_parser(name, help=(inspect.getdoc(job) or "").split("\n")[0])
        for argument, about in list(inspect.signature(job).parameters.items())[1:]:
            if about.kind is about.VAR_KEYWORD:
                one.add_argument("--options", type=_options, default={}, dest="passed_on", metavar="KEY=VALUE,...")
                one.set_defaults(numbers="str" not in str(about.annotation))
                continue
            needed = about.default is about.empty
            kind = _kind(str(about.annotation)) if "DataFrame" not in str(about.annotation) else str
            shown = None if needed else about.default
            one.add_argument("--" + argument.replace("_", "-"), type=kind, required=needed, default=shown)
    return top


def main(words: list[str] | None = None) -> None:
    given = vars(parser().parse_args(words))
    job = JOBS[given.pop("job")]
    numbers = given.pop("numbers", False)
    more = given.pop("passed_on", {})
    clash = sorted(given.keys() & more.keys())
    if clash:
        raise SystemExit(f"given twice: {', '.join(clash)}")
    given |= {name: _value(text) if numbers else text for name, text in more.items()}
    spark = build_session("skylag")
    if "forms" in given:  # a job that takes rows: JSON lines of forms
        given["forms"] = spark.read.json(given["forms"])
    made = job(spark, **given)
    queries = list(made.values()) if isinstance(made, dict) else [made]
    if any(isinstance(q, StreamingQuery) for q in queries):
        if given.get("trigger") == "available":
            sinks.drain(*queries)
        else:
            sinks.run(spark)
    elif made is not None:
        print(made)


if __name__ == "__main__":
    main()
