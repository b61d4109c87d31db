"""The original programs as runnable Spark jobs: source -> operators -> sink.

Each function wires the library for one of the reference's programs and
starts it (streams) or runs it (batch). Inputs are line sources (a landing
folder of text logs, or Kafka with ``fmt="kafka"`` and its options); tables
are parquet folders or JDBC URLs. Stream checkpoints go under the shared
``spark.checkpoint.dir``.

Command line::

    python -m roadwatch.apps overspeed --opt lines=/landing/* --opt stations=/tables/stations \
        --opt out=/tables/speeding
    python -m roadwatch.apps clone_plates --opt lines=/landing/* --opt out=/tables/violations \
        --opt within_s=10
"""

from __future__ import annotations

import argparse
import ast

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadwatch.functions.columns import DEFAULT_LIMIT
from roadwatch.functions.messages import area_message, danger_message, pair_message, police_message
from roadwatch.operators import listed_cars_only, overspeed_passages, track_rows
from roadwatch.sinks import write_console, write_lines_kafka, write_tracks
from roadwatch.session import STREAM_CONF
from roadwatch.sources.lines import (
    parse_passages, parse_police_actions, parse_violations, read_lines, read_lines_stream,
)
from roadwatch.sources.tables import read_monitors, read_violations
from roadwatch.streaming import jobs
from roadwatch.streaming import sinks as ssinks


def _lines(spark: SparkSession, source: str, fmt: str, options: dict) -> DataFrame:
    if fmt == "kafka":
        return read_lines_stream(spark, "kafka", **options)
    return read_lines_stream(spark, fmt, source, **options)


def _stations_loader(stations: str, fmt: str):
    return lambda s: read_monitors(s, stations, fmt)


def overspeed(spark, lines: str, stations: str, out: str, fmt: str = "text",
              stations_fmt: str = "parquet", factor: float = 1.1, **options):
    """Overspeed monitor: passages over their station's limit -> speeding table.
    The station table is reloaded every micro-batch (A8)."""
    passages = parse_passages(_lines(spark, lines, fmt, options))
    write = ssinks.table_writer("speeding", out)

    def each(batch, dim, epoch):
        write(overspeed_passages(batch, dim, factor), epoch)
    q = jobs.with_refreshed_dim(passages, _stations_loader(stations, stations_fmt), each)
    return q.option("checkpointLocation", _ckpt(spark, "overspeed")).start()


def average_speed(spark, lines: str, out: str, fmt: str = "text", size="5 minutes",
                  slide="1 minute", delay="5 seconds", **options):
    """Average speed per station, sliding window -> average-speed table."""
    passages = parse_passages(_lines(spark, lines, fmt, options))
    return jobs.start(jobs.stream_avg_speed(passages, size, slide, delay), "average_speed",
                      foreach_batch=ssinks.table_writer("average_speed", out))


def top_n(spark, lines: str, fmt: str = "text", n: int = 3, size="5 minutes",
          slide="1 minute", delay="5 seconds", out: str | None = None, **options):
    """Busiest stations per window -> table ``out`` (or, for debugging, the console)."""
    from roadwatch.functions.messages import top_n_message
    passages = parse_passages(_lines(spark, lines, fmt, options))
    avg = jobs.stream_avg_speed(passages, size, slide, delay)

    to_table = ssinks.epoch_writer(out) if out else None

    def sink(top, epoch):
        if to_table:
            to_table(top_n_message(top, n), epoch)
        else:
            write_console(top_n_message(top, n))
    return jobs.start(avg, "top_n", foreach_batch=jobs.top_n_batch_writer(n, sink))


def clone_plates(spark, lines: str, out: str, fmt: str = "text", within_s: int = 10,
                 delay="5 seconds", **options):
    """Clone-plate warning -> violation list, at most once per car and day."""
    passages = parse_passages(_lines(spark, lines, fmt, options))
    warnings = jobs.stream_clone_plates(passages, within_s, delay) \
        .select("car", "msg", F.col("action_time").alias("create_time"))
    return jobs.start(warnings, "clone_plates", foreach_batch=ssinks.violation_writer(out))


def dangerous_driving(spark, lines: str, stations: str, fmt: str = "text",
                      stations_fmt: str = "parquet", within="2 minutes", times: int = 3,
                      default: int = DEFAULT_LIMIT, delay="5 seconds", out: str | None = None,
                      sink: str = "console", **options):
    """Dangerous-driving alerts -> table ``out`` (or, for debugging, the console)."""
    passages = parse_passages(_lines(spark, lines, fmt, options))
    alerts = jobs.stream_dangerous_driving(passages, read_monitors(spark, stations, stations_fmt),
                                           times=times, within=within, default=default,
                                           delay=delay)
    return _alerts(danger_message(alerts), "dangerous_driving", out, sink)


def police_join(spark, violations: str, actions: str, fmt: str = "text", lower="-5 seconds",
                upper="5 seconds", delay="2 seconds", out: str | None = None, sink: str = "console", **options):
    """Violations joined with police actions within an interval -> table ``out`` (or the console)."""
    v = parse_violations(_lines(spark, violations, fmt, options))
    a = parse_police_actions(_lines(spark, actions, fmt, options))
    joined = jobs.stream_interval_join(v, a, lower, upper, delay)
    return _alerts(police_message(joined), "police_join", out, sink)


def police_pairing(spark, violations: str, actions: str, outcomes: dict[str, str] | None = None,
                   fmt: str = "text", timeout="5 seconds", delay="2 seconds", mode: str = "paired",
                   out: str | None = None, **options):
    """Violations paired with police actions; unmatched ones to side tables."""
    # Text records carry no id: ties among equal times use an id derived from each record.
    v = parse_violations(_lines(spark, violations, fmt, options))
    a = parse_police_actions(_lines(spark, actions, fmt, options))
    pairs = jobs.stream_pair_actions(v, a, timeout, delay, mode)
    if outcomes:
        return jobs.start(pairs, "police_pairing", foreach_batch=ssinks.outcome_writer(outcomes))
    return _alerts(pair_message(pairs), "police_pairing", out, "console")


def vehicle_tracks(spark, log: str, violation_list: str, out: str, list_fmt: str = "parquet"):
    """Vehicle tracks (batch): passages of listed violators -> newest-first track table."""
    passages = parse_passages(read_lines(spark, log))
    listed = read_violations(spark, violation_list, list_fmt)
    write_tracks(track_rows(listed_cars_only(passages, listed)), out)


def area_distribution(spark, lines: str, fmt: str = "text", size="10 seconds", delay="5 seconds",
                      time: str = "event", out: str | None = None, sink: str = "console", **options):
    """Exact distinct cars per area and window -> table ``out`` (or the console)."""
    passages = parse_passages(_lines(spark, lines, fmt, options))
    counts = jobs.stream_area_distinct(passages, size, delay, time)
    return _alerts(area_message(counts), "area_distribution", out, sink)


def area_distribution_bloom(spark, lines: str, out: str, fmt: str = "text", size="10 minutes",
                            bits: int = 1 << 22, delay="5 seconds", **options):
    """Running distinct cars per area (Bloom bitmap), every passage -> counter table."""
    passages = parse_passages(_lines(spark, lines, fmt, options))
    running = jobs.stream_area_distinct_bloom(passages, size, bits, delay)
    return jobs.start(running, "area_distribution_bloom",
                      foreach_batch=ssinks.counter_writer(out, value="distinct_cars"))


def feed_kafka(spark, log: str, topic: str, **options):
    """Replay a text log into a Kafka topic (each line one record, null key)."""
    write_lines_kafka(read_lines(spark, log), topic, **options)


def _alerts(df: DataFrame, name: str, out: str | None, sink: str):
    """Every row of the stream into table ``out``; without one, to ``sink`` (debugging)."""
    if out:
        return jobs.start(df, name, foreach_batch=ssinks.epoch_writer(out))
    return jobs.start(df, name, sink=sink)


def _ckpt(spark, name):
    from roadwatch.session import checkpoint_path
    return checkpoint_path(spark, f"app-{name}")


APPS = {
    "overspeed": overspeed, "average_speed": average_speed, "top_n": top_n,
    "clone_plates": clone_plates, "dangerous_driving": dangerous_driving,
    "police_join": police_join, "police_pairing": police_pairing,
    "vehicle_tracks": vehicle_tracks, "area_distribution": area_distribution,
    "area_distribution_bloom": area_distribution_bloom, "feed_kafka": feed_kafka,
}


BATCH_APPS = ("vehicle_tracks", "feed_kafka")


def _value(text: str):
    """``10`` -> 10, ``1.1`` -> 1.1, ``{'matched': '/t'}`` -> dict; anything else stays text."""
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return text


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="roadwatch.apps", description=__doc__.split("\n")[0])
    ap.add_argument("app", choices=sorted(APPS))
    ap.add_argument("--opt", action="append", default=[], metavar="KEY=VALUE",
                    help="argument of the app function (repeatable), e.g. --opt lines=/landing")
    args = ap.parse_args(argv)
    kwargs = {k: _value(v) for k, v in (o.split("=", 1) for o in args.opt)}
    spark = SparkSession.builder.appName(f"roadwatch-{args.app}").getOrCreate()
    if not (spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        # A stream that is started again must find its checkpoint.
        raise SystemExit("set spark.checkpoint.dir to a folder that all executors share")
    for k, v in STREAM_CONF.items():
        if args.app not in BATCH_APPS or k == "spark.sql.session.timeZone":
            spark.conf.set(k, v)
    result = APPS[args.app](spark, **kwargs)
    if result is not None:
        result.awaitTermination()


if __name__ == "__main__":
    main()
