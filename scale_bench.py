"""Throughput on table logs of growing size, a third of the rows in one partition.

The events log is repeated COPIES times with shifted offsets and kept as a table
log, with three mirrors and a target beside it. Prints one JSON line per size:
seconds and messages per second of each operation, whole results written to the
no-op sink (or to a table, where writing is the operation).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsync.operators import (
    assign_target_offsets,
    gap_report,
    high_watermarks,
    merge_mirrors,
    number_rows,
    reconcile,
    to_message,
)
from logsync.plans import outstanding_messages, relay_bounded
from logsync.schemas import LOG_COLUMNS
from logsync.session import local_session, run_folder
from logsync.sinks import TableTarget, write_log
from logsync.sources import TableLog, read_log, read_mirrors
from logsync.streaming import relay_until_end
from workload import views


def skewed_log(spark: SparkSession, sf_dir: str, copies: int) -> DataFrame:
    """The events log, repeated; partition 0 of 8 holds a third and more."""
    log = views.event_log(spark, sf_dir, with_id=True).withColumn(
        "partition", F.expr("if(event_id % 3 = 0, 0, cast(event_id % 8 as int))")
    )
    once = number_rows(log.drop("offset"), ["topic", "partition"], "event_id", "offset")
    sizes = once.groupBy("partition").agg(F.count(F.lit(1)).alias("n"))
    return (
        once.join(F.broadcast(sizes), "partition")  # eight rows
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        .withColumn("offset", F.col("offset") + F.col("copy") * F.col("n"))
        .select(*LOG_COLUMNS)
    )


def share(log: DataFrame, percent: int) -> DataFrame:
    ends = F.broadcast(high_watermarks(log))  # eight rows
    return (
        log.join(ends, ["topic", "partition"])
        .where(F.col("offset") * 100 < F.col("next_offset") * percent)
        .select(*LOG_COLUMNS)
    )


def measure(spark: SparkSession, sf_dir: str, copies: int) -> dict:
    folder = run_folder(spark, f"scale-{copies}")
    source = TableLog(f"{folder}/source")
    source.append(skewed_log(spark, sf_dir, copies))
    topics = [views.TOPIC]
    log = read_log(spark, source, topics)
    nodes = []
    for i, percent in enumerate(views.NODE_SHARES):
        node = source if percent == 100 else TableLog(f"{folder}/node{i}")
        if node is not source:
            node.append(share(log, percent))
        nodes.append(node)
    routes = views.copy_routes(spark)
    target = TableTarget(f"{folder}/target")
    write_log(to_message(share(log, views.TARGET_SHARE), routes), target)
    rows = log.count()

    def drain(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    def stream() -> None:
        relay_until_end(
            spark, source, routes, TableTarget(run_folder(spark, "scale-stream")),
            run_folder(spark, "scale-checkpoint"), filters=views.filters(),
        ).awaitTermination()

    operations = {
        "resume_filter_route_stamp": lambda: drain(
            outstanding_messages(log, target.high_watermarks(spark), routes, views.filters())
        ),
        "full_filter_route_stamp": lambda: drain(
            to_message(log, routes)
        ),
        "end_offsets": lambda: source.end_offsets(spark, topics).collect(),
        "gap_report": lambda: drain(gap_report(log)),
        "merge_mirrors": lambda: drain(merge_mirrors(read_mirrors(spark, nodes, topics))),
        "reconcile": lambda: drain(reconcile(log, target.read(spark))),
        "target_numbering": lambda: drain(assign_target_offsets(to_message(log, routes))),
        "bounded_copy_to_table": lambda: relay_bounded(
            spark, source, routes, TableTarget(run_folder(spark, "scale-copy"))
        ),
        "bounded_stream_to_table": stream,
    }
    seconds = {}
    for name, operation in operations.items():
        samples = []
        for _ in range(2 if copies < 100 else 1):
            began = time.perf_counter()
            operation()
            samples.append(time.perf_counter() - began)
        seconds[name] = round(min(samples), 2)
        print(copies, name, seconds[name], file=sys.stderr, flush=True)
    return {
        "messages": rows,
        "seconds": seconds,
        "messages_per_second": {name: int(rows / s) for name, s in seconds.items()},
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    spark = local_session(cores, "scale-bench")
    spark.conf.set("spark.sql.shuffle.partitions", str(3 * int(cores)))
    for copies in (int(c) for c in os.environ.get("COPIES", "1,10,100").split(",")):
        print(json.dumps({"cores": cores, "copies": copies, **measure(spark, sf_dir, copies)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
