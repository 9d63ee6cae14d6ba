"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of the test tables, BENCH_CPUS the cores, BENCH_ONLY some queries (by
default all run). Each query is run once to warm
up and then BENCH_RUNS times, of which the median counts; the result is written to the ``noop`` sink,
so all of it is computed and none of it is collected. With BENCH_LITERAL=1 the plain forms of detection
(one scan per side and rule) and replay (each swap copied into every window) are timed too, to compare.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from podwatch.checks import fixtures as fx  # noqa: E402
from podwatch.checks.job_queries import QUERIES as JOB_QUERIES  # noqa: E402
from podwatch.checks.queries import QUERIES  # noqa: E402
from podwatch.functions.timing import after_minutes_ago  # noqa: E402
from podwatch.operators import detect  # noqa: E402
from podwatch.rules import RULES  # noqa: E402
from podwatch.session import build_session  # noqa: E402


def literal_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    swaps = fx.swaps(spark, sf_dir)
    recent = detect.recent_tokens(swaps, fx.AS_OF)
    found = None
    for rule in RULES:
        inside = swaps.where(after_minutes_ago(swaps, fx.AS_OF, rule.length_minutes)).where("source <> 'PUMP_FUN'")
        sides = None
        for side, token in (("buy", "swaptotoken"), ("sell", "swapfromtoken")):
            users = inside.groupBy(F.col(token).alias("token_address")).agg(F.count_distinct("user_address").alias("users"))
            users = users.join(recent, "token_address", "left_semi").withColumn("side", F.lit(side))
            sides = users if sides is None else sides.unionByName(users)
        counts = sides.groupBy("token_address").agg(
            *(F.sum(F.when(F.col("side") == s, F.col("users")).otherwise(0)).alias(s) for s in ("buy", "sell"))
        )
        counts = counts.where((F.col("buy") > rule.threshold) | (F.col("sell") > rule.threshold))
        counts = counts.withColumn("time_interval", F.lit(rule.label))
        found = counts if found is None else found.unionByName(counts)
    last = detect.last_alerts(fx.alert_log(spark, sf_dir)).withColumnRenamed("address", "token_address")
    return found.join(last, ["token_address", "time_interval"], "left")


def literal_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    legs = detect.swap_legs(fx.swaps(spark, sf_dir))
    before = F.col("timestamp") - F.expr("INTERVAL '0.000001' SECOND")
    gate = legs.select("token", F.window(before, "10 minutes", "5 minutes")["end"].alias("tick")).distinct()
    found = None
    for rule in RULES:
        polls = F.window(before, f"{rule.length_minutes} minutes", "5 minutes")["end"].alias("tick")
        users = [
            F.count_distinct(F.when(F.col("side") == s, F.col("user_address"))).alias(s) for s in ("buy", "sell")
        ]
        counts = legs.where("counted").select("token", "side", "user_address", polls).groupBy("token", "tick").agg(*users)
        counts = counts.where((F.col("buy") > rule.threshold) | (F.col("sell") > rule.threshold))
        counts = counts.join(gate, ["token", "tick"], "left_semi").withColumn("time_interval", F.lit(rule.label))
        found = counts if found is None else found.unionByName(counts)
    return found


LITERAL = {"D4_literal": literal_detection, "R1_literal": literal_replay}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "podwatch-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__driver__bindAddress="127.0.0.1",
        spark__driver__host="127.0.0.1",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    # Queries that run whole jobs write tables of their own each time; BENCH_ONLY can name them.
    single = {k: v for k, v in QUERIES.items() if k not in JOB_QUERIES or k in os.environ.get("BENCH_ONLY", "").split(",")}
    chosen = {**single, **(LITERAL if os.environ.get("BENCH_LITERAL") == "1" else {})}
    only = os.environ.get("BENCH_ONLY", "").split(",")
    for name, query in chosen.items():
        if only != [""] and name not in only:
            continue
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
