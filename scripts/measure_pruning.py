"""What pruning saves: rows shuffled and read, with and without it, from Spark's event log.

    python scripts/measure_pruning.py [/root/testdata/sf0.1]

Three measurements on tables derived from the supplied ones: the k largest grouped sums of 20
million skewed rows (plain and with the sketch), Q4's child rows that enter the first shuffle
(plain and with the parents' bitmap), and the rows that Q2 and Q5 read from converted tables
(dealt round-robin and clustered). Prints one JSON line each.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from qalens.operators import top_by_rollup  # noqa: E402
from qalens.plans import analyses as A  # noqa: E402
from qalens.plans import site_standins as S  # noqa: E402
from qalens.session import get_session  # noqa: E402
from qalens.sources.sinks import stored, write_parquet  # noqa: E402
from qalens.sources.supplied import read_supplied  # noqa: E402
from qalens.sources.tables import CLUSTER_BY  # noqa: E402

COPIES, HEAVY_KEYS, FILES = 34, 500, 8


def skewed_rows(spark, d):
    """About 20 million rows: 30 % on 500 keys, the rest on some 5 million."""
    lines = read_supplied(spark, d, "lineitem").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
    spot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "copy"), F.lit(1000))
    heavy = F.floor(F.pow(spot / 300, 3) * HEAVY_KEYS)
    key = F.when(spot < 300, heavy).otherwise(F.col("l_orderkey") * COPIES + F.col("copy") + HEAVY_KEYS)
    return lines.select(key.cast("bigint").alias("key"), F.col("l_quantity").cast("bigint").alias("measure"))


def metrics(log_dir):
    """Shuffle rows and bytes written, and input rows read, per job group; and the shuffle rows
    of each group's stages, in order."""
    group_of, out, stages = {}, defaultdict(lambda: defaultdict(int)), defaultdict(lambda: defaultdict(int))
    for path in glob.glob(f"{log_dir}/**/events_*", recursive=True) + glob.glob(f"{log_dir}/local-*"):
        with open(path, encoding="utf-8") as log:
            for event in map(json.loads, log):
                if event["Event"] == "SparkListenerJobStart":
                    group = (event.get("Properties") or {}).get("spark.jobGroup.id")
                    for s in event["Stage IDs"]:
                        group_of.setdefault(s, group)
                elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                    group, m = group_of.get(event["Stage ID"]), event["Task Metrics"]
                    written = m["Shuffle Write Metrics"]
                    out[group]["shuffle_rows"] += written["Shuffle Records Written"]
                    out[group]["shuffle_bytes"] += written["Shuffle Bytes Written"]
                    out[group]["rows_read"] += m["Input Metrics"]["Records Read"]
                    stages[group][event["Stage ID"]] += written["Shuffle Records Written"]
    return out, {g: [n for _, n in sorted(s.items()) if n] for g, s in stages.items()}


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="qalens-pruning-events-")
    conf = {"spark.driver.memory": "12g", "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false"}
    spark = get_session("local[8]", shuffle_partitions=16, conf=conf)
    seconds, results = {}, {}

    def run(name, make):
        spark.sparkContext.setJobGroup(name, name)
        started = time.perf_counter()
        results[name] = [tuple(r) for r in make().collect()]
        seconds[name] = round(time.perf_counter() - started, 2)
        spark.sparkContext.setJobGroup("other", "")

    fact = stored(skewed_rows(spark, d).repartition(32), "skewed")
    dim = fact.select("key").distinct().select("key", F.concat(F.lit("n"), "key").alias("name"))
    dim = stored(dim, "skewed-keys")
    for prune in (False, True):
        run(f"top10 pruned={prune}", lambda: top_by_rollup(dim, fact, dim_key="key", fact_key="key", measure="measure", dim_cols=["name"], prune=prune))
    comments, posts, users = (stored(f(spark, d), "site") for f in (S.site_comments, S.site_posts_from_orders, S.site_users))
    for reduce in (False, True):
        run(f"q4 reduced={reduce}", lambda: A.top_questions_by_comment_score(comments, posts, users, reduce=reduce))
    votes = stored(S.site_dated_votes(spark, d), "site")
    for clustered in (False, True):
        kept = {}
        for name, df in (("Posts", posts), ("Votes", votes)):
            path = f"{tempfile.mkdtemp(prefix='qalens-clustered-')}/{name}"
            write_parquet(df, path, files=FILES, cluster_by=CLUSTER_BY[name] if clustered else ())
            kept[name] = spark.read.schema(df.schema).parquet(path)
        run(f"q2 clustered={clustered}", lambda: A.top_question_owners(users, kept["Posts"]))
        run(f"q5 clustered={clustered}", lambda: A.top_posts_by_covid_votes(kept["Posts"], kept["Votes"]))
    rows = {"skewed rows": fact.count(), "skewed keys": dim.count()}
    spark.stop()
    totals, stages = metrics(log_dir)
    print(json.dumps(rows))
    for name, s in seconds.items():
        twin = name.replace("True", "False")
        print(json.dumps({"run": name, "seconds": s, **totals[name], "shuffle_rows_by_stage": stages.get(name, []), "same_rows": results[name] == results[twin]}))


if __name__ == "__main__":
    main()
