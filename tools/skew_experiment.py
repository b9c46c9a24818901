"""Hot-entity experiment: plain entity window vs. time-sliced ordered scan.

    python tools/skew_experiment.py [--rows 20000000] [--cores 8]

Generates ``rows`` synthetic events (one entity holds a third of them, the
rest spread over 100,000 entities, 30 days), computes the previous event
time per entity both ways through the ``noop`` sink; then anti-joins the
points of one hot entity against its exposure intervals keyed by the entity
alone and by (entity, time bucket). Reports wall time and the longest task
from Spark's event log (written to a fresh scratch folder). This is a
measurement tool, not a registered query.
"""

from __future__ import annotations

import argparse
import collections
import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def task_times(log_dir: str) -> dict:
    import zstandard
    stage_group, tasks = {}, collections.defaultdict(list)
    for fn in sorted(glob.glob(os.path.join(log_dir, "*", "events*"))):
        raw = open(fn, "rb").read()
        text = (zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
                if fn.endswith(".zstd") else raw.decode())
        for line in text.splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for s in e["Stage Infos"]:
                    stage_group[s["Stage ID"]] = g
            elif e["Event"] == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks[stage_group.get(e["Stage ID"])].append(ti["Finish Time"] - ti["Launch Time"])
    return {g: {"tasks": len(d), "max_task_ms": max(d), "median_task_ms": sorted(d)[len(d) // 2]}
            for g, d in tasks.items() if g}


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--rows", type=int, default=20_000_000)
    ap.add_argument("--cores", default="8")
    ap.add_argument("--hot-points", type=int, default=100_000)
    ap.add_argument("--hot-intervals", type=int, default=5_000)
    a = ap.parse_args()
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from cohortkit.operators import ordered
    from cohortkit.session import get_session

    log_dir = tempfile.mkdtemp(prefix="skew-run-")
    spark = get_session("skew-experiment", cores=a.cores, shuffle_partitions=64,
                        extra={"spark.eventLog.enabled": "true",
                               "spark.eventLog.dir": f"file://{log_dir}"})
    sc = spark.sparkContext
    df = spark.range(a.rows).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(1 + F.col("id") % 100000).alias("e"),
        (F.lit(1704067200) + F.abs(F.hash("id") % (30 * 86400)).cast("long"))
        .cast("timestamp").cast("timestamp_ntz").alias("t"))
    wall = {}

    def run(name, d):
        sc.setJobGroup(name, name)
        t0 = time.time()
        d.write.format("noop").mode("overwrite").save()
        wall[name] = round(time.time() - t0, 1)

    w = Window.partitionBy("e").orderBy("t", "id")
    run("plain_window", df.select("*", F.lag("t").over(w).alias("prev_t")))
    run("sliced", ordered.with_neighbors(df, "e", "t", "id", ["t"], prev=True, slice_hours=24))

    # range join: points of one hot entity (30 days) vs. its 2 h exposure
    # intervals (+6 h/-3 h) in the first 2 days: most points match nothing and
    # an entity-keyed join must test each of them against every interval
    from cohortkit.operators import bands
    from cohortkit.functions.timecalc import shift
    pts = spark.range(a.hot_points).select(
        F.lit(0).cast("long").alias("e"), F.col("id").alias("pid"),
        (F.lit(1704067200) + F.abs(F.hash("id") % (30 * 86400)).cast("long"))
        .cast("timestamp").cast("timestamp_ntz").alias("t"))
    ivs = spark.range(a.hot_intervals).select(
        F.lit(0).cast("long").alias("e"),
        (F.lit(1704067200) + F.abs(F.hash("id", F.lit(7)) % (2 * 86400)).cast("long"))
        .cast("timestamp").cast("timestamp_ntz").alias("s")).withColumn("x", shift("s", 2))
    lo, hi = shift("s", -6), shift("x", 3)
    plain = pts.join(ivs, (pts.e == ivs.e) & pts.t.between(lo, hi), "left_anti")
    run("anti_join_entity_key", plain)
    run("anti_join_entity_bucket_key",
        bands.interval_join(pts, ivs, "e", "t", lo, hi, how="left_anti", bucket_hours=12))

    # cohort x facts: the nearest value to a landmark per entity, where one
    # entity holds a third of the facts; entity-keyed join + aggregate vs.
    # the (entity, bucket)-keyed cohort window join of extract_features
    from cohortkit.operators import features
    facts = df.select(F.col("e").alias("person_id"), F.col("t").alias("measurement_datetime"),
                      F.lit("a").alias("measurement_concept_id"),
                      (F.col("id") % 100).cast("double").alias("value_as_number"),
                      F.col("id").alias("measurement_id"))
    cohort = spark.range(100001).select(
        F.col("id").alias("person_id"),
        (F.lit(1704067200) + F.abs(F.hash("id", F.lit(3)) % (30 * 86400)).cast("long"))
        .cast("timestamp").cast("timestamp_ntz").alias("lm"))
    spec = features.FeatureSpec("f", ("a",), 12, 12)
    j = facts.join(cohort, "person_id").filter(
        F.col("measurement_datetime").between(shift("lm", -12), shift("lm", 12)))
    best = F.min(F.struct(F.abs(F.timestamp_diff("SECOND", F.col("measurement_datetime"),
                                                 F.col("lm"))).alias("s"),
                          F.col("measurement_datetime").alias("t"),
                          F.col("measurement_id").alias("i"), F.col("value_as_number").alias("v")))
    nearest_plain = j.groupBy("person_id").agg(best.alias("b"))
    nearest_bucket = features.extract_features(cohort, facts, [spec], {"x": "lm"},
                                               tiebreak="measurement_id",
                                               unit="unit_source_value")
    run("nearest_entity_key", nearest_plain)
    run("nearest_entity_bucket_key", nearest_bucket)
    # a cohort too large to broadcast (millions of patients at scale)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    run("nearest_entity_key_no_broadcast", nearest_plain)
    run("nearest_entity_bucket_key_no_broadcast", nearest_bucket)
    spark.stop()
    tasks = task_times(log_dir)
    print(json.dumps({k: {"wall_sec": wall[k], **tasks.get(k, {})} for k in wall}))


if __name__ == "__main__":
    main()
