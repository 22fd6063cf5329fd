"""Benchmark the headline audits; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_LOOP=0 to skip the per-item loop comparisons, BENCH_LOOP_Q27=0 to skip the loop over q27 alone.

Setup (not timed): the derived copies are written once as partitioned ORC /
Avro datasets under the shared checkpoint folder. Timed, each run twice
(``queries`` holds the warm run, ``cold`` the first):

* two_way_audit / three_way_audit: the path-based audits over those copies
  (listing + record counts of every copy, alignment, verdicts), collected;
* q12 / q14 / q16 / q17 / q27: the registered queries, collected (q12 and q14 write their copies in the first, cold run);
* two_way_rerun: the two-way audit with a folder of earlier counts, nothing changed since;
* wide_two_way_audit: eight tables (16 copies) in one audit, to show the cost
  per item falling as tables are added (one scan job whatever their number);
* nightly_audit: one date across 64 tables (the nightly case), which lists only
  that date's directories, compared with the per-item loop on the same items
  (loop_nightly);
* big_copy_audit: two tables of many records each (lineitem five times over, one
  date), where the cost per record shows; big_copy_counts is the plain count of
  the same four folders;
* loop_two_way: the same two-way counts done the way the original jobs do
  them, one count job per copy per item on the driver, for comparison; loop_q27
  does so for q27, one count job per table, copy and partition.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from copyaudit.session import build_session  # noqa: E402


# One business date across many tables, as a nightly run audits it.
NIGHTLY_DATE = "1995-03"
NIGHTLY_TABLES = 64
BIG_COPIES = 5


def timed(fn):
    t0 = time.time()
    fn()
    return round(time.time() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    do_loop = os.environ.get("BENCH_LOOP", "1") != "0"
    spark = build_session(f"local[{cpus}]", app_name="copyaudit-bench", shuffle_partitions=int(cpus),
                          extra={"spark.ui.showConsoleProgress": "false",
                                 "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    from pyspark.sql import functions as F

    from copyaudit.plans import catalog, physical, recipes
    from copyaudit.plans.audits import audit_three_way, audit_two_way

    # setup: physical copies (not timed)
    two_tables = [recipes.ORDERS, recipes.EVENTS]
    three_tables = [recipes.ORDERS, recipes.LINEITEM, recipes.EVENTS]
    two_parts = recipes.work_items(spark, sf_dir, two_tables).checkpoint(eager=True)
    three_parts = recipes.work_items(spark, sf_dir, three_tables).checkpoint(eager=True)
    two_layout = physical.two_way_layout(spark, "bench-two", catalog.two_way_params())
    three_layout = physical.three_way_layout(spark, "bench-three", catalog.three_way_params())
    physical.write_copies(spark, sf_dir, two_layout, two_parts, two_tables)
    physical.write_copies(spark, sf_dir, three_layout, three_parts, three_tables)

    # many tables: the same orders copies under eight table names (16 copies)
    from copyaudit.operators.worklist import copy_locations, two_way_work_list
    wide_names = [f"orders_{i:02d}" for i in range(8)]
    wide_layout = physical.two_way_layout(
        spark, "bench-wide", catalog.two_way_params(tables=",".join(wide_names), databases="sri_open"))
    wide_parts = recipes.work_items(spark, sf_dir, [recipes.ORDERS]).select(
        "db", F.explode(F.array(*[F.lit(n) for n in wide_names])).alias("table"), "partition_date"
    ).checkpoint(eager=True)
    wide_work = two_way_work_list(spark, wide_layout.two_way, wide_parts)
    for loc in copy_locations(wide_work.tables, ["source", "target"]):
        recipes.copy_rows(spark, sf_dir, recipes.ORDERS, loc.role).write.mode("overwrite") \
            .partitionBy(recipes.ORDERS.partition_col).orc(loc.root)

    # nightly: one date across many tables (each copy holds that date's partition)
    nightly_names = [f"n{i:03d}" for i in range(NIGHTLY_TABLES)]
    nightly_layout = physical.two_way_layout(
        spark, "bench-nightly", catalog.two_way_params(tables=",".join(nightly_names), databases="sri_open"))
    nightly_work = two_way_work_list(spark, nightly_layout.two_way, [NIGHTLY_DATE])
    month = recipes.ORDERS.partition()
    for role in ("source", "target"):
        day_rows = recipes.copy_rows(spark, sf_dir, recipes.ORDERS, role).where(month == NIGHTLY_DATE) \
            .checkpoint(eager=True)
        for loc in copy_locations(nightly_work.tables, [role]):
            day_rows.write.mode("overwrite").partitionBy(recipes.ORDERS.partition_col).orc(loc.root)

    # big: few files' worth of planning, many records
    big_layout = physical.two_way_layout(
        spark, "bench-big", catalog.two_way_params(tables="big1,big2", databases="sri_open"))
    big_work = two_way_work_list(spark, big_layout.two_way, [NIGHTLY_DATE])
    lineitem = recipes.base_table(spark, sf_dir, "lineitem") \
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(BIG_COPIES)))).withColumn("ods", F.lit(NIGHTLY_DATE))
    big_dirs = []
    for loc in copy_locations(big_work.tables, ["source", "target"]):
        lineitem.repartition(int(cpus)).write.mode("overwrite").partitionBy("ods").orc(loc.root)
        big_dirs.append(f"{loc.root}/ods={NIGHTLY_DATE}")

    runs = {
        "two_way_audit": lambda: audit_two_way(spark, two_layout.two_way, two_parts).results.collect(),
        "three_way_audit": lambda: audit_three_way(spark, three_layout.three_way, three_parts).results.collect(),
        "two_way_rerun": lambda: audit_two_way(spark, two_layout.two_way, two_parts,
                                               counted=f"{two_layout.base}/counts").results.collect(),
        "q12_two_way_verdict": lambda: catalog.q12_two_way_verdict(spark, sf_dir).collect(),
        "q14_three_way_verdict": lambda: catalog.q14_three_way_verdict(spark, sf_dir).collect(),
        "q16_two_way_result": lambda: catalog.q16_two_way_result(spark, sf_dir).collect(),
        "q17_three_way_result": lambda: catalog.q17_three_way_result(spark, sf_dir).collect(),
        "q27_multi_table_audit": lambda: catalog.q27_multi_table_audit(spark, sf_dir).collect(),
        "wide_two_way_audit": lambda: audit_two_way(spark, wide_layout.two_way, wide_parts).results.collect(),
        "big_copy_audit": lambda: audit_two_way(spark, big_layout.two_way, [NIGHTLY_DATE]).results.collect(),
        "big_copy_counts": lambda: [spark.read.orc(d).count() for d in big_dirs],
        "nightly_audit": lambda: audit_two_way(spark, nightly_layout.two_way, [NIGHTLY_DATE]).results.collect(),
    }
    cold, warm = {}, {}
    for name, fn in runs.items():
        cold[name] = timed(fn)
        warm[name] = timed(fn)

    extra = {"wide_items": wide_parts.count(), "two_way_items": two_parts.count()}
    if do_loop:
        # the original jobs' shape: per item, one count job per copy, sequential
        items = audit_two_way(spark, two_layout.two_way, two_parts).work.items \
            .select("source_path", "target_path").collect()

        def loop():
            for row in items:
                for path in (row["source_path"], row["target_path"]):
                    try:
                        spark.read.format("orc").load(path).count()
                    except Exception:  # noqa: BLE001 - a missing copy is skipped, as in the original
                        pass
        extra["loop_two_way"] = timed(loop)
        extra["loop_items"] = len(items)
        extra["speedup_vs_loop"] = round(extra["loop_two_way"] / max(warm["two_way_audit"], 1e-9), 1)
        items = nightly_work.items.select("source_path", "target_path").collect()
        extra["loop_nightly"] = timed(loop)
        extra["speedup_nightly_vs_loop"] = round(extra["loop_nightly"] / max(warm["nightly_audit"], 1e-9), 1)
        extra["nightly_items"] = len(items)

        def loop_q27():
            for recipe in three_tables:
                values = [r[0] for r in recipes.source_partitions(spark, sf_dir, [recipe])
                          .select("partition_date").collect()]
                base = recipes.base_table(spark, sf_dir, recipe.name).withColumn("pd", recipe.partition())
                for weight in recipe.weights.values():
                    weighted = base.withColumn("w", weight())
                    for value in values:
                        weighted.where(F.col("pd") == value).agg(F.sum("w")).collect()
        if os.environ.get("BENCH_LOOP_Q27", "1") != "0":       # several hundred jobs
            extra["loop_q27"] = timed(loop_q27)
            extra["speedup_q27_vs_loop"] = round(extra["loop_q27"] / max(warm["q27_multi_table_audit"], 1e-9), 1)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "audit_total_warm",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        **extra,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
