"""Print the formatted physical plans of the headline operators.

usage: python tools/explain_plans.py [sf_dir]
Builds a silver table under the session's checkpoint folder, then explains
the pruned per-month query, the one-pass audit, the gold mart, the latest
status summary and the bucketed window join.
"""

import sys

sys.path.insert(0, ".")

from pyspark.sql import functions as F  # noqa: E402

from tollgate.operators import evidence, marts, quality  # noqa: E402
from tollgate.plans.datasets import silver, silver_all  # noqa: E402
from tollgate.session import build_session, work_path  # noqa: E402
from tollgate.sources import adapters, tables  # noqa: E402


def show(title, df):
    print(f"\n===== {title}")
    df.explain("formatted")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", "explain", shuffle_partitions=16)
    path = work_path(spark, "explain-silver")
    tables.overwrite_partitions(silver(spark, sf, "yellow"), path, ["year", "month"], order=["pickup_ts"])
    part = tables.read_partition(spark, path, [(1996, 1)])
    show("A5 partition financial aggregate (pruned scan, 3 columns)", marts.financial_aggregate(part, by=[]))
    show("silver write clustering (rebalance)", tables.clustered_for_write(silver(spark, sf, "yellow"), ["year", "month"]))
    show("V1-V6 one-pass audit", quality.audit(tables.read_table(spark, path), "yellow"))
    show("A4 gold over both datasets", marts.monthly_revenue(silver_all(spark, sf)))
    rm = adapters.run_metrics(spark, sf)
    audit = quality.audit(tables.read_table(spark, path), "yellow", context={"dag_run_id": "d"})
    show("W1 latest status (max_by, no window)", marts.latest_status_summary(audit))
    show("J15 bucketed window join", evidence.points_in_windows(
        adapters.request_points(spark, sf), adapters.request_windows(rm)))
    spark.stop()


if __name__ == "__main__":
    main()
