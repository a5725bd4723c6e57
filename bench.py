"""Time the headline queries: ``BENCH_SF_DIR=... BENCH_CPUS=... python bench.py [--all]``.

Every query runs in full into a sink that drops its rows. Each is run twice in
the same session: ``cold`` includes planning and code generation for the first
time, ``queries`` is the second run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.plans.catalog import QUERIES  # noqa: E402
from millrace.session import get_spark  # noqa: E402

HEADLINE = """
src_06_flatten_json snk_03_upsert snk_04_insert_new prj_09_search prj_17_melt_split
jn_01_enrich jn_03_header_detail jn_05_tiered_join jn_06_contains_join jn_08_densify
ag_01_group_mean ag_02_group_sum ag_06_five_number ag_11_grouping_sets ag_12_crosstab ag_18_describe_categorical
wn_01_flag_top wn_02_top_n_per_group wn_03_pareto wn_04_drop_duplicates st_02_top_k
sx_01_describe_numeric sx_03_advanced_stats sx_05_sample_moments sx_06_quantiles_select sx_07_corr_matrix sx_09_welch_t sx_10_chi2 sx_11_histogram sx_14_box_stats sx_15_kde sx_17_profile
tx_01_tfidf_sum tx_02_tfidf_mean tx_04_tfidf_by_group tx_07_extract_page rl_02_tag_summary rl_03_bridge rl_07_recommend rl_09_basket_alerts rl_12_cartogram
fn_02_funnel_cumulative qc_02_mart_area_hours stm_03_daily_counts
""".split()


def run(spark, folder: str, key: str) -> float:
    start = time.perf_counter()
    QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = list(QUERIES) if "--all" in sys.argv else HEADLINE
    spark = get_spark("bench", cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    run(spark, folder, "st_02_top_k")
    cold = {k: round(run(spark, folder, k), 3) for k in keys}
    warm = {k: round(run(spark, folder, k), 3) for k in keys}
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
