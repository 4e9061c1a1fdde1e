"""Jobs that run while a query is built: each is a round trip that a cluster waits for."""

import pytest

from shelfwise.plans import catalog

#: At most so many, with the six that every query needs for its tables and its date.
MOST = {"I6_rfm_customers": 20, "D20_dynamic_percentiles": 20, "D21_last_week_sales": 15, "D11_sales_kpi": 8}


@pytest.mark.parametrize("name", MOST)
def test_jobs_at_build(spark, data, name):
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{name}", name)
    try:
        catalog.queries()[name](spark, data)
        jobs = len(sc.statusTracker().getJobIdsForGroup(f"build-{name}"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    print(name, jobs)
    assert 0 < jobs <= MOST[name]
