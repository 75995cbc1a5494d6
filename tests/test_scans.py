"""Every analysis reads the deals once (from the event log of a session of
its own, so that jobs run while a plan is built count as well)."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from collections import defaultdict

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
RUN = """
import sys
from salescope.plans.session import build_session
from salescope.registry import QUERIES
logs, shared = sys.argv[1:]
spark = build_session("local[4]", 4, extra={
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + logs, "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false", "spark.checkpoint.dir": "file://" + shared,
    "spark.sql.maxMetadataStringLength": "2000"})
for name, query in QUERIES.items():
    spark.sparkContext.setJobDescription(name)
    query(spark, "%s").write.format("noop").mode("overwrite").save()
spark.stop()
""" % SF


def _scans(node: dict, table: str) -> set[int]:
    """Scans of ``table`` below ``node``, named by a metric: a scan that is
    reused or cached shows up again under the same one."""
    out = set()
    if node["nodeName"].startswith("Scan") and f"/{table}.parquet" in node["metadata"].get("Location", ""):
        out.add(min(m["accumulatorId"] for m in node["metrics"]))
    return out.union(*(_scans(child, table) for child in node["children"]))


def test_every_query_scans_the_deals_once(tmp_path):
    logs, shared = tmp_path / "logs", tmp_path / "shared"
    logs.mkdir()
    shared.mkdir()
    done = subprocess.run([sys.executable, "-c", RUN, str(logs), str(shared)], cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    names, plans = {}, {}
    for path in logs.iterdir():
        for line in path.read_text().splitlines():
            event = json.loads(line)
            if event["Event"].endswith("SQLExecutionStart"):
                names[event["executionId"]] = event["description"]
            if "sparkPlanInfo" in event:
                plans[event["executionId"]] = event["sparkPlanInfo"]
    scans = defaultdict(set)
    for i, plan in plans.items():
        scans[names[i]] |= _scans(plan, "lineitem")
    assert scans
    assert {name: len(found) for name, found in scans.items() if len(found) > 1} == {}
    # the log is read rightly: analyses of the deals do show their scan
    assert all(len(scans[name]) == 1 for name in ("full_sales", "magnitude_all", "agent_revenue_rank", "agent_segment"))
