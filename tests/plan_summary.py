"""Write PLANS.md: per query, what its executions (those that write intermediate tables
while the query is built, and its own) did as they ran: exchanges, joins, windows,
aggregates, Python stages, and what reached the Parquet scans. Read from Spark's event log.
python tests/plan_summary.py [sf_dir] [names...]"""

import json
import os
import re
import sys
import tempfile
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402
from quire.session import build_session  # noqa: E402

KINDS = re.compile(r"Exchange|Join|Cartesian|Window|Aggregate|Generate|Python|Pandas|Arrow")


def walk(node: dict, seen: Counter, scans: set) -> None:
    name = re.sub(r" \(\d+\)$", "", node["nodeName"]).strip()
    if KINDS.search(name):
        seen[name] += 1
    if name.startswith("Scan parquet"):
        meta = node.get("metadata", {})
        table = os.path.basename(meta.get("Location", "?").rstrip("]").split(",")[0])
        if table.endswith(".parquet"):
            pushed = meta.get("PushedFilters", "[]")
            parts = meta.get("PartitionFilters", "[]")
            scans.add(f"{table}: {meta.get('ReadSchema', '')}" + (f"; pushed {pushed}" if pushed != "[]" else "")
                      + (f"; partitions {parts}" if parts != "[]" else ""))
    for child in node["children"]:
        walk(child, seen, scans)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    logs = tempfile.mkdtemp(prefix="quire-events-")
    spark = build_session("local[8]", 16, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{logs}",
                                                 "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    queries = {n: f for n, f in sorted(E.queries().items()) if not sys.argv[2:] or n in sys.argv[2:]}
    spans = []
    for name, fn in queries.items():
        began = time.time() * 1000
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        spans.append((name, began, time.time() * 1000))
        time.sleep(0.05)
    spark.stop()
    plans: dict[int, dict] = {}
    starts: dict[int, int] = {}
    for file in os.listdir(logs):
        for line in open(os.path.join(logs, file), errors="replace"):
            e = json.loads(line)
            if "sparkPlanInfo" in e:
                plans[e["executionId"]] = e["sparkPlanInfo"]
                starts.setdefault(e["executionId"], e.get("time", 0))
    out = ["# Physical plans (generated by tests/plan_summary.py)", "",
           f"Input: `{sf}`. Operators of all executions of a query as they ran, after adaptive planning.", ""]
    for name, began, ended in spans:
        mine = [k for k, t in starts.items() if began <= t <= ended]
        seen: Counter = Counter()
        scans: set = set()
        for k in mine:
            walk(plans[k], seen, scans)
        out += [f"## {name}", "", f"* executions: {len(mine)}; operators: "
                + (", ".join(f"{k} x{v}" for k, v in sorted(seen.items())) or "scan/project only"),
                *[f"* scan {s}" for s in sorted(scans)], ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
