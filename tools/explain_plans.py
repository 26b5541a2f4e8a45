"""Write PLANS.md: the final (adaptive) physical plan of each registered batch
query, executed once at the given scale, with its scan facts.

Usage: python tools/explain_plans.py [sf_dir] [out_file]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

# Keys whose result is a read of files written by a stream run; their plans
# are scans of that output and say nothing about the work.
FACTS = re.compile(r"(PushedFilters: \[[^\]]*\]|PartitionFilters: \[[^\]]*\]|ReadSchema: \S+)")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = Path(sys.argv[2] if len(sys.argv) > 2 else Path(__file__).resolve().parents[1] / "PLANS.md")
    from squall.plans.catalog import REGISTRY
    from squall.session import local_session

    spark = local_session(8)
    parts = [
        "# Physical plans\n",
        f"Final adaptive plans after one execution at `{sf_dir}` (local[8], 8 shuffle partitions), written by "
        "`tools/explain_plans.py`. Streaming keys are omitted (their results are reads of stream output).\n",
    ]
    for name, e in REGISTRY.items():
        if name.startswith("stream_"):
            continue
        df = e.build(spark, sf_dir)
        df.collect()  # an action on this DataFrame fixes its adaptive plan (small results at sf0.01)
        plan = df._jdf.queryExecution().executedPlan().toString()
        tree = [ln for ln in plan.splitlines() if ln.strip()]
        tree = [re.sub(r"#\d+L?", "", ln)[:160] for ln in tree]
        facts = sorted({m for ln in plan.splitlines() for m in FACTS.findall(ln)})
        parts.append(f"## {name}\n\n```\n" + "\n".join(tree) + "\n```\n")
        if facts:
            parts.append("Scan facts: " + "; ".join(f"`{f[:200]}`" for f in facts) + "\n")
    out.write_text("\n".join(parts))
    print(f"wrote {out}")


if __name__ == "__main__":
    main()
