"""Render a bench.py JSON line (stdin) as a markdown table of per-query medians."""

import json
import sys

d = json.loads(sys.stdin.read().strip().splitlines()[-1])
print(f"Spark {d.get('spark')}, local[{d.get('cpus')}], sf{d.get('sf')}, median of {d.get('repeat')} runs; "
      f"total {d['value']:.1f} s over {len(d['queries'])} queries.\n")
print("| query | median s |")
print("|---|---|")
for k, v in sorted(d["queries"].items(), key=lambda x: -x[1]):
    print(f"| `{k}` | {v:.2f} |")
