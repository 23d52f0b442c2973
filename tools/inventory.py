"""Print the registered-query inventory as a markdown table (used in README.md)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.plans import registry  # noqa: E402

SECTION = {"q_medallion": "medallion (2.1-2.9)", "q_fraud": "fraud (2.13)", "q_pci": "PCI (2.14)",
           "q_incremental": "incremental B (2.10)", "q_settlement": "settlement C (2.11)",
           "q_lifecycle": "validation/lifecycle (2.12)", "q_streaming": "streaming (2.15)",
           "q_io": "sinks (2.1)", "q_functions": "scalar functions (2.4)"}

registry.queries()
rows = []
for name, q in registry.REGISTRY.items():
    mod = q.build.__module__.rsplit(".", 1)[-1]
    rows.append((SECTION.get(mod, mod), name, "S (DuckDB SQL)" if q.sql else "R (rows + pytest)"))
print("| area | query key | oracle |")
print("| --- | --- | --- |")
for r in rows:
    print(f"| {r[0]} | `{r[1]}` | {r[2]} |")
print(f"\n{len(rows)} queries, {sum(1 for r in rows if r[2].startswith('S'))} with a DuckDB oracle.")
