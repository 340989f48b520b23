"""Print the SURVEY-ID -> registered query table (from the query docstrings)."""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from ledgerflow.plans import registry  # noqa: E402

rows = []
for name, fn in sorted(registry.all_queries().items()):
    doc = (fn.__doc__ or "").strip().splitlines()[0] if fn.__doc__ else ""
    ids, _, text = doc.partition(" — ")
    if not text:
        ids, text = "", doc
    rows.append((ids, name, text))
print("| SURVEY IDs | query key | what |\n|---|---|---|")
for ids, name, text in sorted(rows, key=lambda r: (re.sub(r"\d+", lambda m: m.group().zfill(3), r[0]) or "zz", r[1])):
    print(f"| {ids} | `{name}` | {text} |")
