"""Write PLANS.md: the physical plan tree of every registered query, with its scans'
pushed filters and read schemas (from ``explain("formatted")``; no result is computed).

usage: python tools/plans.py [SF_DIR]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarterdeck.plans.catalog import QUERIES  # noqa: E402
from quarterdeck.session import build_session  # noqa: E402

# These run a stream, or write and read back, to build their result; their plan is a plain scan.
SKIP = {"scd1_stream", "analytics_stream", "energy_stream", "recon_source_landing", "table_registry", "json_lines"}


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> str:
    tree, rest = text.split("\n\n\n", 1) if "\n\n\n" in text else (text, "")
    scans = []
    for block in rest.split("\n\n"):
        if "Scan parquet" in block.splitlines()[0] if block.strip() else False:
            loc = re.search(r"Location: \w+ \[(.*?)\]", block)
            pf = re.search(r"PushedFilters: (\[.*?\])\n", block + "\n")
            rs = re.search(r"ReadSchema: (.*)", block)
            name = os.path.basename(loc.group(1)) if loc else "?"
            scans.append(f"- `{name}` PushedFilters {pf.group(1) if pf else '[]'}; ReadSchema `{rs.group(1) if rs else '?'}`")
    return tree.replace("== Physical Plan ==\n", "") + ("\n\nScans:\n" + "\n".join(scans) if scans else "")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(os.environ.get("PLANS_MASTER", "local[8]"))
    out = [
        "# Physical plans",
        "",
        f"Generated by `tools/plans.py` from `explain(\"formatted\")` at `{sf}` (AQE on: the final",
        "plan may still switch join strategies or coalesce partitions at run time).",
        "",
    ]
    for name in sorted(QUERIES):
        if name in SKIP:
            continue
        out += [f"## {name}", "", "```", summarise(formatted(QUERIES[name](spark, sf))).rstrip(), "```", ""]
    spark.stop()
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
