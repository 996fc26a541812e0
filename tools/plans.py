"""Execute headline queries and write their final (adaptive) physical plans to PLANS.md.

Usage: python tools/plans.py [sf_dir]
"""

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from bronzegate.plans import catalog as C  # noqa: E402
from bronzegate.session import get_spark  # noqa: E402

HEADLINE = ["value_set_orders_lineitem", "value_set_multi_customer_supplier", "value_diff_orders_without_lines",
            "read_metadata", "pair_id_check", "uncovered_ids"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", 16)
    out = [f"# Physical plans\n\nFinal adaptive plans after execution at `{os.path.basename(sf)}`, "
           "local[8], 16 shuffle partitions (`python tools/plans.py`). Look for: `ReadSchema` with only "
           "the needed columns, `partial_*` aggregates before each `Exchange`, and no Python / "
           "Cartesian / nested-loop nodes.\n"]
    for name in HEADLINE:
        df = C.QUERIES[name](spark, sf)
        df.collect()  # run this query so its adaptive plan is final
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="simple")
        text = buf.getvalue().split("+- == Initial Plan ==")[0].strip()
        out.append(f"\n## {name}\n\n```\n{text}\n```\n")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("".join(out))


if __name__ == "__main__":
    main()
