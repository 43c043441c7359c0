"""Write PLANS.md: physical plans of the headline queries.

For each query: the operator tree of ``explain("formatted")`` and the scan
lines that show pushdown and pruning (PushedFilters, PartitionFilters,
ReadSchema). Usage: python tools/plans.py [sf_dir] [out_file]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemart.functions import periods as pr  # noqa: E402
from tidemart.plans import catalog, models  # noqa: E402
from tidemart.session import build_session, scratch_path  # noqa: E402
from tidemart.sinks.tables import DayTable  # noqa: E402
from tidemart.sources import fixtures as fx  # noqa: E402
from tidemart.sources.extract import extract_window  # noqa: E402

SCAN_KEYS = ("Location:", "PushedFilters:", "PartitionFilters:", "ReadSchema:")


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(text: str) -> str:
    tree, scans = [], []
    in_tree = True
    for line in text.splitlines():
        if in_tree and line.startswith("("):
            in_tree = False
        if in_tree:
            if line.strip() and not line.startswith("=="):
                tree.append(line)
        elif line.startswith(SCAN_KEYS) or line.startswith("(") and "Scan" in line:
            scans.append(line if len(line) < 400 else line[:400] + " ...")
    return "\n".join(tree) + "\n\n" + "\n".join(scans)


def main(argv) -> None:
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    out = argv[2] if len(argv) > 2 else os.path.join(os.path.dirname(__file__), "..", "PLANS.md")
    spark = build_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    lineitem = fx.read_table(spark, sf, "lineitem")
    fact_table = DayTable(spark, "plans_fact", scratch_path(spark, "plans-fact"), "created_at")
    fact_table.create(models.sales_transaction_fact(fx.order_items_source(spark, sf)), sort_key="id")
    cases = [
        ("sales_report (flagship)", catalog.sales_report(spark, sf)),
        ("merge_guarded", catalog.merge_guarded(spark, sf)),
        ("latest_order_item_per_day", catalog.latest_order_item_per_day(spark, sf)),
        ("signed_daily_sum", catalog.signed_daily_sum_q(spark, sf)),
        ("change window on a stored column (pushed to the scan)",
         extract_window(lineitem, "l_shipdate", "1997-01-01", "1998-01-01")
         .select("l_orderkey", "l_shipdate")),
        ("day list on a stored column (OR of merged ranges)",
         lineitem.filter(pr.day_in("l_shipdate", ["1997-03-01", "1997-03-02", "1997-05-09"]))
         .select("l_orderkey")),
        ("day table read for two days (folder pruning)",
         fact_table.read(days=["1996-03-15", "1996-03-16"]).select("id", "sale_price")),
        ("limit_ordered", catalog.limit_ordered(spark, sf)),
    ]
    parts = [f"# Physical plans ({os.path.basename(sf.rstrip('/'))}, local session)\n",
             "Generated by `python tools/plans.py`: operator tree of `explain(\"formatted\")`",
             "and the scan lines (pushed filters, partition filters, read schema).\n"]
    for title, df in cases:
        parts.append(f"## {title}\n\n```\n{summary(formatted(df))}\n```\n")
    with open(out, "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
