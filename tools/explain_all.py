"""Write ``explain("formatted")`` of every catalogue query to docs/plans/.

usage: python tools/explain_all.py [sf_dir]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


def main() -> None:
    from zonehour.session import build_session

    from zonehour.plans.catalog import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = ROOT / "docs" / "plans"
    out.mkdir(parents=True, exist_ok=True)
    spark = build_session("local[8]", 8)
    summary = [
        "# Plan summary (generated by tools/explain_all.py)",
        "",
        "Counts of operators in each query's physical plan at sf0.01: scans, shuffles (`Exchange` other than",
        "broadcasts), broadcasts, scalar subqueries, generators, and scans with pushed filters. Python evaluation",
        "nodes would be listed in the last column; there are none.",
        "",
        "| query | scans | shuffles | broadcasts | subqueries | generators | scans with pushed filters | Python nodes |",
        "| --- | --- | --- | --- | --- | --- | --- | --- |",
    ]
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        # scratch folder names change every run; keep the plans diff-stable
        text = re.sub(r"file:/[^\s,\]]*", "<path>", text)
        text = re.sub(r"#\d+", "", text)
        text = re.sub(r"(plan_id=|subquery|id=#?|RDD\[)\d+", r"\1", text)
        text = re.sub(r"_(VectorAssembler|OneHotEncoder|StringIndexer)_[0-9a-f]{12}", r"_\1", text)
        (out / f"{name}.txt").write_text(text)
        tree = text.split("\n\n\n", 1)[0]
        scans = len(re.findall(r"Scan (parquet|text|ExistingRDD)", tree))
        broadcasts = tree.count("BroadcastExchange")
        shuffles = tree.count("Exchange") - broadcasts
        pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", text))
        python_nodes = len(re.findall(r"EvalPython|MapInPandas|FlatMapGroupsInPandas|PythonUDF", text))
        summary.append(
            f"| {name} | {scans} | {shuffles} | {broadcasts} | {len(re.findall(r'^Subquery:', text, re.M))} | "
            f"{tree.count('Generate')} | {pushed} | {python_nodes} |"
        )
        print(name, len(text))
    (out / "SUMMARY.md").write_text("\n".join(summary) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
