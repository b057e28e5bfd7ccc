"""Print the operator skeleton (exchanges, joins, windows, aggregates, scans)
of the physical plans behind the main operators, for review.

Usage: python tools/plan_shapes.py [sf_dir]
"""
import re
import sys

sys.path.insert(0, ".")
from ledgerwise.operators import metrics as M  # noqa: E402
from ledgerwise.operators import quality as Q  # noqa: E402
from ledgerwise.operators import ranks as R  # noqa: E402
from ledgerwise.plans import checks  # noqa: E402
from ledgerwise.session import get_session, materialize  # noqa: E402
from ledgerwise.sources import fixtures as FX  # noqa: E402

KEEP = re.compile(r"(Exchange|BroadcastExchange|Join|Window|Aggregate|Scan|Generate|TakeOrdered|Sort\b)")


def skeleton(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            out.append(line[:150])
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[8]", shuffle_partitions=8)
    txn = materialize(FX.txn(spark, sf), "plan-txn")
    from ledgerwise.operators import profile as P
    cases = {
        "percent_rank (steps found beforehand)": R.with_percent_rank(txn.select("id", "Amount"), "Amount", "p"),
        "ntile (borders found beforehand)": R.with_ntile(txn.select("id", "Amount"), "Amount", 4, "id", "q"),
        "correlation_matrix": P.correlation_matrix(txn, ["V1", "V2", "Amount"]),
        "histogram": P.histogram(txn, ["Amount"], 50, "Class"),
        "dedupe": Q.dedupe(FX.lineitem(spark, sf), checks.LINEITEM_KEYS),
        "auc_roc": M.auc_roc(checks._score(txn), "Class", "score"),
        "fraud_by_amount from raw tables": checks.q_fraud_by_amount(spark, sf),
    }
    for name, df in cases.items():
        print(f"== {name}\n{skeleton(df)}\n")


if __name__ == "__main__":
    main()
