"""Run the statements and rule sets on Parquet tables from the command line.

    python -m rulegrid join-group-sum --table-a A --table-b B --out OUT
    python -m rulegrid in-list-group-sum --table-b B --keys KEYS --out OUT [--org-constant oi001]
    python -m rulegrid rules --records R --rules rules.json --keys event_id [--form wide|long|failures] --out OUT

Inputs are Parquet paths with the statement's column names (``table_a``:
``sch_org_id, org_id, inv_item_id``; ``table_b``: ``org_id, item_id, shuju``;
keys: ``inv_item_id, sch_org_id``).  ``rules.json`` maps rule ids to Spark SQL
expression text.  Results are written as Parquet; rules that do not compile
are printed.  Under spark-submit the cluster's master and settings apply.
"""

from __future__ import annotations

import argparse
import json
import sys

from rulegrid.operators import in_keys_group_sum, join_group_sum, rules_failures, rules_long, rules_wide
from rulegrid.operators.rules import check_rules
from rulegrid.session import build_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="python -m rulegrid", description=__doc__.split("\n\n")[0])
    sub = parser.add_subparsers(dest="command", required=True)

    join = sub.add_parser("join-group-sum", help="sum of table_b per table_a group over the two-key join")
    join.add_argument("--table-a", required=True)
    join.add_argument("--table-b", required=True)

    in_list = sub.add_parser("in-list-group-sum", help="sum of table_b per key, filtered by two key lists")
    in_list.add_argument("--table-b", required=True)
    in_list.add_argument("--keys", required=True, help="Parquet of (inv_item_id, sch_org_id) pairs")
    in_list.add_argument("--org-constant", default="oi001")

    rules = sub.add_parser("rules", help="apply a rule set to every record")
    rules.add_argument("--records", required=True)
    rules.add_argument("--rules", required=True, help="JSON object: rule id -> Spark SQL expression")
    rules.add_argument("--keys", default="", help="comma-separated key columns to carry")
    rules.add_argument("--form", choices=("wide", "long", "failures"), default="wide")

    for p in (join, in_list, rules):
        p.add_argument("--out", required=True)
        p.add_argument("--mode", default="errorifexists", help="Parquet save mode")
    return parser


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or build_session(app_name=f"rulegrid-{args.command}")
    read = spark.read.parquet
    if args.command == "join-group-sum":
        result = join_group_sum(read(args.table_a), read(args.table_b))
    elif args.command == "in-list-group-sum":
        result = in_keys_group_sum(read(args.table_b), read(args.keys), org_constant=args.org_constant)
    else:
        with open(args.rules) as fh:
            rule_set = json.load(fh)
        records = read(args.records)
        keys = [k for k in args.keys.split(",") if k]
        for problem in check_rules(records, rule_set):
            print(f"rule {problem.rule_id} does not compile: {problem.message}", file=sys.stderr)
        if args.form == "wide":
            result = rules_wide(records, rule_set, keys)
        elif args.form == "long":
            result = rules_long(records, rule_set, keys)
        else:
            result = rules_failures(records, rule_set)
    result.write.mode(args.mode).parquet(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
