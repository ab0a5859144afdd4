"""The command line runs the statements and rule sets on Parquet paths."""

import json

from conftest import SMALL_DIR
from rulegrid.__main__ import main
from rulegrid.operators import in_keys_group_sum, join_group_sum, rules_long
from rulegrid.plans.rulebook import EXAMPLE_RULES
from rulegrid.sources import contexts, key_list, table_a, table_b


def _same(spark, path, expected):
    got = spark.read.parquet(path)
    return got.count() == expected.count() and got.exceptAll(expected.select(*got.columns)).count() == 0


def test_cli_statements_and_rules(spark, tmp_path):
    a, b, keys, ctx = table_a(spark, SMALL_DIR), table_b(spark, SMALL_DIR), key_list(spark, SMALL_DIR), contexts(spark, SMALL_DIR)
    for name, df in (("a", a), ("b", b), ("keys", keys), ("ctx", ctx)):
        df.write.parquet(str(tmp_path / name))
    (tmp_path / "rules.json").write_text(json.dumps({**EXAMPLE_RULES, "bad": "nope + 1"}))

    main(["join-group-sum", "--table-a", str(tmp_path / "a"), "--table-b", str(tmp_path / "b"),
          "--out", str(tmp_path / "out1")], spark=spark)
    assert _same(spark, str(tmp_path / "out1"), join_group_sum(a, b))

    main(["in-list-group-sum", "--table-b", str(tmp_path / "b"), "--keys", str(tmp_path / "keys"),
          "--out", str(tmp_path / "out2")], spark=spark)
    assert _same(spark, str(tmp_path / "out2"), in_keys_group_sum(b, keys))

    main(["rules", "--records", str(tmp_path / "ctx"), "--rules", str(tmp_path / "rules.json"),
          "--keys", "event_id", "--form", "long", "--out", str(tmp_path / "out3")], spark=spark)
    expected = rules_long(ctx, {**EXAMPLE_RULES, "bad": "nope + 1"}, ["event_id"])
    assert _same(spark, str(tmp_path / "out3"), expected)
