"""Operators against brute force, in particular under skew."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lethe.config import (
    DeletionConfig,
    DeletionRule,
    Group,
    Hop,
    KeyPath,
    MaskingConfig,
    MaskingRule,
)
from lethe.operators import checks, configtables
from lethe.operators.numbering import number_rows
from lethe.operators.purge import purge_audit, survivors
from lethe.operators.reach import Reacher, found_keys, reach_levels
from lethe.operators.sizing import (
    VALUE,
    hot_values,
    keyed_join,
    matched_counts,
    present_values,
    sized,
)
from lethe.sources import keyfile


def skewed_rows(spark, tmp_path, n=9000):
    """A third of all rows hold key 7, a sixth NULL; every row has an exact copy."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise(
        F.col("id") % 500
    )
    rows = spark.range(n).select(key.cast("long").alias("k"), (F.col("id") % 50).alias("x"))
    path = str(tmp_path / "rows")
    rows.union(rows).repartition(6).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("mode", ["broadcast", "shuffle"])
@pytest.mark.parametrize("how", ["left_anti", "left_semi", "inner", "left"])
def test_keyed_join(spark, tmp_path, mode, how, request):
    if mode == "shuffle":
        request.getfixturevalue("no_broadcast")
    rows = skewed_rows(spark, tmp_path)
    wanted = {7: 3, **{i: i % 9 for i in range(0, 500, 4)}}
    values = sized(spark.createDataFrame(list(wanted.items()), f"{VALUE} long, chunk_no int"))
    got = keyed_join(rows, F.col("k"), values, how)
    plain = [(r["k"], r["x"]) for r in rows.collect()]
    keep = {
        "left_anti": lambda k: k not in wanted,
        "left_semi": lambda k: k in wanted,
        "inner": lambda k: k in wanted,
        "left": lambda k: True,
    }[how]
    expected = [p for p in plain if keep(p[0])]
    if how in ("inner", "left"):
        expected = [(*p, wanted.get(p[0])) for p in expected]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))

    counts = matched_counts(rows, F.col("k"), values, ["chunk_no"])
    by_chunk: dict[int, int] = {}
    for k, _ in plain:
        if k in wanted:
            by_chunk[wanted[k]] = by_chunk.get(wanted[k], 0) + 1
    assert {r["chunk_no"]: r["row_count"] for r in counts.collect()} == by_chunk
    present = {r[VALUE] for r in present_values(rows, F.col("k"), values).collect()}
    assert present == {k for k, _ in plain} & set(wanted)


def test_hot_rows_are_spread(spark, tmp_path, no_broadcast):
    rows = skewed_rows(spark, tmp_path)
    assert hot_values(rows, F.col("k")) == [7]
    values = sized(spark.createDataFrame([(7, 1), (8, 2)], f"{VALUE} long, chunk_no int"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = keyed_join(rows, F.col("k"), values, "left")
        parts = [
            r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # 18,000 rows, half of them hot or NULL: no partition may hold that half
    assert sum(parts) == 18_000 and max(parts) < 8_000


def test_scans_are_limited_to_the_reached_range(spark, tmp_path):
    path = str(tmp_path / "ordered")
    spark.range(1000).select("id", F.col("id").cast("string").alias("t")).write.parquet(path)
    rows = spark.read.parquet(path)
    keys = sized(spark.createDataFrame([("40", 1), ("45", 1), ("x", 1)], "key_no string, chunk_no int"))
    values = reach_levels(KeyPath("id", "bigint"), keys, {}, "chunk_no")[-1]
    assert (values.low, values.high) == (40, 45)
    counted = matched_counts(rows, F.col("id"), values, ["chunk_no"])
    assert counted.first()["row_count"] == 2
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,40)" in plan and "LessThanOrEqual(id,45)" in plan
    # nothing reached: nothing matches, and an anti join keeps everything
    nothing = sized(spark.createDataFrame([("x", 1)], "key_no string, chunk_no int"))
    none = reach_levels(KeyPath("id", "bigint"), nothing, {}, "chunk_no")[-1]
    assert keyed_join(rows, F.col("id"), none, "left_semi").isEmpty()
    assert keyed_join(rows, F.col("id"), none, "left_anti").count() == 1000


def test_text_keys_are_hot_too(spark, no_broadcast):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("k")
    )
    assert hot_values(rows, F.col("k")) == ["same"]


def test_numbering_one_large_group(spark):
    frame = spark.range(5000).select(
        F.when(F.col("id") < 4500, "big").otherwise("small").alias("g"),
        F.format_string("%05d", (F.col("id") * 7919) % 5000).alias("k"),
    )
    rows = number_rows(frame, ["g"], ["k"]).collect()
    for g in ("big", "small"):
        ordered = sorted((r["k"], r["position"]) for r in rows if r["g"] == g)
        assert [p for _, p in ordered] == list(range(1, len(ordered) + 1))


def tables(spark):
    parents = [(i, f"k{i % 40}") for i in range(120)]
    children = [(i % 150 if i % 10 else None, i) for i in range(600)]
    return {
        "p": spark.createDataFrame(parents, "id int, key string"),
        "c": spark.createDataFrame(children, "pid int, n int"),
    }, parents, children


@pytest.mark.parametrize("mode", ["broadcast", "shuffle"])
def test_found_keys_and_audit_by_brute_force(spark, mode, request):
    if mode == "shuffle":
        request.getfixturevalue("no_broadcast")
    frames, parents, children = tables(spark)
    keys = [(f"k{i}", i // 3 + 1) for i in range(0, 60, 2)]
    frame = spark.createDataFrame(keys, "key_no string, chunk_no int")
    hop = KeyPath("key", hops=(Hop("pid", "p", "id"),))
    found = {
        r["key_no"] for r in found_keys(hop, frames["c"], sized(frame), frames).collect()
    }
    used = {pid for pid, _ in children}
    assert found == {k for k, _ in keys if any(key == k and i in used for i, key in parents)}

    rules = [DeletionRule("G", "c", 1, hop), DeletionRule("G", "p", 2, KeyPath("key"))]
    reacher = Reacher(frame, frames)
    chunk_of = {i: dict(keys)[key] for i, key in parents if key in dict(keys)}
    kept = {(r["pid"], r["n"]) for r in survivors(rules[:1], reacher).collect()}
    assert kept == {c for c in children if c[0] not in chunk_of}
    assert sum(pid is None for pid, _ in kept) == 60  # NULL references stay
    audit = {
        (r["target_table"], r["chunk_no"]): r["deleted_row_count"]
        for r in purge_audit(rules, reacher).collect()
    }
    expected = {(t, c): 0 for t in ("c", "p") for _, c in keys}
    for pid, _ in children:
        if pid in chunk_of:
            expected["c", chunk_of[pid]] += 1
    for i, key in parents:
        if i in chunk_of:
            expected["p", chunk_of[i]] += 1
    assert audit == expected


def test_two_rules_on_one_table_delete_a_row_once(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "a"), ("c", "c"), (None, "b")], "u string, v string")
    keys = spark.createDataFrame([("a", 2), ("b", 1)], "key_no string, chunk_no int")
    rules = [DeletionRule("G", "t", 1, KeyPath("u")), DeletionRule("G", "t", 2, KeyPath("v"))]
    reacher = Reacher(keys, {"t": rows})
    assert [tuple(r) for r in survivors(rules, reacher).collect()] == [("c", "c")]
    audit = {
        (r["execution_order"], r["chunk_no"]): r["deleted_row_count"]
        for r in purge_audit(rules, reacher).collect()
    }
    assert audit == {(1, 1): 1, (1, 2): 1, (2, 1): 1, (2, 2): 0}


def test_typed_paths(spark):
    rows = {
        "t": spark.createDataFrame(
            [(7, "A0EEBC99-9C0B-4EF8-BB6D-6BB9BD380A11"), (8, None)], "n bigint, u string"
        )
    }
    keys = ["007", "abc", "8", "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11", "not-a-uuid"]
    frame = sized(spark.createDataFrame([(k,) for k in keys], "key_no string"))

    def found(path):
        return {r["key_no"] for r in found_keys(path, rows["t"], frame, rows).collect()}

    assert found(KeyPath("n", "bigint")) == {"007", "8"}
    assert found(KeyPath("u", "uuid")) == {keys[3]}
    assert found(KeyPath("n", "bigint", where="n > 7")) == {"8"}


def test_as_of_condition(spark):
    rows = {"t": spark.createDataFrame([("a", "1990-01-01"), ("a", "2020-01-01"), ("a", None)],
                                       "k string, d string").select("k", F.to_date("d").alias("d"))}
    keys = spark.createDataFrame([("a", 1)], "key_no string, chunk_no int")
    path = KeyPath("k", where="d < add_months({as_of}, -84)")
    rule = DeletionRule("G", "t", 1, path)
    kept = survivors([rule], Reacher(keys, rows, "2021-01-01"))
    assert sorted(str(r["d"]) for r in kept.collect()) == ["2020-01-01", "None"]
    with pytest.raises(ValueError, match="as_of"):
        survivors([rule], Reacher(keys, rows)).collect()
    with pytest.raises(ValueError):
        survivors([rule], Reacher(keys, rows, "1' OR '1'='1")).collect()


# -- key files ---------------------------------------------------------------


def test_key_file_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="not found"):
        keyfile.read_keys_csv(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="unsupported"):
        keyfile.read_keys_csv(spark, str(tmp_path / "keys.xlsx"))
    empty = tmp_path / "empty.csv"
    empty.write_text("key_no\n")
    with pytest.raises(ValueError, match="empty"):
        keyfile.read_keys_csv(spark, str(empty))


def test_key_columns(spark):
    def rows(frame, **options):
        return [tuple(r) for r in keyfile.detect_columns(frame, **options).collect()]

    both = spark.createDataFrame([("T", "1", "x")], "` KEY_TYPE` string, Key_Val string, o string")
    assert rows(both) == [("T", "1")]
    single = spark.createDataFrame([("x", "2")], "a string, ORDER_NO string")
    assert rows(single) == [("ORDER_NO", "2")]
    assert rows(single, key_type="OTHER") == [("OTHER", "2")]
    assert rows(single, fallback=keyfile.MASKING_FALLBACK) == [("CUSTOMER_ID", "x")]


def test_clean_and_dedup(spark):
    cells = ["a", " a ", "a ", "　b", "NA", "null", "", "  ", None, "NA x"]
    frame = spark.createDataFrame([("T", c) for c in cells], "key_type string, key_no string")
    cleaned = keyfile.clean_keys(frame)
    assert sorted(r["key_no"] for r in cleaned.collect()) == ["NA x", "a", "a", "a", "b"]
    assert keyfile.duplicate_count(cleaned).first().asDict() == {
        "total_keys": 5, "unique_keys": 3, "duplicates": 2,
    }
    assert keyfile.clean_keys(frame, na_tokens=()).where("key_no = 'NA'").count() == 1


# -- configuration ----------------------------------------------------------------


def test_config_round_trip_and_rejections(spark):
    path = KeyPath("k", "bigint", (Hop("a", "b", "c", "d > 1"),), "x = 1", True)
    config = DeletionConfig(
        [Group("G", "T", "text", 7, Decimal("0.10"))], [DeletionRule("G", "t", 1, path)]
    )
    again = DeletionConfig.from_frames(config.groups_frame(spark), config.rules_frame(spark))
    assert again == config
    masks = MaskingConfig(
        [Group("G", "T")], [MaskingRule("G", "t", "z", "NULL", path), MaskingRule("G", "t", "a", "1", path)]
    )
    assert MaskingConfig.from_frames(masks.groups_frame(spark), masks.rules_frame(spark)) == masks
    rule = DeletionRule("G", "t", 1, path)
    for groups, rules in [
        ([Group("G", "T")], []),  # active, but nothing to do
        ([Group("G", "T"), Group("G", "U")], [rule]),
        ([Group("G", "T")], [rule, rule]),
        ([Group("H", "T", is_active=False)], [rule]),
        ([Group("G", "T", chunk_size=0)], [rule]),
    ]:
        with pytest.raises(ValueError):
            DeletionConfig(groups, rules)


def test_upsert_keeps_columns_not_named(spark):
    schema = "k string, a int, b int"
    old = spark.createDataFrame([("x", 1, 1), ("y", 2, 2)], schema)
    new = spark.createDataFrame([("y", 9, None), ("z", 8, 8)], schema)
    got = {tuple(r) for r in configtables.upsert(old, new, ["k"], ["a"]).collect()}
    assert got == {("x", 1, 1), ("y", 9, 2), ("z", 8, 8)}
    got = {tuple(r) for r in configtables.upsert(old, new, ["k"]).collect()}
    assert got == {("x", 1, 1), ("y", 9, None), ("z", 8, 8)}


def test_rule_order_and_columns(spark):
    hop = KeyPath("k", hops=(Hop("pid", "p", "id"),))
    config = DeletionConfig(
        [Group("G", "T")], [DeletionRule("G", "p", 1, KeyPath("k")), DeletionRule("G", "c", 2, hop)]
    )
    assert checks.rule_order_conflicts(config) == [("G", 2, "c", 1, "p")]
    frame = spark.createDataFrame([("a", "b")], "email string, k string")
    masks = MaskingConfig(
        [Group("G", "T")],
        [
            MaskingRule("G", "t", "email", "fn_mask_email(email)", KeyPath("k")),
            MaskingRule("G", "t", "gone", "NULL", KeyPath("k")),
        ],
    )
    status = dict((s[2], s[3]) for s in checks.column_status(masks, {"t": frame}, {("t", "email"): 10}))
    assert status["email"].startswith("WARNING") and status["gone"].startswith("ERROR")
