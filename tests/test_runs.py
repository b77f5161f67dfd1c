"""Whole runs on the small fixtures, with their expected counts."""

from __future__ import annotations

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
    Relation,
)
from lethe.operators import checks, reports
from lethe.plans import erasure
from lethe.plans import masking as mask_plan
from lethe.sources.snapshots import CommitConflict, SnapshotStore

BATCH = "BATCH-1"
ORDERS = 10_000


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "store"))


def seed_orders(spark, store, n=ORDERS, customers=None):
    ids = spark.range(1, n + 1)
    number = F.format_string("ORD-%05d", "id")
    orders = ids.select(
        number.alias("order_no"),
        F.expr("date_add(date'2020-01-01', cast(id % 365 as int))").alias("order_date"),
        F.concat(F.lit("Customer "), F.col("id") % (customers or n)).alias("customer_name"),
    )
    items = ids.select(number.alias("order_no"), F.explode(F.array(*map(F.lit, range(3)))).alias("i"),
                       "id").select((F.col("id") * 3 + F.col("i")).alias("id"), "order_no")
    logs = items.select(F.col("id").alias("item_id"),
                        F.explode(F.array(F.lit("Created"), F.lit("Updated"))).alias("log_text"))
    with store.begin() as change:
        change.overwrite("orders", orders)
        change.overwrite("order_items", items)
        change.overwrite("order_item_logs", logs)


DIRECT = KeyPath("order_no")
ORDER_CONFIG = DeletionConfig(
    [Group("ORDERS", "ORDER_NO", chunk_size=500)],
    [
        DeletionRule(
            "ORDERS", "order_item_logs", 1,
            KeyPath("order_no", hops=(Hop("item_id", "order_items", "id"),)),
        ),
        DeletionRule("ORDERS", "order_items", 2, DIRECT),
        DeletionRule("ORDERS", "orders", 3, DIRECT),
    ],
)
RELATIONS = [
    Relation("order_items", "order_no", "orders", "order_no"),
    Relation("order_item_logs", "item_id", "order_items", "id"),
]


def status_counts(store, table=erasure.TASKS):
    return {
        (r["group_code"], r["status"]): r["n"]
        for r in store.read(table).groupBy("group_code", "status").agg(F.count("*").alias("n"))
        .collect()
    }


def sizes(store, *names):
    return [store.read(n).count() for n in names]


TREE = ("order_item_logs", "order_items", "orders")


def pipeline_keys(spark, n=1000):
    live = spark.range(1, n + 1).select(F.format_string("ORD-%05d", "id").alias("key_no"))
    dummy = spark.createDataFrame([("DUMMY-99901",), ("DUMMY-99902",)], "key_no string")
    return live.union(dummy).select(F.lit("ORDER_NO").alias("key_type"), "key_no")


@pytest.mark.parametrize("mode", ["broadcast", "shuffle"])
def test_deletion_pipeline(spark, store, mode, request):
    if mode == "shuffle":
        request.getfixturevalue("no_broadcast")
    seed_orders(spark, store)
    assert erasure.ingest(store, pipeline_keys(spark), BATCH).count() == 1002
    assert erasure.ingest(store, pipeline_keys(spark), BATCH).count() == 0  # idempotent

    assert erasure.run_deletion_dry_run(store, ORDER_CONFIG, BATCH) == 1
    assert status_counts(store) == {("ORDERS", "VALIDATED"): 1000, ("ORDERS", "NOT_FOUND"): 2}
    estimates = {
        r["target_table"]: r["estimated_rows_to_delete"]
        for r in store.read(erasure.SUMMARY).collect()
    }
    assert estimates == {"order_item_logs": 6000, "order_items": 3000, "orders": 1000}
    assert sizes(store, *TREE) == [60_000, 30_000, 10_000]  # nothing deleted yet

    before = store.read("orders")
    assert erasure.run_deletion(store, ORDER_CONFIG, BATCH) == 1
    assert status_counts(store) == {("ORDERS", "COMPLETED"): 1000, ("ORDERS", "NOT_FOUND"): 2}
    assert sizes(store, *TREE) == [54_000, 27_000, 9_000]

    audit = store.read(erasure.AUDIT)
    assert audit.count() == 2 * 3  # two chunks of 500 keys, three tables
    per_chunk = {
        (r["target_table"], r["chunk_no"]): r["deleted_row_count"] for r in audit.collect()
    }
    assert per_chunk == {
        (t, c): n // 2 for t, n in estimates.items() for c in (1, 2)
    }
    checked = reports.reconcile(store.read(erasure.SUMMARY), audit).collect()
    assert {r["reconciliation_status"] for r in checked} == {"MATCH (100%)"}

    tables = store.read_all()
    left = reports.residual(store.read(erasure.TASKS), {"ORDERS": ("orders", DIRECT)}, tables)
    assert left.first()["sanity_status"] == "CLEAN (0 RESIDUAL)"
    for relation in RELATIONS:
        assert checks.orphans(relation, tables).first()["orphan_rows"] == 0
    keys = pipeline_keys(spark).select(F.col("key_no").alias("order_no"))
    outside = before.join(keys, "order_no", "left_anti")
    assert reports.untouched(outside, tables["orders"]).isEmpty()

    version = store.version
    assert erasure.run_deletion(store, ORDER_CONFIG, BATCH) == 0  # nothing left to do
    assert store.version == version


def test_sample_key_file(spark, store, tmp_path):
    """2,000 keys in one column without a type."""
    seed_orders(spark, store)
    path = tmp_path / "keys.csv"
    path.write_text("key_no\n" + "\n".join(f"ORD-{i:05d}" for i in range(1, 2001)) + "\n")
    from lethe.sources.keyfile import read_keys_csv

    erasure.ingest(store, read_keys_csv(spark, str(path)), BATCH)
    erasure.run_deletion_dry_run(store, ORDER_CONFIG, BATCH)
    erasure.run_deletion(store, ORDER_CONFIG, BATCH)
    totals = {
        r["target_table"]: r["total_rows"]
        for r in reports.audit_totals(
            store.read(erasure.AUDIT), ["target_table"], "deleted_row_count"
        ).collect()
    }
    assert totals == {"order_item_logs": 12_000, "order_items": 6_000, "orders": 2_000}
    assert store.read("orders").count() == 8_000


def test_one_key_in_two_groups(spark, store):
    seed_orders(spark, store, 100, customers=10)
    by_name = KeyPath("customer_name")
    config = DeletionConfig(
        [Group("CUST_LOGS", "CUSTOMER_ID"), Group("CUST_ORDERS", "CUSTOMER_ID")],
        [
            DeletionRule("CUST_LOGS", "orders", 1, by_name),
            DeletionRule("CUST_ORDERS", "orders", 1, by_name),
        ],
    )
    names = [f"Customer {i}" for i in range(1, 5)] + ["NON_EXISTENT_CUST"]
    keys = spark.createDataFrame([("CUSTOMER_ID", n) for n in names], "key_type string, key_no string")
    erasure.ingest(store, keys, BATCH)
    erasure.run_deletion_dry_run(store, config, BATCH)
    assert sum(status_counts(store).values()) == 10
    assert status_counts(store)[("CUST_LOGS", "VALIDATED")] == 4
    erasure.run_deletion(store, config, BATCH)
    # both groups estimated all rows, only the first one found them
    variance = {
        r["group_code"]: r["variance"]
        for r in reports.reconcile(store.read(erasure.SUMMARY), store.read(erasure.AUDIT)).collect()
    }
    assert variance == {"CUST_LOGS": 0, "CUST_ORDERS": -40}
    assert store.read("orders").count() == 60


def test_up_to_order_then_the_rest(spark, store):
    seed_orders(spark, store, 100)
    erasure.ingest(store, pipeline_keys(spark, 10), BATCH)
    erasure.run_deletion_dry_run(store, ORDER_CONFIG, BATCH)
    erasure.run_deletion(store, ORDER_CONFIG, BATCH, up_to_order=1)
    assert status_counts(store)[("ORDERS", "PARTIAL_COMPLETED")] == 10
    assert sizes(store, *TREE) == [540, 300, 100]
    erasure.run_deletion(store, ORDER_CONFIG, BATCH, up_to_order=99)
    assert status_counts(store)[("ORDERS", "COMPLETED")] == 10
    assert sizes(store, *TREE) == [540, 270, 90]


def test_a_filter_on_the_root_spares_the_children(spark, store):
    """A key whose root row is too young is NOT_FOUND, and its children stay."""
    seed_orders(spark, store, 100)
    aged = KeyPath("order_no", where="order_date < add_months({as_of}, -84)")
    config = DeletionConfig(
        [Group("ORDERS", "ORDER_NO")],
        [DeletionRule("ORDERS", "order_items", 1, DIRECT), DeletionRule("ORDERS", "orders", 2, aged)],
    )
    erasure.ingest(store, pipeline_keys(spark, 100), BATCH)
    # order n is of day n of 2020; seven years before the date: older than 11 February
    erasure.run_deletion_dry_run(store, config, BATCH, as_of="2027-02-11")
    assert status_counts(store) == {("ORDERS", "VALIDATED"): 40, ("ORDERS", "NOT_FOUND"): 62}
    erasure.run_deletion(store, config, BATCH, as_of="2027-02-11")
    assert sizes(store, "order_items", "orders") == [180, 60]


def test_unknown_batch(spark, store):
    seed_orders(spark, store, 10)
    assert erasure.run_deletion_dry_run(store, ORDER_CONFIG, "NONE") == 0
    assert erasure.run_deletion(store, ORDER_CONFIG, "NONE") == 0
    with pytest.raises(ValueError, match="has no keys"):
        mask_plan.run_masking_dry_run(store, MASKS, "NONE")
    assert mask_plan.run_masking(store, MASKS, "NONE") == 0


def test_revalidate(spark, store):
    seed_orders(spark, store, 10)
    late = spark.createDataFrame([("ORDER_NO", "ORD-00011")], "key_type string, key_no string")
    erasure.ingest(store, late, BATCH)
    erasure.run_deletion_dry_run(store, ORDER_CONFIG, BATCH)
    assert status_counts(store) == {("ORDERS", "NOT_FOUND"): 1}
    seed_orders(spark, store, 20)  # its data arrives
    erasure.run_deletion_dry_run(store, ORDER_CONFIG, BATCH)
    assert status_counts(store) == {("ORDERS", "NOT_FOUND"): 1}
    erasure.run_deletion_dry_run(store, ORDER_CONFIG, BATCH, revalidate=True)
    assert status_counts(store) == {("ORDERS", "VALIDATED"): 1}


BY_ID = KeyPath("customer_id")
MASKS = MaskingConfig(
    [Group("CUST_TEST_MASK", "CUSTOMER_ID", chunk_size=5)],
    [
        MaskingRule("CUST_TEST_MASK", "customers", column, expression, BY_ID)
        for column, expression in [
            ("email", "fn_mask_email(email)"),
            ("phone_number", "fn_mask_phone(phone_number)"),
            ("citizen_id", "fn_mask_citizen_id(citizen_id)"),
            ("customer_name", "fn_mask_name(customer_name)"),
            ("address", "'CONFIDENTIAL_ADDRESS'"),
        ]
    ],
)


def seed_customers(spark, store):
    n = F.col("id")
    customers = spark.range(1, 21).select(
        F.format_string("CUST-%04d", n).alias("customer_id"),
        F.concat(F.lit("Customer Name "), n).alias("customer_name"),
        F.concat(F.lit("user."), n, F.lit("@enterprise.com")).alias("email"),
        F.format_string("081234%04d", n).alias("phone_number"),
        F.format_string("11005001%05d", n).alias("citizen_id"),
        F.concat(n, F.lit(" Main Road")).alias("address"),
    )
    store.put("customers", customers)
    return customers


def mask_keys(spark):
    names = [f"CUST-{i:04d}" for i in range(1, 11)] + ["CUST-9991", "CUST-9992"]
    return spark.createDataFrame(
        [("CUSTOMER_ID", n) for n in names], "key_type string, key_no string"
    )


@pytest.mark.parametrize("mode", ["broadcast", "shuffle"])
def test_masking_pipeline(spark, store, mode, request):
    if mode == "shuffle":
        request.getfixturevalue("no_broadcast")
    before = seed_customers(spark, store)
    assert mask_plan.ingest(store, mask_keys(spark), BATCH).count() == 12
    assert mask_plan.run_masking_dry_run(store, MASKS, BATCH) == 1
    code = "CUST_TEST_MASK"
    assert status_counts(store, mask_plan.TASKS) == {
        (code, "VALIDATED"): 10, (code, "NOT_FOUND"): 2,
    }
    summary = store.read(mask_plan.SUMMARY).collect()
    assert len(summary) == 5
    assert {r["estimated_rows_to_mask"] for r in summary} == {10}
    assert {len(r["sample_preview"]) for r in summary} == {5}
    first = next(r for r in summary if r["column_name"] == "email")["sample_preview"][0]
    assert (first["before"], first["after"]) == ("user.1@enterprise.com", "u***1@e******.com")

    assert mask_plan.run_masking(store, MASKS, BATCH) == 1
    assert status_counts(store, mask_plan.TASKS) == {
        (code, "COMPLETED"): 10, (code, "NOT_FOUND"): 2,
    }
    audit = store.read(mask_plan.AUDIT).collect()
    assert sorted((r["chunk_number"], r["masked_row_count"]) for r in audit) == [(1, 5), (2, 5)]
    after = store.read("customers")
    assert after.count() == 20
    row = after.where("customer_id = 'CUST-0001'").first()
    assert row["customer_name"] == "C******* N*** 1***"
    assert row["email"] == "u***1@e******.com"
    assert row["phone_number"] == "081-XXX-0001"
    assert row["citizen_id"] == "1-1005-XXXXX-00"
    assert row["address"] == "CONFIDENTIAL_ADDRESS"
    outside = before.where("customer_id > 'CUST-0010'")
    assert reports.untouched(outside, after).isEmpty()
    # completed tasks are neither relabelled nor masked twice
    mask_plan.run_masking_dry_run(store, MASKS, BATCH)
    assert status_counts(store, mask_plan.TASKS)[(code, "COMPLETED")] == 10
    assert mask_plan.run_masking(store, MASKS, BATCH) == 0


def test_masked_key_column_and_partial_masking(spark, store):
    """Order 1 masks the join key itself; order 2 still finds its rows, also later."""
    seed_customers(spark, store)
    store.put(
        "visits",
        spark.range(1, 41).select(
            F.format_string("CUST-%04d", F.col("id") % 20 + 1).alias("who"),
            F.lit("call 0812345678 now").alias("notes"),
        ),
    )
    config = MaskingConfig(
        [Group("G", "CUSTOMER_ID")],
        [
            MaskingRule("G", "customers", "customer_id",
                        "fn_mask_salted_hash(customer_id, :salt)", BY_ID, 1),
            MaskingRule("G", "visits", "who", "fn_mask_salted_hash(who, :salt)",
                        KeyPath("customer_id", hops=(Hop("who", "customers", "customer_id"),)), 2),
            MaskingRule("G", "visits", "notes",
                        "regexp_replace(notes, '[0-9]{10,13}', '[REDACTED_ID]')",
                        KeyPath("who"), 3),
        ],
    )
    salt = {"salt": "it's"}
    mask_plan.ingest(store, mask_keys(spark), BATCH)
    mask_plan.run_masking_dry_run(store, config, BATCH, parameters=salt)
    stored = store.read(mask_plan.SUMMARY).collect()
    assert all("it's" not in r["mask_expression"] for r in stored)
    mask_plan.run_masking(store, config, BATCH, parameters=salt)
    both = store.read("customers").join(
        store.read("visits"), F.col("who") == F.col("customer_id")
    )
    assert both.count() == 40
    assert store.read("visits").where("who like 'MSK_%'").count() == 20
    assert store.read("visits").where("notes like '%REDACTED%'").count() == 20


def test_max_order_then_the_rest(spark, store):
    seed_customers(spark, store)
    config = MaskingConfig(
        [Group("G", "CUSTOMER_ID")],
        [
            MaskingRule("G", "customers", "email", "concat('x', email)", BY_ID, 1),
            MaskingRule("G", "customers", "address", "concat(email, '!')", BY_ID, 2),
        ],
    )
    mask_plan.ingest(store, mask_keys(spark), BATCH)
    mask_plan.run_masking_dry_run(store, config, BATCH)
    mask_plan.run_masking(store, config, BATCH, max_order=1)
    assert status_counts(store, mask_plan.TASKS)[("G", "PARTIAL_COMPLETED")] == 10
    assert mask_plan.run_masking(store, config, BATCH, max_order=1) == 0
    mask_plan.run_masking(store, config, BATCH)
    row = store.read("customers").where("customer_id = 'CUST-0002'").first()
    assert row["email"] == "xuser.2@enterprise.com"  # once
    assert row["address"] == "xuser.2@enterprise.com!"  # order 2 sees order 1
    assert status_counts(store, mask_plan.TASKS)[("G", "COMPLETED")] == 10


def test_partitioned_target_keeps_untouched_partitions(spark, store):
    seed_orders(spark, store, 100)
    orders = store.read("orders").withColumn("month", F.month("order_date"))
    store.put("orders", orders, ("month",))
    untouched = set(store.tables()["orders"].dirs)
    keys = spark.createDataFrame(
        [("ORDER_NO", "ORD-00001"), ("ORDER_NO", "ORD-00002")], "key_type string, key_no string"
    )
    erasure.ingest(store, keys, BATCH)
    erasure.run_deletion_dry_run(store, ORDER_CONFIG, BATCH)
    erasure.run_deletion(store, ORDER_CONFIG, BATCH)
    now = store.tables()["orders"]
    assert untouched <= set(now.dirs)  # both orders are in one file of January
    assert len(now.dropped) == 1 and "/month=1/" in now.dropped[0]
    assert store.read("orders").count() == 98
    old = store.read("orders", store.version - 1).count()
    assert old == 100
    gone = store.expire(keep_last=1)
    assert any("month=1" in path for path in gone["removed"])
    assert store.read("orders").count() == 98


def test_certificate_states_whether_old_copies_are_gone(spark, store):
    seed_orders(spark, store, 50)
    erasure.ingest(store, pipeline_keys(spark, 5), BATCH)
    erasure.run_deletion_dry_run(store, ORDER_CONFIG, BATCH)
    erasure.run_deletion(store, ORDER_CONFIG, BATCH)
    rows = erasure.certificate(store, BATCH).collect()
    assert [r["total_purged_rows"] for r in rows] == [30, 15, 5]
    assert {(r["completed_keys_count"], r["missing_keys_count"]) for r in rows} == {(5, 2)}
    assert not any(r["older_copies_removed"] for r in rows)
    assert store.read("orders", 1).count() == 50  # still there
    assert store.expire(keep_last=1, grace_sec=3600)["removed"] == []
    store.expire(keep_last=1)
    assert all(r["older_copies_removed"] for r in erasure.certificate(store, BATCH).collect())
    assert store.read("orders").count() == 45

    erasure.pseudonymise_batch(store, BATCH, "s")
    names = [r["key_no"] for r in store.read(erasure.TASKS).collect()]
    assert len(names) == 7 and all(n.startswith("MSK_") for n in names)
    assert status_counts(store)[("ORDERS", "COMPLETED")] == 5


def test_previews_are_dropped(spark, store):
    seed_customers(spark, store)
    mask_plan.ingest(store, mask_keys(spark), BATCH)
    mask_plan.run_masking_dry_run(store, MASKS, BATCH)
    mask_plan.drop_previews(store, "2000-01-01")
    assert {len(r["sample_preview"]) for r in store.read(mask_plan.SUMMARY).collect()} == {5}
    mask_plan.drop_previews(store, "2999-01-01")
    summary = store.read(mask_plan.SUMMARY).collect()
    assert len(summary) == 5 and {len(r["sample_preview"]) for r in summary} == {0}


def test_failed_transaction_leaves_no_trace(spark, store):
    seed_orders(spark, store, 10)
    version, tables = store.version, store.tables()
    with pytest.raises(RuntimeError), store.begin() as change:
        change.overwrite("orders", spark.range(1))
        raise RuntimeError
    assert store.version == version and store.tables() == tables


def test_second_writer_is_refused(spark, store):
    seed_orders(spark, store, 10)
    first, second = store.begin(), store.begin()
    first.overwrite("a", spark.range(1))
    first.commit()
    second.overwrite("b", spark.range(1))
    with pytest.raises(CommitConflict):
        second.commit()
    assert set(store.tables()) >= {"a"} and "b" not in store.tables()
