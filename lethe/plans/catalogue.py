"""Every operator as a query over the sample tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.config import DeletionConfig, KeyPath, MaskingRule
from lethe.functions import masks
from lethe.operators import checks, configtables, reports
from lethe.operators.masking import (
    estimate_mask,
    mask_apply,
    mask_audit,
    mask_preview,
    mask_steps,
    preview_samples,
    preview_unpack,
    rule_grouping,
)
from lethe.operators.purge import by_table, estimate_delete, survivors, union_all
from lethe.operators.reach import Reacher, eligible, match_column
from lethe.operators.sizing import durable, keyed_join
from lethe.operators.tally import tallied_estimates
from lethe.operators.tasks import (
    expand_tasks,
    first_rule,
    group_scope,
    missing_keys,
)
from lethe.plans import erasure, overlay
from lethe.plans import masking as mask_plan
from lethe.plans.overlay import BATCH, DELETION, MASKING, REPORT_GROUPS, SALT, Overlay
from lethe.session import shared_folder
from lethe.sources import keyfile
from lethe.sources.snapshots import SnapshotStore
from lethe.streaming.audit_rate import read_rates, start_audit_rate
from lethe.streaming.requests import read_requests, start_intake
from lethe.streaming.suppress import read_output, start_suppression

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
PARAMETERS = {"salt": SALT}
TASK = ["group_code", "key_no", "status"]


def query(groups: tuple[str, ...] | None = None):
    def register(build):
        QUERIES[build.__name__] = lambda spark, sf_dir: build(Overlay(spark, sf_dir, groups))
        return build

    return register


def work_folder(o: Overlay) -> str:
    """A new folder in the place all executors share."""
    return f"{shared_folder(o.spark).rstrip('/')}/lethe-{uuid.uuid4().hex}"


def new_store(o: Overlay, tables: dict[str, tuple[str, ...]]) -> SnapshotStore:
    store = SnapshotStore(o.spark, f"{work_folder(o)}/store")
    with store.begin() as change:
        for name, partition_by in tables.items():
            change.overwrite(name, o.tables[name], partition_by)
    return store


# -- sources and sinks -----------------------------------------------------


def _written_csv(o: Overlay, frame: DataFrame) -> str:
    folder = f"{work_folder(o)}/keys"
    writer = frame.write.option("header", True)
    writer = writer.option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(folder)
    return folder


@query()
def keys_csv(o):
    return keyfile.keys_of(keyfile.read_keys_csv(o.spark, _written_csv(o, o.raw_keys)))


@query()
def keys_detect_columns(o):
    raw = o.raw_keys
    cases = {
        "type_and_value": keyfile.detect_columns(raw.toDF(" Key_Type", "KEY_VAL ")),
        "order_column": keyfile.detect_columns(
            o.tables["orders"].select("o_orderstatus", F.col("o_orderkey").alias(" Order_No "))
        ),
        "customer_column": keyfile.detect_columns(
            o.tables["customer"].select("c_name", F.col("c_custkey").alias("Customer_ID")),
            fallback=keyfile.MASKING_FALLBACK,
        ),
        "first_column": keyfile.detect_columns(o.tables["supplier"], "SUPPLIER_ID"),
    }
    return union_all(
        [f.select(F.lit(n).alias("case_name"), "*") for n, f in cases.items()]
    )


@query()
def keys_clean(o):
    return keyfile.clean_keys(o.raw_keys)


@query()
def keys_dedup(o):
    return keyfile.dedup_keys(keyfile.clean_keys(o.raw_keys))


@query()
def keys_dedup_count(o):
    return keyfile.duplicate_count(keyfile.clean_keys(o.raw_keys))


@query()
def keys_upsert(o):
    stored = o.items.where("key_type = 'CUSTOMER_ID'")
    added = keyfile.new_items(keyfile.keys_of(o.raw_keys), stored, BATCH)
    return added.select("batch_id", "key_type", "key_no")


@query()
def keys_breakdown(o):
    return keyfile.keys_breakdown(o.items)


@query()
def keys_errors(o):
    good = _written_csv(o, o.raw_keys)
    empty = _written_csv(o, o.raw_keys.where("key_type = 'NO SUCH TYPE'"))
    found = []
    for name, path in (
        ("good", good), ("empty", empty), ("missing", f"{good}-none"), ("format", f"{good}.xlsx"),
    ):
        try:
            frame = keyfile.keys_of(keyfile.read_keys_csv(o.spark, path))
            found.append(frame.agg(F.lit(name).alias("case_name"), F.lit(True).alias("accepted"),
                                   F.count(F.lit(1)).alias("keys")))
        except ValueError:
            found.append(o.spark.range(1).select(F.lit(name).alias("case_name"),
                                                 F.lit(False).alias("accepted"),
                                                 F.lit(0).cast("bigint").alias("keys")))
    return union_all(found)


def _nation_store(o: Overlay) -> SnapshotStore:
    """Customers partitioned by nation, then purged of one region's nations."""
    store = new_store(o, {"customer": ("c_nationkey",)})
    config = DeletionConfig(
        [DELETION.group("NATION_PURGE")],
        [r for r in DELETION.rules_of("NATION_PURGE") if r.target_table == "customer"],
    )
    erasure.ingest(store, o.raw_keys, BATCH)
    erasure.run_deletion_dry_run(store, config, BATCH, group_code="NATION_PURGE")
    erasure.run_deletion(store, config, BATCH)
    return store


@query()
def table_snapshot_write(o):
    return _nation_store(o).read("customer")


@query()
def snapshot_expire(o):
    store = _nation_store(o)
    result = store.expire(keep_last=1)
    removed = sum("/c_nationkey=" in path for path in result["removed"])
    return store.read("customer").agg(
        F.count(F.lit(1)).alias("rows_left"),
        F.lit(removed).cast("bigint").alias("partitions_removed"),
        F.lit(len(result["kept_commits"])).cast("bigint").alias("commits_left"),
    )


AUDIT_COLUMNS = ["group_code", "target_table", "execution_order", "chunk_no", "deleted_row_count"]


@query()
def audit_append(o):
    store = _full_run(o)  # one append per group
    return store.read(erasure.AUDIT).select("batch_id", *AUDIT_COLUMNS)


SUMMARY_COLUMNS = ["group_code", "target_table", "execution_order", "estimated_rows_to_delete"]


@query(groups=REPORT_GROUPS)
def summary_replace(o):
    stale = o.summary.withColumn("estimated_rows_to_delete", F.lit(-1).cast("bigint"))
    fresh = o.summary.where("group_code <> 'ORDERS'")
    replaced = configtables.replace_scope(stale, fresh, ["batch_id", "group_code"])
    return replaced.select("batch_id", *SUMMARY_COLUMNS)


# -- configuration (one group per supplier, rules from its shipments) --------


def supplier_groups(o: Overlay) -> DataFrame:
    return o.tables["supplier"].select(
        F.concat(F.lit("SUP_"), "s_suppkey").alias("group_code"),
        F.when(F.col("s_nationkey") < 10, "PART_NO").otherwise("LINE_NO").alias("key_type"),
        F.col("s_name").alias("description"),
        F.lit(500).alias("chunk_size"),
        F.expr("cast(0.05 as decimal(4,2))").alias("throttle_sec"),
        (F.col("s_acctbal") >= 0).alias("is_active"),
    )


def supplier_rules(o: Overlay) -> DataFrame:
    lines = o.tables["lineitem"].select("l_suppkey", "l_linenumber").distinct()
    return lines.select(
        F.concat(F.lit("SUP_"), "l_suppkey").alias("group_code"),
        F.concat(F.lit("lines_"), "l_linenumber").alias("target_table"),
        F.col("l_linenumber").alias("execution_order"),
        F.lit("l_suppkey").alias("key_path"),
    )


@query()
def config_upsert_group(o):
    returned = o.tables["lineitem"].where("l_returnflag = 'R'").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).cast("int").alias("n")
    )
    shifted = F.col("l_suppkey") + 50  # some known, some new
    new = returned.select(
        F.concat(F.lit("SUP_"), shifted).alias("group_code"),
        F.lit("RETURN_NO").alias("key_type"),
        F.lit("returned lines").alias("description"),
        F.col("n").alias("chunk_size"),
        F.expr("cast(0.10 as decimal(4,2))").alias("throttle_sec"),
        F.lit(True).alias("is_active"),
    )
    update = ["key_type", "description", "is_active"]
    return configtables.upsert(supplier_groups(o), new, ["group_code"], update)


@query()
def config_upsert_rule(o):
    late = o.tables["lineitem"].where("l_linestatus = 'F'").select(
        F.concat(F.lit("SUP_"), "l_suppkey").alias("group_code"),
        F.lit("final_lines").alias("target_table"),
        (F.col("l_linenumber") + 3).alias("execution_order"),
        F.lit("l_partkey").alias("key_path"),
    ).distinct()
    return configtables.upsert(supplier_rules(o), late, ["group_code", "execution_order"])


@query()
def config_overview(o):
    return configtables.config_overview(supplier_groups(o), supplier_rules(o))


@query()
def config_rule_order(o):
    return configtables.config_rule_order(supplier_groups(o), supplier_rules(o))


@query()
def config_active_filter(o):
    rules = supplier_rules(o).withColumn("is_active", F.col("execution_order") != 2)
    return configtables.active_rules(supplier_groups(o), rules)


@query()
def config_deactivate_conflicts(o):
    groups = configtables.deactivate_conflicts(supplier_groups(o), "PART_NO", "SUP_1")
    return groups.select("group_code", "key_type", "is_active")


# -- expansion and validation ------------------------------------------------


@query()
def expand_tasks_all(o):
    return o.pending.select("batch_id", "key_type", *TASK)


QUERIES["expand_tasks"] = QUERIES.pop("expand_tasks_all")


@query()
def expand_tasks_skip(o):
    known = o.pending.where("group_code = 'CUST_EVENTS'")
    added = expand_tasks(o.items, o.groups, known, key_type="CUSTOMER_ID")
    return added.select("batch_id", "key_type", *TASK)


@query()
def expand_tasks_mask(o):
    mask_plan.require_batch(o.items, BATCH)
    return o.mask_pending.select("batch_id", "key_type", *TASK)


def _validate_root(o):
    return o.tasks.select(*TASK)


def _validate_first(o):
    return o.mask_tasks.select(*TASK)


QUERIES["validate_root"] = lambda s, d: _validate_root(Overlay(s, d))
QUERIES["validate_first"] = lambda s, d: _validate_first(Overlay(s, d))


@query()
def root_rule_pick(o):
    rules = supplier_rules(o)
    order = F.col("execution_order")
    return union_all(
        [
            first_rule(rules, order.desc()).withColumn("picked", F.lit("root")),
            first_rule(rules, order.asc()).withColumn("picked", F.lit("first")),
        ]
    ).select("picked", "group_code", "target_table", "execution_order")


def _group_scope(o):
    return group_scope(o.tasks, o.groups, "VALIDATED").select("group_code", "key_type")


QUERIES["group_scope"] = lambda s, d: _group_scope(Overlay(s, d))


def _missing(o):
    return missing_keys(o.tasks, o.rules).drop("created_at")


QUERIES["missing_keys"] = lambda s, d: _missing(Overlay(s, d))


# -- key paths -----------------------------------------------------------------


def reached(o: Overlay, group_code: str, table: str) -> DataFrame:
    """Rows a group's rule for a table reaches from the whole key file."""
    rule = next(r for r in DELETION.rules_of(group_code) if r.target_table == table)
    reacher = o.all_keys_reacher(group_code)
    target = eligible(o.tables[table], rule.path, overlay.AS_OF)
    return keyed_join(target, match_column(rule.path), reacher.values(rule.path), "left_semi")


@query()
def path_direct(o):
    return reached(o, "CUST_ORDERS", "orders").select("o_orderkey", "o_custkey")


@query()
def path_one_hop(o):
    return reached(o, "CUST_ORDERS", "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")


@query()
def path_two_hop(o):
    return reached(o, "NATION_PURGE", "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")


@query()
def path_multi_branch(o):
    reacher = o.all_keys_reacher("NATION_PURGE")
    return estimate_delete(DELETION.rules_of("NATION_PURGE"), reacher)


@query()
def path_typed(o):
    return reached(o, "CUST_ORDERS", "customer").select("c_custkey", "c_name")


@query()
def path_filtered(o):
    return reached(o, "ORDERS_AGED", "orders").select("o_orderkey", "o_orderdate")


@query()
def path_case_insensitive(o):
    customers = o.pii_tables["customer"]
    keys = customers.where("c_acctbal < 0").select(
        F.upper("username").alias("key_no"), F.lit(1).alias("chunk_no")
    )
    path = KeyPath("username", ignore_case=True)
    values = Reacher(keys, {}).values(path)
    hits = keyed_join(customers, match_column(path), values, "left_semi")
    return hits.select("c_custkey", "username")


@query()
def path_flat(o):
    return reached(o, "SESSIONS", "events").select("event_id", "user_id")


# -- dry run ---------------------------------------------------------------------

ALL_GROUPS = tuple(g.group_code for g in DELETION.active_groups())


def _estimate_delete(o):
    """As a dry run does it: all validated keys at once, without chunks."""
    sized = erasure.dry_run_keys(o.tasks, list(ALL_GROUPS))
    reachers = {c: Reacher.over(k, o.tables, overlay.AS_OF) for c, k in sized.items()}
    return tallied_estimates(erasure.prepared_claims(DELETION, reachers))


QUERIES["estimate_delete"] = lambda s, d: _estimate_delete(Overlay(s, d, ALL_GROUPS))


def _mask_estimates(o: Overlay) -> DataFrame:
    return union_all(
        [
            estimate_mask(MASKING.rules_of(g.group_code), o.mask_reacher(g.group_code))
            for g in MASKING.active_groups()
        ]
    )


QUERIES["estimate_mask"] = lambda s, d: _mask_estimates(Overlay(s, d))


def _previews(o: Overlay) -> DataFrame:
    return preview_samples(o.mask_claims(), PARAMETERS).drop("sample_index")


QUERIES["mask_preview"] = lambda s, d: _previews(Overlay(s, d))


@query()
def mask_preview_failsoft(o):
    rules = MASKING.rules_of("CUST_PII")
    email, path = rules[0], rules[0].path
    broken = [
        MaskingRule("CUST_PII", "customer", "phone", "no_such_function(phone)", path),
        MaskingRule("CUST_PII", "customer", "address", "cast(address as int)", path),
    ]
    made = mask_preview([email, *broken], o.mask_reacher("CUST_PII"))
    return made.select("target_table", "column_name", F.size("sample_preview").alias("samples"))


@query()
def preview_unpack_rows(o):
    made = [
        mask_preview(MASKING.rules_of(g.group_code), o.mask_reacher(g.group_code), PARAMETERS)
        for g in MASKING.active_groups()
    ]
    return preview_unpack(union_all(made))


QUERIES["preview_unpack"] = QUERIES.pop("preview_unpack_rows")

# -- real deletion -----------------------------------------------------------------


def _chunks(o):
    return o.chunked.select("group_code", "key_no", "chunk_no")


QUERIES["assign_chunks"] = lambda s, d: _chunks(Overlay(s, d))


def _purged_lines(o):
    rules = [r for r in DELETION.rules_of("CUST_ORDERS") if r.target_table == "lineitem"]
    return survivors(rules, o.reacher("CUST_ORDERS"))


QUERIES["purge_rows"] = lambda s, d: _purged_lines(Overlay(s, d, ("CUST_ORDERS",)))


def _left(tables: dict[str, DataFrame], names: tuple[str, ...]) -> DataFrame:
    return union_all(
        [
            tables[n].agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("rows_left"))
            for n in names
        ]
    )


@query(groups=("CUST_ORDERS",))
def purge_up_to_order(o):
    return _left(o.purged("CUST_ORDERS", 2), ("lineitem", "orders", "customer"))


PURGED_TABLES = ("customer", "events", "lineitem", "nation", "orders", "supplier")


def _dry_store(o: Overlay) -> SnapshotStore:
    """The tables adopted where they lie, keys taken in and the dry run done."""
    store = SnapshotStore(o.spark, f"{work_folder(o)}/store")
    store.adopt_all({t: f"{o.sf_dir}/{t}.parquet" for t in PURGED_TABLES})
    erasure.ingest(store, o.raw_keys, BATCH)
    erasure.run_deletion_dry_run(store, DELETION, BATCH, as_of=overlay.AS_OF)
    return store


def _full_run(o: Overlay) -> SnapshotStore:
    store = _dry_store(o)
    erasure.run_deletion(store, DELETION, BATCH, as_of=overlay.AS_OF)
    return store


@query()
def purge_multi_group(o):
    return _left(_full_run(o).read_all(), PURGED_TABLES)


def _purge_audit(o):
    return o.audit_of(ALL_GROUPS).select(*AUDIT_COLUMNS)


QUERIES["purge_audit"] = lambda s, d: _purge_audit(Overlay(s, d))


@query(groups=REPORT_GROUPS)
def task_complete(o):
    return o.finished.select(*TASK, "processed_at")


@query()
def resume_batch(o):
    store = _dry_store(o)
    erasure.run_deletion(store, DELETION, BATCH, "CUST_ORDERS", up_to_order=2, as_of=overlay.AS_OF)
    erasure.run_deletion(store, DELETION, BATCH, as_of=overlay.AS_OF)  # takes up what is still open
    return store.read(erasure.TASKS).select(*TASK)


# -- mask functions ---------------------------------------------------------------


def _customer_mask(name: str, build: Callable[[], F.Column], source: str = "customer",
                   key: str = "c_custkey"):
    QUERIES[name] = lambda spark, sf_dir: Overlay(spark, sf_dir).pii_tables[source].select(
        key, build().alias("masked")
    )


_customer_mask("mask_email", lambda: masks.mask_email("email"))
_customer_mask("mask_phone", lambda: masks.mask_phone("phone"))
_customer_mask("mask_citizen_id", lambda: masks.mask_citizen_id("citizen_id"))
_customer_mask("mask_credit_card", lambda: masks.mask_credit_card("card"))
_customer_mask("mask_name", lambda: masks.mask_name("full_name"))
_customer_mask("mask_salted_hash", lambda: masks.mask_salted_hash("email"))
_customer_mask("mask_partial", lambda: masks.mask_partial("phone", 3, 3, "X"))
_customer_mask(
    "mask_date_shift", lambda: masks.mask_date_shift("o_orderdate", -45, 45).cast("date"),
    "orders", "o_orderkey",
)
_customer_mask("mask_static", lambda: masks.mask_static("CONFIDENTIAL_ADDRESS"))
_customer_mask("mask_null", lambda: masks.mask_null())
_customer_mask(
    "mask_sequential", lambda: masks.mask_sequential("REDACTED_ADDR_", "o_orderkey", 4),
    "orders", "o_orderkey",
)
_customer_mask("mask_unique_alias", lambda: masks.mask_unique_alias("c_custkey"))
_customer_mask(
    "mask_numeric_noise",
    lambda: masks.mask_numeric_noise("o_totalprice", "o_orderkey").cast("double"),
    "orders", "o_orderkey",
)
_customer_mask(
    "mask_conditional",
    lambda: F.when(F.col("c_mktsegment") == "BUILDING", F.lit("CONFIDENTIAL_VIP")).otherwise(
        masks.mask_name("full_name")
    ),
)
_customer_mask(
    "mask_custom_expr",
    lambda: F.expr(
        "CASE WHEN email IS NULL THEN fn_mask_partial(username, 1, 3) "
        "ELSE concat(fn_mask_email(email), '/', fn_mask_phone(phone)) END"
    ),
)
_customer_mask(
    "mask_regex_redact", lambda: masks.mask_regex_redact("text"), "documents", "doc_id"
)


@query()
def mask_json_merge(o):
    merged = masks.mask_json_merge("payload", {"cvv": '"***"', "ssn": '"XXX-XX-XXXX"'})
    fields = {"tier": "string", "visits": "bigint", "cvv": "string", "ssn": "string"}
    return o.pii_tables["customer"].select("c_custkey", merged.alias("_m")).select(
        "c_custkey",
        *[F.get_json_object("_m", f"$.{n}").cast(t).alias(n) for n, t in fields.items()],
    )


# -- real masking ------------------------------------------------------------------


def _masked(o: Overlay, group: str, table: str, max_order: int | None = None) -> DataFrame:
    steps = [s for s in mask_steps(MASKING.rules_of(group, max_order)) if s.target_table == table]
    return mask_apply(o.pii_tables[table], steps, o.mask_reacher(group), PARAMETERS)


def _mask_apply(o):
    return _masked(o, "CUST_PII", "customer")


QUERIES["mask_apply"] = lambda s, d: _mask_apply(Overlay(s, d))


@query()
def mask_rule_grouping(o):
    rules = o.tables["lineitem"].select("l_suppkey", "l_linenumber").distinct().select(
        F.concat(F.lit("SUP_"), "l_suppkey").alias("group_code"),
        F.lit("lineitem").alias("target_table"),
        F.concat(F.lit("column_"), "l_linenumber").alias("column_name"),
        F.concat(F.lit("fn_mask_name(column_"), "l_linenumber", F.lit(")")).alias(
            "mask_expression"
        ),
        F.lit("l_suppkey").alias("key_path"),
        (F.col("l_linenumber") % 2 + 1).alias("execution_order"),
        (F.col("l_linenumber") != 7).alias("is_active"),
    )
    return rule_grouping(rules)


def _changed_rows(before: DataFrame, after: DataFrame, key: str, column: str) -> DataFrame:
    pair = before.select(key, F.col(column).alias("_was")).join(
        after.select(key, F.col(column).alias("_is")), key
    )
    return pair.agg(
        F.lit(column).alias("column_name"),
        F.count(F.when(~F.col("_was").eqNullSafe(F.col("_is")), 1)).alias("changed_rows"),
    )


@query()
def mask_max_order(o):
    """Orders up to 1 leave the second table as it was."""
    steps = mask_steps(MASKING.rules_of("CUST_PII", 1))
    before = o.pii_tables
    masked = {s.target_table: _masked(o, "CUST_PII", s.target_table, 1) for s in steps}
    after = before.replaced(masked)
    return union_all(
        [
            _changed_rows(before["customer"], after["customer"], "c_custkey", "address"),
            _changed_rows(before["orders"], after["orders"], "o_orderkey", "contact"),
        ]
    )


MASKED_TABLES = (
    ("CUST_PII", "customer", "c_custkey"), ("CUST_PII", "orders", "o_orderkey"),
    ("USER_ANON", "customer", "c_custkey"), ("USER_ANON", "events", "event_id"),
)


@query()
def mask_multi_table(o):
    """Every masked column of every table of both groups, row by row."""
    parts = []
    for group, table, key in MASKED_TABLES:
        columns = [r.column_name for r in MASKING.rules_of(group) if r.target_table == table]
        cells = [
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("masked"))
            for c in columns
        ]
        parts.append(
            _masked(o, group, table).select(
                F.lit(group).alias("group_code"), F.lit(table).alias("table_name"),
                F.col(key).cast("bigint").alias("row_key"), F.inline(F.array(*cells)),
            )
        )
    return union_all(parts)


@query()
def mask_join_preserving(o):
    before, customers = o.pii_tables, _masked(o, "USER_ANON", "customer")
    events = _masked(o, "USER_ANON", "events")

    def joined(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
        # events are counted per actor first, so a busy actor is one row
        busy = right.groupBy("actor").agg(F.count(F.lit(1)).alias("n"))
        both = left.join(busy, F.col("username") == F.col("actor"))
        return both.agg(
            F.lit(name).alias("state"), F.count(F.lit(1)).alias("actors"),
            F.sum("n").alias("joined_rows"),
        )

    return joined(before["customer"], before["events"], "before").unionByName(
        joined(customers, events, "after")
    )


def _mask_audit(o: Overlay) -> DataFrame:
    return union_all(
        [
            mask_audit(mask_steps(MASKING.rules_of(g.group_code)), o.mask_reacher(g.group_code))
            for g in MASKING.active_groups()
        ]
    )


QUERIES["mask_audit"] = lambda s, d: _mask_audit(Overlay(s, d))


# -- reports --------------------------------------------------------------------------


def report(name: str, build: Callable[[Overlay], DataFrame]):
    QUERIES[name] = lambda spark, sf_dir: build(Overlay(spark, sf_dir, REPORT_GROUPS))


def _run_summary(o: Overlay) -> DataFrame:
    """Summary of the groups that ran, with one rule never estimated."""
    return o.summary.where("NOT (group_code = 'CUST_ORDERS' AND execution_order = 3)")


report("rpt_ingest_mapping", lambda o: reports.ingest_mapping(o.items, o.tasks, o.rules))
report("rpt_match_rate", lambda o: reports.match_rate(o.tasks, o.rules))
report("rpt_missing", lambda o: missing_keys(o.finished, o.rules))
report("rpt_estimates", lambda o: reports.estimates(o.summary))
report("rpt_signoff", lambda o: reports.signoff(o.items, o.finished, o.rules, _run_summary(o)))
report("rpt_signoff_totals", lambda o: reports.signoff_totals(o.summary, o.tasks))
report("rpt_progress", lambda o: reports.progress(o.finished, o.rules))
report("rpt_reconcile", lambda o: reports.reconcile(_run_summary(o), o.audit))
report("rpt_throughput", lambda o: reports.throughput(o.audit))
report("rpt_certificate", lambda o: reports.certificate(o.audit, o.finished))
report("rpt_status_share", lambda o: reports.status_share(o.finished))
report("rpt_status_plain", lambda o: reports.status_plain(o.finished))
report("rpt_status_times", lambda o: reports.status_times(o.finished))
report("rpt_failed", lambda o: reports.failed_tasks(o.finished))
report("rpt_not_found_sample", lambda o: reports.not_found_sample(o.tasks))
report("rpt_audit_trail", lambda o: reports.audit_trail(o.audit))
report(
    "rpt_audit_totals",
    lambda o: reports.audit_totals(o.audit, ["group_code", "target_table"], "deleted_row_count"),
)


def _residual(o: Overlay) -> DataFrame:
    """Groups that ran are looked for in what their own purge left.

    The last group's keys are taken as completed although nothing was purged.
    """
    finished = o.finished.withColumn(
        "status",
        F.when((F.col("group_code") == "ORDERS") & (F.col("status") == "VALIDATED"), "COMPLETED")
        .otherwise(F.col("status")),
    )
    finished = durable(finished)
    tables = o.tables.replaced(
        {
            "customer": o.purged("CUST_ORDERS")["customer"],
            "nation": o.purged("NATION_PURGE")["nation"],
            # both groups of events ran
            "events": survivors(
                DELETION.rules_of("SESSIONS"),
                Reacher.over(
                    o.chunked_keys["SESSIONS"],
                    o.tables.replaced({"events": o.purged("CUST_EVENTS")["events"]}),
                ),
            ),
        }
    )
    roots = {
        c: (DELETION.root_rule(c).target_table, DELETION.root_rule(c).path)
        for c in REPORT_GROUPS
    }
    return reports.residual(finished, roots, tables)


report("rpt_residual", _residual)


def _timed_mask_audit(o: Overlay) -> DataFrame:
    """Mask audit with a fixed clock and a duration that follows the rows."""
    return durable(
        _mask_audit(o).withColumns(
            {
                "duration_sec": (F.col("masked_row_count") * F.lit(0.001) + F.lit(0.1)).cast(
                    "decimal(10,3)"
                ),
                "processed_at": o.chunk_time(F.col("chunk_number")),
            }
        )
    )


report("rpt_mask_audit", lambda o: reports.mask_audit_summary(_timed_mask_audit(o)))
report("rpt_chunk_timeline", lambda o: reports.chunk_timeline(_timed_mask_audit(o)))


def _all_masked(o: Overlay, table: str) -> DataFrame:
    """A table after the runs of both groups."""
    frame = o.pii_tables[table]
    for group in MASKING.active_groups():
        code = group.group_code
        steps = [s for s in mask_steps(MASKING.rules_of(code)) if s.target_table == table]
        if steps:
            # hits are resolved on the tables as they were
            frame = mask_apply(frame, steps, o.mask_reacher(code), PARAMETERS)
    return frame


#: masked tables, the column that leads to their subjects and the path keys take to it
SUBJECTS = (
    ("customer", "c_custkey", KeyPath("c_custkey", "bigint")),
    ("orders", "o_custkey", KeyPath("o_custkey", "bigint")),
    ("events", "user_id", KeyPath("user_id", "bigint")),
)


@query()
def verify_untouched(o):
    """Rows outside the key file that masking changed (none), per table."""
    parts = []
    for table, key, path in SUBJECTS:
        outside = [o.pii_tables[table], _all_masked(o, table)]
        for group in MASKING.active_groups():
            values = o.mask_reacher(group.group_code).values(path)
            outside = [keyed_join(f, F.col(key), values, "left_anti") for f in outside]
        lost = reports.untouched(*outside)
        numbers = {"rows_checked": outside[0], "rows_changed": lost}
        counted = {n: f.agg(F.count(F.lit(1)).alias("n")) for n, f in numbers.items()}
        parts.append(
            reports.side_by_side(counted).select(F.lit(table).alias("table_name"), "*")
        )
    return union_all(parts)


@query(groups=REPORT_GROUPS)
def verify_row_count(o):
    """Rows before, removed and after, for every purged table of every group; masking keeps all."""
    parts = []
    audit = o.audit_of(REPORT_GROUPS).select(
        "group_code", "target_table", F.col("deleted_row_count").alias("row_count")
    )
    audit = durable(audit.groupBy("group_code", "target_table").agg(F.sum("row_count").alias("row_count")))
    for code in REPORT_GROUPS:
        after = o.purged(code)
        for table in by_table(DELETION.rules_of(code)):
            removed = audit.where((F.col("group_code") == code) & (F.col("target_table") == table))
            counts = reports.row_counts(o.tables[table], after[table], removed)
            parts.append(counts.select(F.lit(code).alias("run"), F.lit(table).alias("table_name"), "*"))
    for table, _, _ in SUBJECTS:
        nothing = o.spark.range(1).select(F.lit(0).cast("bigint").alias("row_count"))
        counts = reports.row_counts(o.pii_tables[table], _all_masked(o, table), nothing)
        parts.append(counts.select(F.lit("MASKING").alias("run"), F.lit(table).alias("table_name"), "*"))
    return union_all(parts)


# -- checks -----------------------------------------------------------------------------


@query()
def chk_unique_collision(o):
    """The constant address collides, the hashed user name does not."""
    rules = [r for r in MASKING.rules if r.column_name in ("address", "username")]
    masked = mask_apply(
        o.pii_tables["customer"], mask_steps(rules[:1]), o.mask_reacher("CUST_PII"), PARAMETERS
    )
    masked = mask_apply(masked, mask_steps(rules[1:]), o.mask_reacher("USER_ANON"), PARAMETERS)
    return checks.unique_collisions(masked, rules, ["address", "username"])


@query()
def chk_column_exists(o):
    rules = [*MASKING.rules, MaskingRule("CUST_PII", "part", "owner", "NULL", KeyPath("p_partkey"))]
    config = type(MASKING)(MASKING.groups, rules)
    tables = {r.target_table: o.pii_tables[r.target_table] for r in rules}
    status = o.spark.createDataFrame(
        checks.column_status(config, tables, {("customer", "phone"): 15}),
        "group_code string, target_table string, column_name string, status string",
    )
    sizes = _left(o.pii_tables, ("customer", "orders", "events", "part"))
    return status.join(
        sizes.select(F.col("table_name").alias("target_table"), F.col("rows_left").alias("rows")),
        "target_table",
    )


@query()
def chk_length(o):
    limits = {"email": 30, "phone": 12, "citizen_id": 20, "full_name": 15, "note": 60, "actor": 16}
    return checks.mask_lengths(o.mask_claims(), limits, PARAMETERS)


@query()
def chk_unmasked_leak(o):
    return checks.unmasked_leaks(o.mask_claims(), PARAMETERS)


@query()
def chk_referenced_column(o):
    """Supplier rules over line columns, against the lines that refer to each other."""
    rules = supplier_rules(o).select(
        "group_code", "target_table",
        F.concat(F.lit("column_"), F.col("execution_order")).alias("column_name"),
        F.when(F.col("execution_order") % 2 == 0, "fn_mask_salted_hash(x)").otherwise("NULL")
        .alias("mask_expression"),
        (F.col("execution_order") != 7).alias("is_active"),
    )
    relations = o.tables["lineitem"].select("l_linenumber", "l_returnflag").distinct().select(
        F.concat(F.lit("returns_"), "l_returnflag").alias("child_table"),
        F.lit("line_ref").alias("child_col"),
        F.concat(F.lit("lines_"), "l_linenumber").alias("parent_table"),
        F.concat(F.lit("column_"), "l_linenumber").alias("parent_col"),
    )
    return checks.referenced_columns(rules, relations)


@query()
def chk_cascade_scope(o):
    """Rules for customers only: their orders, the lines of these and their events are left out."""
    config = DeletionConfig(
        [DELETION.group("CUST_ORDERS")],
        [r for r in DELETION.rules_of("CUST_ORDERS") if r.target_table == "customer"],
    )
    return checks.cascade_scope(
        config, "CUST_ORDERS", overlay.RELATIONS, o.all_keys_reacher("CUST_ORDERS")
    )


@query()
def chk_orphans(o):
    """After a purge of customers and orders that forgot the lines and events."""
    kept = o.purged("CUST_ORDERS").replaced({"lineitem": o.tables["lineitem"]})
    return union_all([checks.orphans(r, kept) for r in overlay.RELATIONS])


@query()
def chk_rule_order(o):
    """A parent purged before its children, with the rows that would be missed."""
    rules = DELETION.rules_of("CUST_ORDERS")
    order = {"lineitem": 3, "orders": 1, "customer": 2}
    turned = [
        type(r)(r.group_code, r.target_table, order[r.target_table], r.path) for r in rules
    ]
    config = DeletionConfig([DELETION.group("CUST_ORDERS")], turned)
    reacher = o.all_keys_reacher("CUST_ORDERS")
    found = o.spark.createDataFrame(
        checks.rule_order_conflicts(config),
        "group_code string, execution_order int, target_table string, earlier_order int, "
        "hop_table string",
    )
    missed = estimate_delete(config.rules_of("CUST_ORDERS"), reacher)
    return found.join(missed, ["group_code", "target_table", "execution_order"])


@query()
def chk_overlap_groups(o):
    return checks.overlapping_groups(supplier_groups(o), supplier_rules(o))


# -- streams -----------------------------------------------------------------------------


@query()
def stream_requests(o):
    requests = o.raw_keys.withColumn(
        "requested_at", F.lit(overlay.STARTED_AT).cast("timestamp")
    )
    folder = _written_csv(o, requests.coalesce(2))
    store = SnapshotStore(o.spark, f"{work_folder(o)}/store")
    store.adopt_all({t: f"{o.sf_dir}/{t}.parquet" for t in PURGED_TABLES})
    stream = read_requests(o.spark, folder, files_per_trigger=1)
    start_intake(
        store, DELETION, stream, BATCH, f"{folder}-checkpoint", overlay.AS_OF
    ).awaitTermination()
    return store.read(erasure.TASKS).select(*TASK)


def _event_stream(o: Overlay) -> DataFrame:
    schema = o.tables["events"].schema
    return o.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(
        o.sf_dir
    )


@query()
def stream_suppress(o):
    out = f"{work_folder(o)}/events"
    erased = o.all_keys_reacher("CUST_EVENTS").values(KeyPath("user_id", "bigint"))
    start_suppression(
        _event_stream(o), F.col("user_id"), lambda: erased, out, f"{out}-checkpoint"
    ).awaitTermination()
    return read_output(o.spark, out)


@query()
def stream_suppress_mask(o):
    out = f"{work_folder(o)}/events"
    erased = o.all_keys_reacher("CUST_EVENTS").values(KeyPath("user_id", "bigint"))
    start_suppression(
        _event_stream(o), F.col("user_id"), lambda: erased, out, f"{out}-checkpoint",
        {"props": masks.mask_null(), "user_id": F.lit(-1)},
    ).awaitTermination()
    return read_output(o.spark, out)


@query(groups=REPORT_GROUPS)
def stream_audit_rate(o):
    folder = work_folder(o)
    o.audit.write.parquet(f"{folder}/audit")
    stream = o.spark.readStream.schema(o.audit.schema).parquet(f"{folder}/audit")
    start_audit_rate(stream, f"{folder}/rates", f"{folder}/checkpoint").awaitTermination()
    return read_rates(o.spark, f"{folder}/rates")
