"""Groups, rules and key files laid over the sample star schema."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
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
    small_frame,
)
from lethe.operators.numbering import assign_chunks
from lethe.operators.purge import by_table, survivors
from lethe.operators.reach import Reacher, prepare_together
from lethe.operators.sizing import Measured, durable, sized_groups
from lethe.operators.tally import Claim, tallied_audit, tallied_estimates
from lethe.operators.tasks import (
    COMPLETED,
    FAILED,
    VALIDATED,
    expand_tasks,
    validate_first,
    validate_root,
)
from lethe.plans.erasure import prepared_claims
from lethe.session import prepare
from lethe.sources.keyfile import keys_of, new_items

BATCH = "BATCH-2025"
INGESTED_AT = "2025-01-01 00:00:00"
STARTED_AT = "2025-02-01 00:00:00"
SECONDS_PER_CHUNK = 20
AS_OF = "2005-01-01"  # orders older than seven years before it: until 1997
SALT = "OVERLAY_SALT"

# personal data derived from the customer's own columns; plain SQL of any dialect
CUSTOMER_PII = {
    "email": """CASE c_custkey % 11
        WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'no at sign' WHEN 3 THEN '@lead.com'
        WHEN 4 THEN 'a@b' WHEN 5 THEN 'ab@cd.org' WHEN 6 THEN 'x.y@.com'
        ELSE 'user.' || CAST(c_custkey AS STRING) || '@enterprise.co.th' END""",
    "phone": """CASE c_custkey % 7
        WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '555-12'
        WHEN 3 THEN '02-' || lpad(CAST(c_custkey AS STRING), 7, '0')
        WHEN 4 THEN '+66 81 ' || lpad(CAST(c_custkey AS STRING), 7, '0')
        WHEN 5 THEN lpad(CAST(c_custkey AS STRING), 7, '0')
        ELSE '08' || lpad(CAST(c_custkey AS STRING), 8, '0') END""",
    "citizen_id": """CASE c_custkey % 5
        WHEN 0 THEN '11005001' || lpad(CAST(c_custkey AS STRING), 5, '0')
        WHEN 1 THEN '1-1005-' || lpad(CAST(c_custkey AS STRING), 5, '0') || '-12-3'
        WHEN 2 THEN 'AB' WHEN 3 THEN NULL ELSE '' END""",
    "card": """CASE c_custkey % 3
        WHEN 0 THEN '4111-1111-' || lpad(CAST(c_custkey AS STRING), 4, '0') || '-1234'
        WHEN 1 THEN '411111111' || lpad(CAST(c_custkey AS STRING), 7, '0')
        ELSE '4111' END""",
    "full_name": """CASE c_custkey % 4
        WHEN 0 THEN c_name
        WHEN 1 THEN '  ' || c_mktsegment || '  ' || c_name || ' '
        WHEN 2 THEN 'A ' || c_mktsegment
        ELSE c_mktsegment || ' X Bo' END""",
    "username": "lower(replace(c_name, '#', '_'))",
    "address": "CAST(c_custkey AS STRING) || ' Main Road, ' || c_mktsegment",
    "payload": """'{"tier": "' || c_mktsegment || '", "visits": ' || CAST(c_nationkey AS STRING)
        || ', "cvv": "' || lpad(CAST(c_nationkey AS STRING), 3, '0') || '"}'""",
}
ORDERS_PII = {
    "contact": "'user.' || CAST(o_custkey AS STRING) || '@enterprise.co.th'",
    "note": "'call 08' || lpad(CAST(o_orderkey AS STRING), 8, '0') || ' re ' || o_orderpriority",
}
EVENTS_PII = {
    "actor": "'customer_' || lpad(CAST(user_id AS STRING), 9, '0')",
}

PII = {"customer": CUSTOMER_PII, "orders": ORDERS_PII, "events": EVENTS_PII}

_order = Hop("l_orderkey", "orders", "o_orderkey")
_customer = Hop("o_custkey", "customer", "c_custkey")
AGED = "o_orderdate < add_months({as_of}, -84)"

DELETION = DeletionConfig(
    [
        Group("CUST_EVENTS", "CUSTOMER_ID", "events of a customer", 50),
        Group("CUST_ORDERS", "CUSTOMER_ID", "a customer with orders and lines", 50),
        Group("NATION_PURGE", "NATION", "all business of a nation", 2),
        Group("ORDERS", "ORDER_NO", "orders with their lines", 500),
        Group("ORDERS_AGED", "ORDER_NO", "the same, aged orders only", 500, is_active=False),
        Group("SESSIONS", "SESSION", "flat telemetry", 2000),
    ],
    [
        DeletionRule("CUST_ORDERS", "lineitem", 1, KeyPath("o_custkey", "bigint", (_order,))),
        DeletionRule("CUST_ORDERS", "orders", 2, KeyPath("o_custkey", "bigint")),
        DeletionRule("CUST_ORDERS", "customer", 3, KeyPath("c_custkey", "bigint")),
        DeletionRule("CUST_EVENTS", "events", 1, KeyPath("user_id", "bigint")),
        DeletionRule(
            "NATION_PURGE", "lineitem", 1, KeyPath("c_nationkey", "int", (_order, _customer))
        ),
        DeletionRule("NATION_PURGE", "orders", 2, KeyPath("c_nationkey", "int", (_customer,))),
        DeletionRule("NATION_PURGE", "customer", 3, KeyPath("c_nationkey", "int")),
        DeletionRule("NATION_PURGE", "supplier", 4, KeyPath("s_nationkey", "int")),
        DeletionRule("NATION_PURGE", "nation", 5, KeyPath("n_nationkey", "int")),
        DeletionRule("ORDERS", "lineitem", 1, KeyPath("l_orderkey", "bigint")),
        DeletionRule("ORDERS", "orders", 2, KeyPath("o_orderkey", "bigint")),
        DeletionRule("ORDERS_AGED", "lineitem", 1, KeyPath("l_orderkey", "bigint")),
        DeletionRule("ORDERS_AGED", "orders", 2, KeyPath("o_orderkey", "bigint", where=AGED)),
        DeletionRule("SESSIONS", "events", 1, KeyPath("user_id", "bigint")),
    ],
)

_by_customer = KeyPath("c_custkey", "bigint")
MASKING = MaskingConfig(
    [
        Group("CUST_PII", "CUSTOMER_ID", "customer master and orders", 50),
        Group("USER_ANON", "CUSTOMER_ID", "user names in two tables", 100),
    ],
    [
        MaskingRule("CUST_PII", "customer", "email", "fn_mask_email(email)", _by_customer),
        MaskingRule("CUST_PII", "customer", "phone", "fn_mask_phone(phone)", _by_customer),
        MaskingRule(
            "CUST_PII", "customer", "citizen_id", "fn_mask_citizen_id(citizen_id)", _by_customer
        ),
        MaskingRule("CUST_PII", "customer", "full_name", "fn_mask_name(full_name)", _by_customer),
        MaskingRule("CUST_PII", "customer", "address", "'CONFIDENTIAL_ADDRESS'", _by_customer),
        MaskingRule(
            "CUST_PII", "customer", "payload", "NULL", _by_customer, is_active=False
        ),
        MaskingRule(
            "CUST_PII", "orders", "contact", "fn_mask_email(contact)",
            KeyPath("o_custkey", "bigint"), 2,
        ),
        MaskingRule(
            "CUST_PII", "orders", "note", "regexp_replace(note, '[0-9]{10,13}', '[REDACTED_ID]')",
            KeyPath("o_custkey", "bigint"), 2,
        ),
        MaskingRule(
            "USER_ANON", "customer", "username", "fn_mask_salted_hash(username, :salt)",
            _by_customer,
        ),
        # keys reach customers, and those their events by user name
        MaskingRule(
            "USER_ANON", "events", "actor", "fn_mask_salted_hash(actor, :salt)",
            KeyPath("c_custkey", "bigint", (Hop("actor", "customer", "username"),)), 2,
        ),
    ],
)

RELATIONS = [
    Relation("orders", "o_custkey", "customer", "c_custkey", True),
    Relation("lineitem", "l_orderkey", "orders", "o_orderkey", True),
    Relation("events", "user_id", "customer", "c_custkey"),
    Relation("customer", "c_nationkey", "nation", "n_nationkey"),
    Relation("supplier", "s_nationkey", "nation", "n_nationkey"),
]

REPORT_GROUPS = ("CUST_EVENTS", "CUST_ORDERS", "NATION_PURGE", "ORDERS", "SESSIONS")
# in the reports one chunk of ORDERS failed and the rest of it stays validated
RUN_GROUPS = ("CUST_EVENTS", "CUST_ORDERS", "NATION_PURGE", "SESSIONS")

# keys of the file that are not in any table
STRAY_KEYS = (
    ("CUSTOMER_ID", "DUMMY-99901"),
    ("CUSTOMER_ID", "DUMMY-99902"),
    ("CUSTOMER_ID", "007"),
    ("CUSTOMER_ID", ""),
    ("CUSTOMER_ID", "   "),
    ("CUSTOMER_ID", "NA"),
    ("CUSTOMER_ID", None),
    ("ORDER_NO", "DUMMY-99901"),
    ("SESSION", "\u00a0DUMMY-99903\u3000"),
)


class LazyTables(dict):
    """Tables by name, opened when first asked for."""

    def __init__(self, open_table: Callable[[str], DataFrame], known: dict | None = None):
        super().__init__(known or {})
        self._open = open_table

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._open(name)
        return self[name]

    def replaced(self, known: dict[str, DataFrame]) -> LazyTables:
        return LazyTables(self.__getitem__, known)


class Overlay:
    """Frames of one batch over the tables of a directory, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, groups: tuple[str, ...] | None = None):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.group_codes = groups

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def tables(self) -> LazyTables:
        return LazyTables(self.table)

    @cached_property
    def pii_tables(self) -> LazyTables:
        def extended(name: str) -> DataFrame:
            columns = [F.expr(sql).alias(c) for c, sql in PII.get(name, {}).items()]
            return self.tables[name].select("*", *columns)

        return LazyTables(extended)

    # -- deletion --------------------------------------------------------

    @cached_property
    def raw_keys(self) -> DataFrame:
        """The key file: closed accounts, urgent open orders, one region, one segment."""
        t = self.tables
        in_debt = t["customer"].where("c_acctbal < 0").select(F.col("c_custkey").cast("string"))
        padded = in_debt.select(F.concat(F.lit("  "), "c_custkey", F.lit(" ")))
        urgent = t["orders"].where("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
        region = t["nation"].where("n_regionkey = 3")
        segment = t["customer"].where("c_mktsegment = 'BUILDING'")
        stray = small_frame(self.spark, list(STRAY_KEYS), "key_type string, key_no string")
        parts = [
            ("CUSTOMER_ID", in_debt),
            ("CUSTOMER_ID", padded),
            ("ORDER_NO", urgent.select(F.col("o_orderkey").cast("string"))),
            ("NATION", region.select(F.col("n_nationkey").cast("string"))),
            ("SESSION", segment.select(F.col("c_custkey").cast("string"))),
        ]
        for key_type, keys in parts:
            stray = stray.union(keys.select(F.lit(key_type), "*"))
        return stray

    @cached_property
    def items(self) -> DataFrame:
        at = F.lit(INGESTED_AT).cast("timestamp")
        return durable(new_items(keys_of(self.raw_keys), None, BATCH, at))

    @cached_property
    def groups(self) -> DataFrame:
        frame = DELETION.groups_frame(self.spark)
        if self.group_codes:
            frame = frame.where(F.col("group_code").isin(*self.group_codes))
        return frame

    @cached_property
    def rules(self) -> DataFrame:
        frame = DELETION.rules_frame(self.spark)
        if self.group_codes:
            frame = frame.where(F.col("group_code").isin(*self.group_codes))
        return frame

    @cached_property
    def pending(self) -> DataFrame:
        return durable(expand_tasks(self.items, self.groups))

    @cached_property
    def tasks(self) -> DataFrame:
        """Validated tasks."""
        codes = list(self.group_codes) if self.group_codes else [
            g.group_code for g in DELETION.active_groups()
        ]
        return durable(validate_root(self.pending, DELETION, self.tables, codes, AS_OF))

    @cached_property
    def chunked(self) -> DataFrame:
        """VALIDATED tasks with their chunk."""
        valid = self.tasks.where(F.col("status") == VALIDATED)
        return durable(assign_chunks(valid, self.groups))

    @cached_property
    def chunked_keys(self) -> dict[str, Measured]:
        codes = list(self.group_codes or [g.group_code for g in DELETION.active_groups()])
        keys = self.chunked.select("group_code", "key_no", "chunk_no")
        return sized_groups(keys, "group_code", codes)

    @cached_property
    def reachers(self) -> dict[str, Reacher]:
        return {c: Reacher.over(k, self.tables, AS_OF) for c, k in self.chunked_keys.items()}

    def reacher(self, group_code: str) -> Reacher:
        return self.reachers[group_code]

    def all_keys_reacher(self, group_code: str) -> Reacher:
        """All keys of a group's key type in one chunk, as a dry run uses them."""
        key_type = DELETION.group(group_code).key_type
        keys = self.items.where(F.col("key_type") == key_type)
        return Reacher(keys.select("key_no", F.lit(1).alias("chunk_no")), self.tables, AS_OF)

    def chunk_time(self, chunk) -> Column:
        seconds = (chunk * SECONDS_PER_CHUNK).cast("int")
        return F.lit(STARTED_AT).cast("timestamp") + F.make_dt_interval(secs=seconds)

    @cached_property
    def summary(self) -> DataFrame:
        estimates = tallied_estimates(self.claims(tuple(sorted(self.group_codes))))
        return durable(
            estimates.select(
                F.lit(BATCH).alias("batch_id"), "*",
                F.lit(INGESTED_AT).cast("timestamp").alias("executed_at"),
            )
        )

    def claims(self, codes: tuple[str, ...]) -> list[Claim]:
        return prepared_claims(DELETION, {c: self.reacher(c) for c in codes})

    @cached_property
    def audit(self) -> DataFrame:
        """Audit of the groups that ran, with a fixed clock."""
        return durable(
            self.audit_of(RUN_GROUPS).select(
                F.lit(BATCH).alias("batch_id"), "*",
                self.chunk_time(F.col("chunk_no") - 1).alias("started_at"),
                self.chunk_time(F.col("chunk_no")).alias("executed_at"),
            )
        )

    def audit_of(self, codes: tuple[str, ...]) -> DataFrame:
        return tallied_audit(self.claims(codes))

    @cached_property
    def finished(self) -> DataFrame:
        """Tasks after the run: four groups completed, one chunk of the fifth failed."""
        chunks = self.chunked.select("group_code", "key_no", "chunk_no")
        ran = F.col("group_code").isin(*RUN_GROUPS) & F.col("chunk_no").isNotNull()
        failed = (F.col("group_code") == "ORDERS") & (F.col("chunk_no") == 2)
        return (
            self.tasks.join(chunks, ["group_code", "key_no"], "left")
            .withColumns(
                {
                    "status": F.when(ran, F.lit(COMPLETED)).when(failed, F.lit(FAILED)).otherwise(
                        F.col("status")
                    ),
                    "error_message": F.when(failed, F.lit("chunk 2 was aborted")),
                    "processed_at": F.when(ran | failed, self.chunk_time(F.col("chunk_no"))),
                }
            )
            .drop("chunk_no")
            .select(*self.tasks.columns)
        )

    def purged(self, group_code: str, up_to: int | None = None) -> LazyTables:
        """All tables after one group's purge."""
        reacher = self.reacher(group_code)
        members = by_table(DELETION.rules_of(group_code, up_to))
        return self.tables.replaced({n: survivors(r, reacher) for n, r in members.items()})

    # -- masking ---------------------------------------------------------

    @cached_property
    def mask_groups(self) -> DataFrame:
        return MASKING.groups_frame(self.spark)

    @cached_property
    def mask_pending(self) -> DataFrame:
        return durable(expand_tasks(self.items, self.mask_groups))

    @cached_property
    def mask_tasks(self) -> DataFrame:
        return durable(validate_first(self.mask_pending, MASKING, self.pii_tables))

    @cached_property
    def mask_chunked(self) -> DataFrame:
        valid = self.mask_tasks.where(F.col("status") == VALIDATED)
        return durable(assign_chunks(valid, self.mask_groups))

    @cached_property
    def mask_keys(self) -> dict[str, Measured]:
        keys = self.mask_chunked.select("group_code", "key_no", "chunk_no")
        return sized_groups(keys, "group_code", [g.group_code for g in MASKING.groups])

    @cached_property
    def mask_reachers(self) -> dict[str, Reacher]:
        return {c: Reacher.over(k, self.pii_tables) for c, k in self.mask_keys.items()}

    def mask_claims(self, max_order: int | None = None) -> list[tuple[MaskingRule, Reacher]]:
        """The active mask rules of all groups with the values their keys reach."""
        claims = []
        for group in MASKING.active_groups():
            rules = MASKING.rules_of(group.group_code, max_order)
            claims += [(r, self.mask_reacher(group.group_code)) for r in rules]
        prepare_together([(reacher, r.path) for r, reacher in claims])
        return claims

    def mask_reacher(self, group_code: str) -> Reacher:
        return self.mask_reachers[group_code]
