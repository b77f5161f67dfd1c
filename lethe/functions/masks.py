"""Masking functions as Spark SQL functions, and their column forms.

Each function is a temporary SQL function, so configuration text can call it
by name and Catalyst inlines its body: there is no Python in the row path.
NULL stays NULL and, but for the salted hash, the empty string stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# These must equal the established masking formats.
DEFAULT_SALT = "MASKING_SALT_2026"
HASH_PREFIX = "MSK_"
HASH_DIGITS = 12
EMAIL_UNREADABLE = "***@***.***"
PHONE_UNREADABLE = "XXX-XXXX"
CARD_UNREADABLE = "XXXX-XXXX"

_DIGITS = "regexp_replace(val, '[^0-9]', '')"
_DIALLED = "regexp_replace(val, '[^0-9+]', '')"
_USER = "substr(val, 1, instr(val, '@') - 1)"
_DOMAIN = "substr(val, instr(val, '@') + 1)"

# signature -> (return type, body)
_FUNCTIONS = {
    "fn_mask_email(val STRING)": (
        "STRING",
        f"""CASE
            WHEN val = '' THEN val
            WHEN instr(val, '@') <= 1 THEN '{EMAIL_UNREADABLE}'
            ELSE concat(
                left(val, 1), '***',
                CASE WHEN instr(val, '@') > 3 THEN right({_USER}, 1) ELSE '' END,
                '@',
                CASE
                    WHEN instr({_DOMAIN}, '.') > 3
                        THEN concat(left({_DOMAIN}, 1), '******',
                                    substr({_DOMAIN}, instr({_DOMAIN}, '.')))
                    WHEN instr({_DOMAIN}, '.') > 1
                        THEN concat(left({_DOMAIN}, 1), '***',
                                    substr({_DOMAIN}, instr({_DOMAIN}, '.')))
                    ELSE '******.com'
                END)
            END""",
    ),
    # conditions start with the cleaned text so it is computed once per row
    "fn_mask_phone(val STRING)": (
        "STRING",
        f"""CASE
            WHEN length({_DIALLED}) < 7 THEN if(val = '', val, '{PHONE_UNREADABLE}')
            WHEN length({_DIALLED}) = 10
                THEN concat(left({_DIALLED}, 3), '-XXX-', right({_DIALLED}, 4))
            WHEN length({_DIALLED}) = 9
                THEN concat(left({_DIALLED}, 2), '-XXX-', right({_DIALLED}, 4))
            ELSE concat(left({_DIALLED}, 3), '-XXXX-', right({_DIALLED}, 4))
            END""",
    ),
    "fn_mask_citizen_id(val STRING)": (
        "STRING",
        f"""CASE
            WHEN length({_DIGITS}) = 13
                THEN concat(left({_DIGITS}, 1), '-', substr({_DIGITS}, 2, 4), '-XXXXX-',
                            substr({_DIGITS}, 11, 2))
            WHEN val = '' THEN val
            ELSE concat(left({_DIGITS}, 2), 'XXXXXXX', right({_DIGITS}, 2))
            END""",
    ),
    "fn_mask_credit_card(val STRING)": (
        "STRING",
        f"""CASE
            WHEN length({_DIGITS}) >= 12 THEN concat('XXXX-XXXX-XXXX-', right({_DIGITS}, 4))
            WHEN val IS NULL OR val = '' THEN val
            ELSE '{CARD_UNREADABLE}'
            END""",
    ),
    # stars behind each initial, then at least three of them, then single blanks;
    # regular expressions because higher-order functions leave generated code
    "fn_mask_name(val STRING)": (
        "STRING",
        r"""regexp_replace(
                regexp_replace(
                    regexp_replace(trim(val), '(?<=[^ ])[^ ]', '*'),
                    '(?<=^| )([^ ])[*]{0,2}(?= |\\z)', '$1***'),
                ' +', ' ')""",
    ),
    f"fn_mask_salted_hash(val STRING, salt STRING DEFAULT '{DEFAULT_SALT}')": (
        "STRING",
        f"""concat('{HASH_PREFIX}',
                   left(sha2(concat(val, coalesce(salt, '')), 256), {HASH_DIGITS}))""",
    ),
    "fn_mask_partial(val STRING, keep_start INT DEFAULT 2, keep_end INT DEFAULT 2, "
    "mask_char STRING DEFAULT '*')": (
        "STRING",
        """CASE
            WHEN length(val) <= keep_start + keep_end THEN repeat(mask_char, length(val))
            ELSE concat(left(val, keep_start),
                        repeat(mask_char, length(val) - keep_start - keep_end),
                        right(val, keep_end))
            END""",
    ),
    # the shift depends on the UTC wall clock, so not on the session's time zone
    "fn_mask_date_shift(val TIMESTAMP, min_days INT DEFAULT -30, max_days INT DEFAULT 30)": (
        "TIMESTAMP",
        """val + make_dt_interval(CAST(min_days + fn_stable_bucket(
                CAST(TIMESTAMP_NTZ'1970-01-01 00:00:00'
                     + make_dt_interval(0, 0, 0, unix_seconds(val)) AS STRING),
                max_days - min_days + 1) AS INT))""",
    ),
}

# deterministic number in [0, buckets) for a text, the same on every engine
_BUCKET = (
    "fn_stable_bucket(val STRING, buckets INT)",
    "BIGINT",
    "CAST(conv(substr(md5(val), 1, 8), 16, 10) AS BIGINT) % buckets",
)


def register_mask_functions(spark: SparkSession) -> None:
    signature, returns, body = _BUCKET
    statements = [(signature, returns, body)]
    statements += [(s, r, b) for s, (r, b) in _FUNCTIONS.items()]
    for signature, returns, body in statements:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {returns} RETURN {body}"
        )


def _text(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def stable_bucket(col: Column | str, buckets: int) -> Column:
    return F.call_function("fn_stable_bucket", _text(col), F.lit(buckets))


def mask_email(col: Column | str) -> Column:
    return F.call_function("fn_mask_email", _text(col))


def mask_phone(col: Column | str) -> Column:
    return F.call_function("fn_mask_phone", _text(col))


def mask_citizen_id(col: Column | str) -> Column:
    return F.call_function("fn_mask_citizen_id", _text(col))


def mask_credit_card(col: Column | str) -> Column:
    return F.call_function("fn_mask_credit_card", _text(col))


def mask_name(col: Column | str) -> Column:
    return F.call_function("fn_mask_name", _text(col))


def mask_salted_hash(col: Column | str, salt: str | None = DEFAULT_SALT) -> Column:
    return F.call_function("fn_mask_salted_hash", _text(col), F.lit(salt).cast("string"))


def mask_partial(
    col: Column | str, keep_start: int = 2, keep_end: int = 2, mask_char: str = "*"
) -> Column:
    return F.call_function(
        "fn_mask_partial", _text(col), F.lit(keep_start), F.lit(keep_end), F.lit(mask_char)
    )


def mask_date_shift(col: Column | str, min_days: int = -30, max_days: int = 30) -> Column:
    value = F.col(col) if isinstance(col, str) else col
    return F.call_function(
        "fn_mask_date_shift", value.cast("timestamp"), F.lit(min_days), F.lit(max_days)
    )


def mask_static(value: str) -> Column:
    return F.lit(value)


def mask_null(data_type: str = "string") -> Column:
    return F.lit(None).cast(data_type)


def mask_sequential(prefix: str, col: Column | str, width: int = 6) -> Column:
    """Prefix and zero-padded id; ids longer than ``width`` are cut, as lpad does."""
    return F.concat(F.lit(prefix), F.lpad(_text(col), width, "0"))


def mask_unique_alias(
    col: Column | str, prefix: str = "user_", suffix: str = "@masked.internal"
) -> Column:
    return F.concat(F.lit(prefix), _text(col), F.lit(suffix))


def mask_numeric_noise(
    col: Column | str, seed: Column | str, low_percent: int = 85, spread: int = 30,
    scale: int = -2,
) -> Column:
    """``value * (low + bucket)/100`` rounded, with a bucket fixed by ``seed``."""
    value = (F.col(col) if isinstance(col, str) else col).cast("decimal(18,2)")
    percent = (F.lit(low_percent) + stable_bucket(seed, spread)).cast("decimal(5,0)")
    return F.round(value * percent / F.lit(100).cast("decimal(3,0)"), scale).cast(
        "decimal(18,2)"
    )


def mask_json_merge(col: Column | str, fields: dict[str, str]) -> Column:
    """Override or add top-level fields of a JSON object; the rest keeps its types.

    Of text that is not a JSON object nothing can be told apart, so nothing is kept.
    """
    payload = F.expr("map()").cast("map<string,variant>")
    parsed = F.try_variant_get(F.try_parse_json(_text(col)), "$", "map<string,variant>")
    payload = F.coalesce(parsed, payload)
    kept = F.map_filter(payload, lambda k, _: ~k.isin(*fields))
    added = F.create_map(
        *[x for k, v in fields.items() for x in (F.lit(k), F.parse_json(F.lit(v)))]
    )
    merged = F.to_json(F.map_concat(kept, added))
    return F.when(F.isnotnull(col), merged)


def mask_regex_redact(
    col: Column | str, pattern: str = "[0-9]{10,13}", replacement: str = "[REDACTED_ID]"
) -> Column:
    return F.regexp_replace(_text(col), pattern, replacement)
