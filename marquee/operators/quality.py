"""Validation and data-quality operators.

Rules are column expressions evaluated in one projection; rejected rows keep
the list of failed rules (``array_compact`` over ``when`` branches), so the
quarantine table says why each row was refused.  Uniqueness and referential
checks are a group-by and a ``left_anti`` join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.scalars import derived_uuid, is_uuid
from marquee.sources.adapters import DEVICE_TYPES, EVENT_TYPES

EVENT_COLUMNS = ("event_id", "user_id", "movie_id", "event_type", "event_time", "event_date",
                 "device_type", "session_id", "progress_seconds")


def _nonempty(c: str) -> Column:
    return F.col(c).isNotNull() & (F.length(F.col(c).cast("string")) >= 1)


def event_rules() -> list[tuple[str, Column]]:
    """V1: (reason, passes) pairs of the event schema."""
    return [
        ("bad_event_id", is_uuid("event_id")),
        ("bad_event_type", F.col("event_type").isin(*EVENT_TYPES)),
        ("bad_device_type", F.col("device_type").isin(*DEVICE_TYPES)),
        ("empty_user_id", _nonempty("user_id")),
        ("empty_movie_id", _nonempty("movie_id")),
        ("empty_session_id", _nonempty("session_id")),
        ("negative_progress", F.col("progress_seconds").isNull() | (F.col("progress_seconds") >= 0)),
    ]


def apply_rules(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Add ``reasons`` (array of failed rule names) and ``valid``."""
    fails = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))
                                      for name, ok in rules]))
    return df.withColumn("reasons", fails).withColumn("valid", F.size("reasons") == 0)


def validate_events(events: DataFrame) -> DataFrame:
    """V1: ``reasons`` and ``valid``.  A row that did not parse (``unparsable``) fails for
    that alone: its fields are not what was sent."""
    checked = apply_rules(events, event_rules())
    if "unparsable" not in events.columns:
        return checked
    return (checked.withColumn("reasons", F.when(F.col("unparsable"), F.array(F.lit("unparsable"))).otherwise(F.col("reasons")))
            .withColumn("valid", F.col("valid") & ~F.col("unparsable")).drop("unparsable"))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows without the rule columns, quarantined rows with reasons)."""
    ok = df.where("valid").drop("valid", "reasons", "payload")
    bad = df.where("NOT valid").drop("valid")
    return ok, bad


def fill_defaults(raw: DataFrame, id_from=("user_id", "movie_id", "event_type", "timestamp", "device_type",
                                            "session_id", "progress_seconds"), clock: Column | None = None) -> DataFrame:
    """V2 over the wire form (``timestamp`` = epoch millis): an empty or
    missing id and a zero or missing time count as absent (Q12).  A missing
    id is derived from the row's fields, so a replayed batch produces the
    same id (a random UUID would not).  A missing time takes the ingest
    clock (``clock``, a timestamp; the current time if not given)."""
    eid = F.coalesce(F.nullif(F.col("event_id"), F.lit("")), derived_uuid(*id_from))
    ts = F.coalesce(F.nullif(F.col("timestamp"), F.lit(0)),
                    F.unix_millis(clock if clock is not None else F.current_timestamp()))
    return raw.withColumn("event_id", eid).withColumn("timestamp", ts)


def normalise_raw(raw: DataFrame, ingest_time: bool = True, clock: Column | None = None) -> DataFrame:
    """P1 (+P2): wire form -> stored form: millis to UTC timestamp, derived
    day, raw time dropped, ingest stamp added."""
    out = (fill_defaults(raw, clock=clock)
           .withColumn("event_time", F.timestamp_millis("timestamp"))
           .withColumn("event_date", F.to_date("event_time"))
           .drop("timestamp"))
    if ingest_time:
        out = out.withColumn("ingested_at", F.current_timestamp())
    return out


def normalise(events: DataFrame) -> DataFrame:
    """P1 over an already typed event view: the stored column order."""
    return events.select(*EVENT_COLUMNS)


# ---------------------------------------------------------------------------
# Commerce and flight rules
# ---------------------------------------------------------------------------

# Status domains and the promo code pattern of the marketplace.
PRODUCT_STATUSES = ("ACTIVE", "INACTIVE", "ARCHIVED")
PROMO_PATTERN = r"^[A-Z0-9_]{4,20}$"


def product_rules() -> list[tuple[str, Column]]:
    """V3: catalogue constraints."""
    return [
        ("name_length", F.length("name").between(1, 255)),
        ("description_length", F.col("description").isNull() | (F.length("description") <= 4000)),
        ("price_min", F.col("price") >= F.lit(0.01).cast("decimal(12,2)")),
        ("stock_nonnegative", F.col("stock") >= 0),
        ("category_length", F.length("category").between(1, 100)),
        ("status_domain", F.col("status").isin(*PRODUCT_STATUSES)),
    ]


def rule_counts(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """One pass: rows failing each rule, as (rule, failed) rows."""
    aggs = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules]
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    stack = ", ".join(f"'{n}', `{n}`" for n, _ in rules)
    return wide.selectExpr(f"stack({len(rules)}, {stack}) AS (rule, failed)", "rows")


def seat_rules() -> list[tuple[str, Column]]:
    """V9: flight seat constraints."""
    return [
        ("total_positive", F.col("total_seats") > 0),
        ("available_in_range", F.col("available_seats").between(0, F.col("total_seats"))),
        ("price_positive", F.col("ticket_price") > 0),
    ]


def reservation_rules() -> list[tuple[str, Column]]:
    """V9: a reservation holds at least one seat and names its booking."""
    return [("seats_held_positive", F.col("seats_held") > 0), ("has_booking_ref", _nonempty("booking_ref"))]


def order_request_rules(orders: DataFrame, items: DataFrame) -> DataFrame:
    """V4: 1..50 items, quantities 1..999, promo code pattern: order_id,
    promo_code, n_items and the rules broken.  The items are counted and
    bounded by partial aggregates; their list is never put together."""
    q = F.col("quantity")
    per = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"), F.bool_or(q.isNull() | ~q.between(1, 999)).alias("odd"))
    j = (orders.select("order_id", "promo_code").join(per, "order_id", "left")
         .withColumn("n_items", F.coalesce("n_items", F.lit(0).cast("long"))))
    rules = [("items_count", F.col("n_items").between(1, 50)), ("quantity_range", ~F.coalesce("odd", F.lit(False))),
             ("promo_pattern", F.col("promo_code").isNull() | F.col("promo_code").rlike(PROMO_PATTERN))]
    return apply_rules(j, rules).select("order_id", "promo_code", "n_items", "reasons")


def promo_window_ok(df: DataFrame) -> DataFrame:
    """V5: a promo must end after it starts."""
    return df.withColumn("window_ok", F.col("valid_until") > F.col("valid_from"))


def line_total(df: DataFrame, qty: str = "quantity", price: str = "price") -> DataFrame:
    """V6: positive quantity, line total = round(quantity * price, 2)."""
    return (df.withColumn("quantity_ok", F.col(qty) > 0)
            .withColumn("total", F.round(F.col(qty).cast("decimal(10,0)") * F.col(price), 2)))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """V7: keys present more than once, with their multiplicity."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """V8: child rows whose key has no parent (null keys are not orphans)."""
    p = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(p, child_key, "left_anti")


def uuid_check(df: DataFrame, col: str) -> DataFrame:
    """Canonical UUID form."""
    return df.withColumn(f"{col}_is_uuid", is_uuid(col))
