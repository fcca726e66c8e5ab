"""Column helpers built from Spark's own functions (no Python UDFs).

Each helper that has to agree with the DuckDB oracle also exposes the SQL
text it corresponds to, so both sides compute the same arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: canonical form of a UUID (8-4-4-4-12 hex digits).
UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio_round_half_even(num, den, digits: int = 1, scale: int = 100) -> Column:
    """``round(scale * num / den, digits)`` for integer ``num``/``den``, ties to
    even, computed exactly in integer arithmetic (a double quotient would turn
    some ties into near-ties and the two engines would disagree)."""
    unit = scale * 10 ** digits
    n = _c(num).cast("long") * F.lit(unit)
    d = _c(den).cast("long")
    r = F.pmod(n, d)
    q = ((n - r) / d)  # exact: n - r is a multiple of d
    bump = (F.when(r * 2 > d, 1)
            .when((r * 2 == d) & (F.pmod(q, F.lit(2.0)) == 1.0), 1)
            .otherwise(0))
    return F.when(d > 0, (q + bump) / F.lit(10.0 ** digits))


def ratio_round_half_even_sql(num: str, den: str, digits: int = 1, scale: int = 100) -> str:
    unit = scale * 10 ** digits
    n = f"(CAST({num} AS BIGINT) * {unit})"
    d = f"CAST({den} AS BIGINT)"
    r = f"(({n} % {d} + {d}) % {d})"
    q = f"(({n} - {r}) / {d})"
    return (f"CASE WHEN {d} > 0 THEN ({q} + CASE WHEN {r} * 2 > {d} THEN 1 "
            f"WHEN {r} * 2 = {d} AND {q} % 2.0 = 1.0 THEN 1 ELSE 0 END) / {10.0 ** digits} END")


def canonical_json(**fields) -> Column:
    """JSON object with keys in sorted order, the form a metric key compares by."""
    return F.to_json(F.struct(*[_c(v).alias(k) for k, v in sorted(fields.items())]))


def is_uuid(col) -> Column:
    return _c(col).rlike(UUID_PATTERN)


def stable_hash_id(*cols) -> Column:
    """sha-256 over the fields, each with its length or a mark for NULL in
    front, so different rows never give one string (dedup key)."""
    parts = [F.coalesce(F.concat(F.length(_c(c).cast("string")).cast("string"), F.lit(":"), _c(c).cast("string")), F.lit("-")) for c in cols]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def derived_uuid(*cols) -> Column:
    """A canonical UUID (8-4-4-4-12 hex digits) derived from the fields."""
    return F.regexp_replace(stable_hash_id(*cols).substr(1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
