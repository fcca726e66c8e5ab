"""Request log operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.quantiles import exact_percentiles

# Keys whose values are masked in logged request bodies.
SENSITIVE_KEYS = ("password", "password_hash")
MASK = "***"

#: Nested brackets that a masked value may have; a deeper one masks the whole body.
MASK_DEPTH = 8
_STRING = r'"(?:[^"\\]++|\\.)*+"'


def _value_pattern(depth: int) -> str:
    """A JSON value: string, number or word, or brackets nested ``depth`` deep."""
    inside = rf'[^{{}}\[\]"]++|{_STRING}'
    nested = rf"[{{\[](?:{inside})*+[}}\]]"
    for _ in range(depth - 1):
        nested = rf"[{{\[](?:{inside}|{nested})*+[}}\]]"
    return rf'(?:{_STRING}|[^\s,}}\]"{{\[]++|{nested})'


def masked(body: Column, keys: tuple[str, ...] = SENSITIVE_KEYS) -> Column:
    """A JSON text with the values of ``keys`` replaced at every depth.

    Everything else stays as it is written: numbers, booleans, nulls, arrays,
    nested objects, the order of fields.  A quote right before a key name is
    an opening quote unless a backslash precedes it, so text inside strings is
    never taken for a key.  Bodies with \\u escapes, which could spell a key
    another way, are written out anew by the parser first (fields sorted).  A
    body that does not parse is NULL, and so is one whose masked value is
    nested more than ``MASK_DEPTH`` deep."""
    parsed = F.try_parse_json(body)
    text = F.when(F.instr(body, "\\u") > 0, F.to_json(parsed)).otherwise(body)
    key = rf'(?<!\\)"({"|".join(keys)})"\s*:\s*'
    out = F.regexp_replace(text, key + _value_pattern(MASK_DEPTH), rf'"$1":"{MASK}"')
    left = F.regexp_replace(out, rf'(?<!\\)"({"|".join(keys)})":"{_escaped(MASK)}"', "").rlike(key)
    return F.when(parsed.isNotNull() & ~left, out)


def _escaped(text: str) -> str:
    return "".join("\\" + c for c in text)


def mask_bodies(logs: DataFrame, body: str = "body") -> DataFrame:
    """Each JSON body with its sensitive values masked (``masked``)."""
    return logs.withColumn("masked_body", masked(F.col(body)))


def request_rollup(logs: DataFrame) -> DataFrame:
    """Per endpoint and status: count, status class, mean and exact P95
    duration."""
    g = (logs.groupBy("endpoint", "status_code")
         .agg(F.count(F.lit(1)).alias("requests"), F.avg("duration_ms").alias("avg_ms")))
    p = exact_percentiles(logs, ["endpoint", "status_code"], "duration_ms", {"p95_ms": 0.95})
    return (g.join(p, ["endpoint", "status_code"])
            .withColumn("status_class", F.concat(F.floor(F.col("status_code") / 100).cast("string"), F.lit("xx"))))
