"""Cohort retention.

Cohort of a user = day of the user's first event ever seen (Q8).  One pass
over the events reduces them to the set of days of every user (partial sets
are merged map-side, so a user with millions of events sends one row per
task).  A user's days then become a bitmap of offsets from the first one, and
one group-by per cohort counts users and the bits set: cohort size and
returns come from the same rows, so nothing is joined and the events are
neither read nor shuffled twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.scalars import ratio_round_half_even


def user_days(events: DataFrame) -> DataFrame:
    return events.select("user_id", "event_date").distinct()


def first_day(events: DataFrame) -> DataFrame:
    """user_id -> cohort (first active day)."""
    return events.groupBy("user_id").agg(F.min("event_date").alias("cohort_date"))


def cohort_sizes(events: DataFrame) -> DataFrame:
    """Users per cohort day."""
    return first_day(events).groupBy("cohort_date").agg(F.count(F.lit(1)).alias("cohort_size"))


def activity_bits(events: DataFrame, max_off: int = 7) -> DataFrame:
    """user_id, cohort_date and ``bits``: bit k is set if the user was
    active k days after the cohort day (0 <= k <= max_off <= 62).

    Rows without a user count as one user in the cohort's size (the grouped
    first day has it so) and return on no day; rows without a day are not read."""
    if not 0 <= max_off <= 62:
        raise ValueError("max_off: 0 to 62 (bits of a long)")
    per_user = (events.where(F.col("event_date").isNotNull()).groupBy("user_id")
                .agg(F.collect_set("event_date").alias("days")).withColumn("cohort_date", F.array_min("days")))

    def add(bits: Column, day: Column) -> Column:
        off = F.date_diff(day, F.col("cohort_date"))
        return F.when(off <= max_off, bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), off))).otherwise(bits)

    bits = F.aggregate("days", F.lit(0).cast("long"), add)
    return per_user.select("user_id", "cohort_date", F.when(F.col("user_id").isNotNull(), bits).otherwise(F.lit(0).cast("long")).alias("bits"))


def cohort_counts(events: DataFrame, max_off: int = 7, cohorts=None) -> DataFrame:
    """Per cohort day: cohort_size and n0 .. n<max_off>, the users active on each offset.

    ``cohorts`` restricts the cohort days (U2: the daily job asks for D-1 and
    D-7 in one plan).  Events after the last day that can count for them are
    not read (a partition filter on a stored table); all earlier ones are,
    since they decide who is new."""
    if cohorts is not None:
        days = [F.lit(c).cast("date") for c in cohorts]
        events = events.where(F.col("event_date") <= F.date_add(F.greatest(*days) if len(days) > 1 else days[0], max_off))
    users = activity_bits(events, max_off)
    if cohorts is not None:
        users = users.where(F.col("cohort_date").isin(days))
    return users.groupBy("cohort_date").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        *[F.sum(F.getbit("bits", F.lit(k)).cast("long")).alias(f"n{k}") for k in range(max_off + 1)])


def retention_long(events: DataFrame, max_off: int = 7, cohorts=None) -> DataFrame:
    """Per cohort and offset: cohort total, users returned, fraction.

    ``cohorts`` as in ``cohort_counts``; offsets with no returning user
    produce no row, as in the reference.  No upper bound at the run date (Q7)."""
    c = cohort_counts(events, max_off, cohorts)
    rows = F.array(*[F.struct(F.lit(k).alias("day_offset"), F.col(f"n{k}").alias("returned")) for k in range(max_off + 1)])
    return (c.select("cohort_date", F.col("cohort_size").alias("cohort_total"), F.inline(rows)).where("returned > 0")
            .select("cohort_date", "day_offset", "cohort_total", "returned",
                    (F.col("returned") / F.col("cohort_total")).alias("retention_pct")))


def retention_matrix(events: DataFrame, max_off: int = 7, newest: int = 30) -> DataFrame:
    """One row per cohort, Day 0..Day max_off as percentages rounded
    to one decimal (ties to even), newest ``newest`` cohorts."""
    c = cohort_counts(events, max_off).where("n0 > 0")
    return (c.select(F.col("cohort_date").cast("string").alias("cohort_date"), "cohort_size",
                     *[ratio_round_half_even(F.col(f"n{k}"), F.col("cohort_size"), 1).alias(f"day_{k}")
                       for k in range(max_off + 1)])
            .orderBy(F.desc("cohort_date")).limit(newest))


def retention_by_run(events: DataFrame, back=(1, 7), max_off: int = 7) -> DataFrame:
    """A21/U2 for every day with events: run_date and the retention rows of the
    cohorts ``back`` days before it, from one pass.  A cohort's rows go to its
    run days; the list of run days is one row per day of the table."""
    runs = events.select(F.col("event_date").alias("run_date")).where("run_date IS NOT NULL").distinct()
    asked = runs.select("run_date", F.explode(F.array(*[F.date_sub("run_date", b) for b in back])).alias("cohort_date"))
    return retention_long(events, max_off).join(asked, "cohort_date")
