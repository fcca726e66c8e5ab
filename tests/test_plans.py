"""Plan shape: pruning, partial aggregation, pushed-down limits, no sort
aggregates on hot paths, partition pruning on the stored raw table."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from marquee.operators import metrics as M
from marquee.sources.adapters import view
from marquee.streaming.ingest import write_raw_batch


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dau_prunes_columns_and_aggregates_map_side(spark):
    p = plan(E.queries()["dau_daily"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in p
    assert "partial_count" in p


def test_top_n_limit_runs_before_shuffle(spark):
    p = plan(E.queries()["top_movies_daily"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_pricing_stays_hash_aggregate(spark):
    for q in ("order_pricing", "stock_verdict"):
        p = plan(E.queries()[q](spark, SF_SMALL))
        assert "SortAggregate" not in p


def test_retention_is_one_scan_and_two_shuffles(spark):
    for q in ("retention_long", "retention_matrix"):
        p = plan(E.queries()[q](spark, SF_SMALL))
        assert p.count("Scan parquet") == 1 and "Join" not in p
        assert len(re.findall(r"Exchange (hash|range|single)", p)) <= 2, p


def test_seat_admission_has_one_sorted_pass(spark):
    p = plan(E.queries()["seat_admission"](spark, SF_SMALL))
    assert p.count("MapInArrow") == 1 and "FlatMapGroups" not in p and p.count("Scan parquet") == 2


def test_ordered_operators_do_not_join_a_table_with_itself(spark):
    """Each given table is read once to be dealt by ranges; what follows joins with tables of one row per range, by broadcast."""
    for q in ("stock_ledger", "provider_health", "status_transitions", "bookings_newest", "campaign_batches"):
        p = plan(E.queries()[q](spark, SF_SMALL))
        assert all("ranges-" in x or "part.parquet" in x for x in re.findall(r"Location: .*", p)), (q, p)


def test_promo_ranks_are_cut_before_the_shuffle(spark):
    p = plan(E.queries()["order_pricing"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_day_filter_prunes_partitions(spark, tmp_root):
    write_raw_batch(view(spark, SF_SMALL, "movie_events"), f"{tmp_root}/raw")
    raw = spark.read.parquet(f"{tmp_root}/raw")
    p = plan(M.dau_daily(M.for_dates(raw, ["2024-01-05"])))
    assert "PartitionFilters: [isnotnull(event_date" in p and "2024-01-05" in p
    p2 = plan(M.device_distribution(raw, lo="2024-01-05 00:00:00", hi="2024-01-05 23:59:59"))
    assert "PushedFilters: [IsNotNull(event_time), GreaterThanOrEqual(event_time" in p2
    assert M.dau_daily(M.for_dates(raw, ["2024-01-05"])).count() == 1
    assert raw.where(F.col("event_date") == "2024-01-05").count() > 0
