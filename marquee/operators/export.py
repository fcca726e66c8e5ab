"""Daily export.

The export of a day is its metric rows, top movies and retention rows.  As a
flat record set the three are unioned by name with a ``table`` tag (columns
missing from a section are NULL); as a JSON document they are nested under
one header row.  A day's export is small by construction (three metrics, ten
movies, at most eight offsets per cohort), so the single output file per
format is written from one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORMATS = ("csv", "json", "parquet")


def export_union(metrics: DataFrame, top: DataFrame, retention: DataFrame) -> DataFrame:
    """Tagged union of the three sections."""
    return (metrics.withColumn("table", F.lit("metrics"))
            .unionByName(top.withColumn("table", F.lit("top_movies")), allowMissingColumns=True)
            .unionByName(retention.withColumn("table", F.lit("retention")), allowMissingColumns=True))


def section_counts(export: DataFrame) -> DataFrame:
    """Record count per section."""
    return export.groupBy("table").agg(F.count(F.lit(1)).alias("records"))


def export_document(day, metrics: DataFrame, top: DataFrame, retention: DataFrame) -> DataFrame:
    """K7: one row: export_date, generated_at, then the three arrays, each in
    its read order (sorted arrays of structs keyed by that order)."""
    d = F.lit(str(day))

    def arr(df: DataFrame, name: str, order: list[str]) -> DataFrame:
        cols = [c for c in df.columns]
        s = F.struct(*[F.col(c) for c in order], F.struct(*[F.col(c) for c in cols]).alias("row"))
        return df.agg(F.transform(F.array_sort(F.collect_list(s)), lambda x: x["row"]).alias(name))

    m = arr(metrics, "metrics", ["metric_name"])
    t = arr(top, "top_movies", ["rank_pos"])
    r = arr(retention, "retention", ["day_offset"])
    head = m.sparkSession.range(1).select(d.alias("export_date"),
                                          F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
                                          .alias("generated_at"))
    return head.crossJoin(m).crossJoin(t).crossJoin(r)


def write_export(export: DataFrame, root: str, day, fmt: str, document: DataFrame = None) -> str:
    """K6: overwrite ``daily/<day>/aggregates.<fmt>`` (a directory holding one
    part file).  CSV cannot hold structs, so ``extra`` stays a JSON string;
    ``json`` writes the nested document when one is given."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown export format {fmt!r}; expected one of {FORMATS}")
    target = f"{root.rstrip('/')}/daily/{day}/aggregates.{fmt}"
    df = document if (fmt == "json" and document is not None) else export
    w = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").csv(target)
    elif fmt == "json":
        w.json(target)
    else:
        w.parquet(target)
    return target
