"""Frame comparison that scales: schema check, then the multiset difference
both ways in one distributed aggregation, never a driver collect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def schemas_equal(left: DataFrame, right: DataFrame, check_nullability: bool = False) -> bool:
    lf, rf = left.schema.fields, right.schema.fields
    if len(lf) != len(rf):
        return False
    for a, b in zip(lf, rf):
        if a.name != b.name or a.dataType != b.dataType:
            return False
        if check_nullability and a.nullable != b.nullable:
            return False
    return True


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _free_names(taken: list[str], *wanted: str) -> list[str]:
    used = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def compare_frames(left: DataFrame, right: DataFrame, check_nullability: bool = False) -> DataFrame:
    """One row: schema_equal, left_rows, right_rows, left_only, right_only.

    The frames are equal (order ignored, duplicates counted) when the schema
    matches and both difference counts are zero. One pass: both frames are
    tagged, unioned and grouped by all columns (identical rows are
    pre-aggregated in each task), and the per-row count differences are
    summed. With differing schemas only the row counts are filled in.
    """
    same = schemas_equal(left, right, check_nullability)
    if not same:
        spark = left.sparkSession
        return spark.range(1).select(
            F.lit(False).alias("schema_equal"),
            left.select(F.count(F.lit(1))).scalar().alias("left_rows"),
            right.select(F.count(F.lit(1))).scalar().alias("right_rows"),
            F.lit(None).cast("long").alias("left_only"), F.lit(None).cast("long").alias("right_only"))
    cols = [F.col(_quoted(c)) for c in left.columns]
    # count columns with names that no column of the frames has
    l, r = _free_names(left.columns, "left_count", "right_count")
    tagged = left.select(*cols, F.lit(1).alias(l), F.lit(0).alias(r)).union(
        right.select(*[F.col(_quoted(c)) for c in right.columns], F.lit(0).alias(l), F.lit(1).alias(r)))
    per_row = tagged.groupBy(*cols).agg(F.sum(l).alias(l), F.sum(r).alias(r)).select(
        F.col(l).alias("l"), F.col(r).alias("r"))
    zero = F.lit(0).cast("long")
    return per_row.agg(
        F.coalesce(F.sum("l"), zero).alias("left_rows"),
        F.coalesce(F.sum("r"), zero).alias("right_rows"),
        F.coalesce(F.sum(F.greatest(F.col("l") - F.col("r"), zero)), zero).alias("left_only"),
        F.coalesce(F.sum(F.greatest(F.col("r") - F.col("l"), zero)), zero).alias("right_only"),
    ).select(F.lit(True).alias("schema_equal"), "left_rows", "right_rows", "left_only", "right_only")


def frames_equal(left: DataFrame, right: DataFrame, check_nullability: bool = False) -> bool:
    row = compare_frames(left, right, check_nullability).first()
    return bool(row.schema_equal and row.left_only == 0 and row.right_only == 0)


#: Buckets of rows that ``compare_by_digest`` tells apart.
DIGEST_BUCKETS = 1024


def bucket_digests(df: DataFrame, buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """(bucket, rows, d1, d2): the number of rows of each hash bucket, and two sums of independent row hashes.

    The sums don't depend on the rows' order and count duplicates. A row moves
    in no shuffle, only ``buckets`` sums a task.
    """
    cols = [F.col(_quoted(c)) for c in df.columns]
    wide = lambda h: h.cast("decimal(20, 0)")
    return df.select(F.xxhash64(*cols).alias("h"), F.xxhash64(F.lit(1), *reversed(cols)).alias("g")).groupBy(
        F.pmod("h", F.lit(buckets)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(wide(F.col("h"))).alias("d1"), F.sum(wide(F.col("g"))).alias("d2"))


def compare_by_digest(left: DataFrame, right: DataFrame, check_nullability: bool = False,
                      buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """The same row as ``compare_frames``, at the cost of the differences.

    Rows are hashed into buckets, whose digests are compared first. Only rows of
    buckets that differ are then compared one by one, so frames that are equal
    shuffle nothing but digests. The digests are two 64-bit sums: buckets with
    differences agree in them by chance only. Give frames that are cheap to
    read twice (stored versions).
    """
    if not schemas_equal(left, right, check_nullability) or not left.columns:
        return compare_frames(left, right, check_nullability)
    a, b = (bucket_digests(df, buckets).select("bucket", *(F.col(c).alias(f"{c}_{side}") for c in ("rows", "d1", "d2")))
            for side, df in (("l", left), ("r", right)))
    both = a.join(b, "bucket", "full").collect()  # a row a bucket at most
    same = [r for r in both if (r.rows_l, r.d1_l, r.d2_l) == (r.rows_r, r.d1_r, r.d2_r)]
    differ = [r.bucket for r in both if (r.rows_l, r.d1_l, r.d2_l) != (r.rows_r, r.d1_r, r.d2_r)]
    equal_rows = sum(r.rows_l for r in same)

    def unequal(df: DataFrame) -> DataFrame:
        h = F.pmod(F.xxhash64(*[F.col(_quoted(c)) for c in df.columns]), F.lit(buckets))
        return df.filter(h.isin(differ)) if differ else df.limit(0)

    rest = compare_frames(unequal(left), unequal(right))
    return rest.withColumns({c: F.col(c) + F.lit(equal_rows) for c in ("left_rows", "right_rows")})
