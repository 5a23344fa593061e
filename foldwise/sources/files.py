"""File scans (S1-S5): CSV or Parquet, one missing marker (NULL), keyed rows."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.functions.exprs import to_null_if_not_finite

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

log = logging.getLogger(__name__)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order (booleans and strings are not features)."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in skip]


def parse_number(c: str):
    """Text cell -> double; '', nan, inf, -inf (any case) -> NULL; -0.0 -> 0.0."""
    x = F.expr(f"try_cast(trim(`{c}`) AS DOUBLE)")
    return to_null_if_not_finite(x) + F.lit(0.0)


def resolve_path(spark: SparkSession, name: str, roots: Sequence[str]) -> str | None:
    """First existing ``root/name`` (S5), checked through the Hadoop FileSystem API."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for root in roots:
        path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}" if root else name)
        if path.getFileSystem(conf).exists(path):
            return str(path)
    return None


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType | None = None,
    text_columns: Iterable[str] = (),
) -> DataFrame:
    """CSV with header.  Every column not listed in ``text_columns`` is parsed
    as double with NaN/Inf folded into NULL.  A given ``schema`` only fixes the
    column order/names; parsing is ours, because Spark's own CSV parser keeps
    ``NaN`` as NaN and silently types a column with ``nan`` as string."""
    if resolve_path(spark, path, [""]) is None:
        raise FileNotFoundError(path)
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    names = schema.fieldNames() if schema is not None else raw.columns
    keep = set(text_columns)
    return raw.select(
        *[F.col(f"`{c}`") if c in keep else parse_number(c).alias(c) for c in names]
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def normalize_missing(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NaN / +-Inf -> NULL on float columns (in one projection)."""
    cols = list(cols) if cols is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    ]
    return df.withColumns({c: to_null_if_not_finite(c) for c in cols}) if cols else df


def require_columns(df: DataFrame, required: Iterable[str], what: str = "table") -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing required columns {missing}")


def load_train(spark: SparkSession, path: str, targets: Sequence[str]) -> DataFrame:
    """Training table; the target columns must be present, the ten largest shares of missing values are logged."""
    df = read_csv(spark, path) if path.endswith(".csv") else normalize_missing(read_parquet(spark, path))
    require_columns(df, targets, "train")
    cols = [c for c in df.columns if c != "index"]
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols]).first().asDict()
    top = sorted(((c, s) for c, s in shares.items() if s), key=lambda x: (-x[1], x[0]))[:10]
    log.info("missing values: %s", ", ".join(f"{c} {s:.4f}" for c, s in top) or "none")
    return df


def load_test(spark: SparkSession, path: str) -> DataFrame:
    """S3: test table, no target check."""
    return read_csv(spark, path) if path.endswith(".csv") else normalize_missing(read_parquet(spark, path))


def with_row_index(df: DataFrame, id_col: str = "index") -> DataFrame:
    """P20: keep ``id_col`` when present, else number the rows 0..n-1 in scan
    order with partition offsets (dense, unlike monotonically_increasing_id);
    rows do not move."""
    if id_col in df.columns:
        return df
    from foldwise.operators.numbering import number_rows

    return number_rows(df, id_col)


def feature_set_diff(a: DataFrame, b: DataFrame, exclude: Iterable[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric columns only in ``a`` and only in ``b`` (both must be empty
    for a train / test pair)."""
    ca, cb = set(numeric_columns(a, exclude)), set(numeric_columns(b, exclude))
    return sorted(ca - cb), sorted(cb - ca)
