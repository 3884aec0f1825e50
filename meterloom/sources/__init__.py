"""Reading and writing tables, and the adapter that turns an event table into telemetry."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RAW

#: How a header names a column: the first row whose marks are in its lower-cased name wins. Fixed values, in this order.
HEADER_MARKS = [
    ("meter_id", ("meter",)),
    ("ts_str", ("timestamp", "time", "x_")),
    ("t_kwh", ("kwh", "t_")),
    ("voltage", ("voltage", "volt")),
    ("current", ("current", "amp")),
    ("freq", ("freq", "hz")),
]
MEASURES = ("t_kwh", "voltage", "current", "freq")


def read_csv(spark: SparkSession, path, schema: str | None = RAW) -> DataFrame:
    """CSV with a header under a schema; without one every column is a string. Numbers that don't parse become null."""
    reader = spark.read.option("header", "true").option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema else reader).csv(path)


def canonical_names(columns: list[str], marks=HEADER_MARKS) -> dict[str, str]:
    """Found name -> canonical name, for the columns that a mark fits."""
    out: dict[str, str] = {}
    for c in columns:
        low = c.strip().lower()
        name = next((name for name, words in marks if any(w in low for w in words)), None)
        if name and name not in out.values():
            out[c] = name
    return out


def canonical(df: DataFrame, marks=HEADER_MARKS) -> DataFrame:
    return df.withColumnsRenamed(canonical_names(df.columns, marks))


def typed(df: DataFrame, columns=MEASURES) -> DataFrame:
    """Text columns as doubles; what isn't a number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns if c in df.columns})


def exists(spark: SparkSession, path: str) -> bool:
    """Through Spark's own file systems, so any store will do."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    return found is not None and len(found) > 0


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.parquet(path)


def read_manifest(spark: SparkSession, files: list[tuple[dict, str]], schema: str | None = RAW) -> DataFrame:
    """files: (constants of the file, path). One scan for each set of constants; canonical names, trimmed ids, united by name."""
    missing = [path for _, path in files if not exists(spark, path)]
    if missing:
        raise FileNotFoundError(f"files of the manifest are missing: {missing}")
    groups: dict[tuple, list[str]] = {}
    for constants, path in files:
        groups.setdefault(tuple(sorted(constants.items())), []).append(path)
    return united([canonical(read_csv(spark, paths, schema)).withColumns({k: F.lit(v) for k, v in constants} | {"meter_id": F.trim("meter_id")}) for constants, paths in groups.items()])


def united(frames: list[DataFrame]) -> DataFrame:
    """All rows, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Event rows as raw readings: five dense series with outages, brownouts, spikes and rows that validation rejects. The JSON is parsed
    by a generator, once for each row: an expression would be copied into every filter and column that comes of it."""
    parsed = events.select("event_id", "event_type", "ts", "value", *keep, F.json_tuple("props", "k").alias("k"))
    k = F.col("k").cast("int")
    return parsed.select(
        "event_id",
        F.when(F.col("event_type").isin("click", "error"), "A").otherwise("B").alias("district"),
        F.col("event_type").alias("meter_id"),
        "ts",
        F.year("ts").alias("file_year"),
        (F.col("value") / 1000.0).alias("t_kwh"),
        F.when(k % 12 == 0, 0.0).otherwise(F.lit(170.0) + F.lit(1.4) * k).alias("voltage"),
        F.when(k % 7 == 0, 0.0).otherwise(F.col("value") / 10.0).alias("current"),
        F.when(k % 12 == 0, 0.0).when(k == 13, 19.4).otherwise(50.0).alias("freq"),
        *keep,
    )


def inspect(df: DataFrame, rows: int = 5) -> dict:
    """Schema, first rows and number of rows."""
    return {"schema": df.dtypes, "rows": [r.asDict() for r in df.limit(rows).collect()], "count": df.count()}


# -- sinks -------------------------------------------------------------------------------------------------------------


def write_layer(df: DataFrame, path: str, by: tuple[str, ...] = (), rows_per_file: int = 5_000_000) -> None:
    """Parquet in place of what is there, a folder for each value of `by`. Rows of a folder come together, so files are few, but a large
    folder is dealt to as many tasks as its size asks for: adaptive execution splits it by the advisory size of partitions."""
    out = df.hint("rebalance", *by) if by else df
    writer = out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_quarantine(df: DataFrame, path: str) -> None:
    """Always written, so that a clean run leaves no stale rejects."""
    df.write.mode("overwrite").parquet(path)


def write_report(report: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(report, f, indent=2, allow_nan=True, default=str)


def shown(report: dict, indent: int = 0) -> str:
    """A nested report as lines of text."""
    out = []
    for k, v in report.items():
        out += [" " * indent + f"{k}:", shown(v, indent + 2)] if isinstance(v, dict) else [" " * indent + f"{k}: {v}"]
    return "\n".join(out)
