"""CSV types with their evidence: how many values of a column read as each type, in one scan.

Every field is read as text and matched against the types of the lattice; a
column takes the first type that all its values read as, text if none. Records
with too many or too few fields keep their line in a column of their own, so a
bad record is seen instead of becoming nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
# What reads as each type, in the order of preference. At most 18 digits always fit a long.
LONG = "^[+-]?[0-9]{1,18}$"
DOUBLE = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
BOOLEAN = "^([tT]rue|[fF]alse|TRUE|FALSE)$"
DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TYPES = {"long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType()}


def _reads_as(c: str) -> dict[str, F.Column]:
    x = F.col(f"`{c}`")
    return {"long": x.rlike(LONG), "double": x.rlike(DOUBLE), "boolean": x.rlike(BOOLEAN),
            "date": x.rlike(DATE) & x.try_cast("date").isNotNull()}


def _as_text(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """Every field as text, with the corrupt-record column; names come from the header."""
    names = [c for c in spark.read.option("header", True).csv(path).columns if c != CORRUPT]
    fields = [T.StructField(c, T.StringType()) for c in [*names, CORRUPT]]
    reader = spark.read.option("header", True).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(T.StructType(fields)).csv(path), names


def csv_evidence(spark: SparkSession, path: str) -> DataFrame:
    """``column, n, n_long, n_double, n_boolean, n_date, n_corrupt, inferred``: a row for each column. ``n`` are
    values that are not null; ``n_corrupt`` the file's bad records, whose fields don't vote. A column without values is
    text."""
    rows, names = _as_text(spark, path)
    bad = F.col(CORRUPT).isNotNull()
    counts = [F.count(F.when(bad, F.lit(1))).alias("bad")]
    for i, c in enumerate(names):
        counts.append(F.count(F.when(~bad, F.col(f"`{c}`"))).alias(f"n{i}"))
        counts += [F.count(F.when(~bad & ok, F.lit(1))).alias(f"{t}{i}") for t, ok in _reads_as(c).items()]
    one = rows.agg(*counts).first()  # columns x types numbers
    found = []
    for i, c in enumerate(names):
        by_type = {t: one[f"{t}{i}"] for t in TYPES}
        n = one[f"n{i}"]
        kind = next((t for t, k in by_type.items() if n and k == n), "string")
        found.append((c, n, *by_type.values(), one["bad"], kind))
    schema = "column string, n long, " + ", ".join(f"n_{t} long" for t in TYPES) + ", n_corrupt long, inferred string"
    return spark.createDataFrame(found, schema)


def scan_csv_inferred(spark: SparkSession, path: str, evidence: DataFrame | None = None) -> DataFrame:
    """The rows with the inferred types, and ``_corrupt_record`` (null on good records)."""
    kinds = {r["column"]: r["inferred"] for r in (csv_evidence(spark, path) if evidence is None else evidence).collect()}
    rows, names = _as_text(spark, path)
    typed = [F.col(f"`{c}`").try_cast(TYPES.get(kinds[c], T.StringType())).alias(c) for c in names]
    return rows.select(*typed, CORRUPT)
