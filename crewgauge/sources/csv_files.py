"""Raw CSV files with declared schemas, and a fallback location."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from crewgauge import schemas
from crewgauge.sinks.tables import stored
from crewgauge.sources.bronze import Bronze

# Columns of a parse that no file has.
_BAD, _FILE = "__bad_line", "__file"


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Columns by header name, in the declared types; no pass over the data to guess them.

    The header may have the columns in any order and others besides. A missing column fails the
    read, as does a value that does not fit its type or a part with another header.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    names = reader.csv(path).columns  # reads the header only
    if missing := [f.name for f in schema if f.name not in names]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    declared = {f.name: f for f in schema}
    in_file = StructType([declared.get(n, StructField(n, StringType())) for n in names])
    return reader.schema(in_file).csv(path).select(*schema.names)


@dataclass(frozen=True)
class Loaded:
    """The rows of a file that fit its schema, and the lines that do not: file and line as they are."""

    rows: DataFrame
    rejects: DataFrame


def load_csv(spark: SparkSession, path: str, schema: StructType) -> Loaded:
    """Read all that can be read: a line with a value that does not fit its type, or with too few or too many values, is put aside.

    The file is parsed once, whole, and the parse is stored; rows and rejects are the two parts of it. (Read lazily, the
    parser would skip the columns a query does not use, and a line would be bad for one query and good for the next.) A missing
    column fails the load as in ``read_csv``: no line of such a file can be right. A file without any column or line has neither rows nor rejects.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    names = reader.csv(path).columns
    if missing := [f.name for f in schema if f.name not in names]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    declared = {f.name: f for f in schema}
    in_file = StructType([declared.get(n, StructField(n, StringType())) for n in names]).add(_BAD, StringType())
    permissive = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).schema(in_file).csv(path)
    parsed = stored(permissive.select(*schema.names, _BAD, F.input_file_name().alias(_FILE)), "parsed")
    bad = F.col(_BAD).isNotNull()
    return Loaded(
        parsed.where(~bad).select(*schema.names), parsed.where(bad).select(F.col(_FILE).alias("file"), F.col(_BAD).alias("line"))
    )


def read_first_present(
    spark: SparkSession, paths: list[str], schema: StructType, read: Callable[..., DataFrame | Loaded] = read_csv
) -> DataFrame | Loaded:
    """Read the first of ``paths`` that exists, on whatever file system it names."""
    for path in paths:
        try:
            return read(spark, path, schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of {paths} exists")


def bronze_from_csv(
    spark: SparkSession, employees: list[str], absence: str, recruitment: str
) -> Bronze:
    """``employees`` lists locations in order of preference."""
    return Bronze(
        employees=read_first_present(spark, employees, schemas.EMPLOYEES),
        recruitment=read_csv(spark, recruitment, schemas.RECRUITMENT),
        spells=read_csv(spark, absence, schemas.ABSENCE),
    )


def bronze_with_rejects(
    spark: SparkSession, employees: list[str], absence: str, recruitment: str
) -> tuple[Bronze, DataFrame]:
    """``bronze_from_csv`` that goes on past bad lines, and those lines: table_name, file, line."""
    loaded = {
        "employees": read_first_present(spark, employees, schemas.EMPLOYEES, load_csv),
        "recruitment": load_csv(spark, recruitment, schemas.RECRUITMENT),
        "absence": load_csv(spark, absence, schemas.ABSENCE),
    }
    rejects = reduce(DataFrame.unionByName, (part.rejects.select(F.lit(n).alias("table_name"), "*") for n, part in loaded.items()))
    bronze = Bronze(employees=loaded["employees"].rows, recruitment=loaded["recruitment"].rows, spells=loaded["absence"].rows)
    return bronze, rejects
