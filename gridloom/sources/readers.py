"""Table readers: CSV with type inference and encoding fallback, and Parquet."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..errors import DataLoadError
from ..functions.columns import blank_nan, col
from .records import QUOTED, left_open, quoted_records

# Cell texts that mean "missing" in a CSV file.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Extension to reader.
FORMATS = {".csv": "csv", ".parquet": "parquet"}
ENCODINGS = ("UTF-8", "ISO-8859-1")

_BAD = "_unparsed_line"
_WHOLE = r"^\s*[+-]?\d+\s*$"
_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_TRUTH = r"^(True|TRUE|true|False|FALSE|false)$"


def load_table(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    schema: T.StructType | None = None,
    base_dir: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read a CSV or Parquet table; NaN becomes NULL. A bare name is looked up in ``base_dir``."""
    if base_dir is not None and not os.path.isabs(path) and "://" not in path:
        path = f"{base_dir.rstrip('/')}/{path}"
    name = path.rstrip("/").rsplit("/", 1)[-1]
    fmt = fmt or FORMATS.get(os.path.splitext(name)[1].lower())
    if fmt not in FORMATS.values():
        raise DataLoadError(
            f"'{name}' cannot be loaded; known extensions are {', '.join(sorted(FORMATS))}."
        )
    try:
        if fmt == "csv":
            df = read_csv(spark, path, schema, multi_line)
        else:
            reader = spark.read if schema is None else spark.read.schema(schema)
            df = blank_nan(reader.parquet(path))
        return validate_table(df, name)
    except AnalysisException as exc:
        condition = exc.getCondition() or ""
        if "PATH_NOT_FOUND" in condition:
            raise DataLoadError(f"There is no '{name}' at that path.") from exc
        if "UNABLE_TO_INFER_SCHEMA" in condition:
            raise DataLoadError(f"'{name}' holds no table.") from exc
        raise DataLoadError(f"Could not read '{name}': {exc}") from exc
    except PySparkException as exc:
        raise DataLoadError(f"Could not read '{name}': {exc}") from exc


def validate_table(df: DataFrame, name: str) -> DataFrame:
    """At least one column and one row; looks at one row, not at the count."""
    if not df.columns:
        raise DataLoadError(f"'{name}' has no columns.")
    if df.isEmpty():
        raise DataLoadError(f"'{name}' has a header but no rows.")
    return df


_OPTIONS = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}


def _header(spark, path, encoding, multi_line) -> list[str]:
    reader = spark.read.option("header", True).option("escape", '"').option("encoding", encoding)
    # A header with a line break of its own hides from the parser that lines end in \r\n.
    return [c.removesuffix("\r") for c in reader.option("multiLine", multi_line).csv(path).columns]


def _raw_csv(spark, path, encoding, columns) -> DataFrame:
    """Cells as text, of files in which each line is a record."""
    fields = [T.StructField(c, T.StringType()) for c in [*columns, _BAD]]
    reader = spark.read.schema(T.StructType(fields)).options(header=True, encoding=encoding, enforceSchema=True, **_OPTIONS)
    return reader.csv(path)


def _raw_records(spark, path, encoding, columns) -> DataFrame:
    """The same of files with line breaks in quoted cells."""
    records, folders = quoted_records(spark, path, encoding)
    inside = [c for c in columns if c not in folders]
    kinds = ", ".join("`" + c.replace("`", "``") + "` STRING" for c in [*inside, _BAD])
    parsed = F.from_csv("text", kinds, {**_OPTIONS, "multiLine": "true"})
    cells = records.select(parsed.alias("_cells"), *[col(f) for f in folders])
    return cells.select(*[col(c) if c in folders else F.col("_cells").getField(c).alias(c) for c in [*columns, _BAD]])


def _inspect_lines(spark: SparkSession, path: str):
    """One scan of the raw lines: are all of them UTF-8, and does a cell go on in the next one?"""
    return spark.read.text(path).agg(
        F.coalesce(F.min(F.is_valid_utf8("value")), F.lit(True)).alias("utf8"),
        F.count(F.when(left_open(F.col("value")), 1)).alias("open_lines"),
    ).first()


def _too_wide(width: int) -> Column:
    """A line the parser marked that has more cells than the header (fewer are padded)."""
    line = F.col(_BAD)
    bare = F.regexp_replace(line, QUOTED, "")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    return line.isNotNull() & (commas >= width)


def _cell(name: str) -> Column:
    return F.when(~col(name).isin(MISSING_TOKENS), col(name))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Header row, comma separated. Two scans: the raw lines, then the types of the cells.

    Text that is not UTF-8 is read as Latin-1. A quoted cell may hold line breaks; such files are
    read split by split as well, with a pass more to find where records begin. Whole numbers stay exact: bigint, beyond that decimal, beyond
    38 digits text.
    """
    lines = _inspect_lines(spark, path)
    multi_line = multi_line or lines["open_lines"] > 0
    encoding = ENCODINGS[0] if lines["utf8"] else ENCODINGS[1]
    header = _header(spark, path, encoding, multi_line)
    if not header:
        raise DataLoadError("There is no header line to read.")
    raw = (_raw_records if multi_line else _raw_csv)(spark, path, encoding, header)
    cells = [_cell(c) for c in header]
    checks = [F.count(F.when(_too_wide(len(header)), 1)).alias("broken")]
    checks += [F.count(cell).alias(f"n{i}") for i, cell in enumerate(cells)]
    if schema is None:
        for i, cell in enumerate(cells):
            whole = cell.rlike(_WHOLE)
            exact = {kind: F.trim(cell).try_cast(kind).isNotNull() for kind in ("bigint", "decimal(38,0)")}
            tests = {
                "w": whole & exact["bigint"], "z": whole & exact["decimal(38,0)"], "i": whole,
                "d": cell.rlike(_DECIMAL), "t": cell.rlike(_TRUTH),
            }
            checks += [F.count(F.when(test, 1)).alias(f"{kind}{i}") for kind, test in tests.items()]
    seen = raw.agg(*checks).first()
    if seen["broken"]:
        raise DataLoadError("The CSV text is malformed: a line has more cells than the header.")
    out = []
    for i, (c, cell) in enumerate(zip(header, cells)):
        if schema is not None:
            out.append(cell.cast(schema[c].dataType).alias(c))
            continue
        n = seen[f"n{i}"]
        if n and seen[f"w{i}"] == n:
            kind = "bigint"
        elif n and seen[f"z{i}"] == n:
            kind = "decimal(38,0)"
        elif n and seen[f"i{i}"] == n:
            kind = "string"
        elif n == 0 or seen[f"d{i}"] == n:
            kind = "double"
        elif seen[f"t{i}"] == n:
            kind = "boolean"
        else:
            kind = "string"
        out.append((F.trim(cell) if kind not in ("string", "boolean") else cell).cast(kind).alias(c))
    return raw.select(*out)
