"""Sources: CSV / Parquet / catalog tables, newest-file resolution, fallback
chains and dataset builders. Listing uses Spark's file index (the
``binaryFile`` source with only ``path``/``modificationTime`` selected, so
file contents are never read)."""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DatasetSpec
from ..operators.features import DatasetBundle, assemble_bundle
from ..operators.splits import FlagSplit, split_by_flag


class SourceError(ValueError):
    pass


# The text tokens pandas reads as missing by default (public
# pandas documentation), applied to non-string columns of CSV input.
CSV_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                 "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             na_tokens: list[str] | None = None) -> DataFrame:
    """CSV with a header row and quoted list text. With a schema, every field
    is read as text first and typed afterwards so that any of ``na_tokens``
    becomes NULL in non-string columns (pandas-like), never a parse error.
    Without a schema a column is numeric when every value that is not an NA
    token reads as a number (whole numbers: long), decided over all rows in one
    aggregate; any other column stays text."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"') \
        .option("multiLine", False).option("mode", "PERMISSIVE")
    tokens = CSV_NA_TOKENS if na_tokens is None else na_tokens
    if schema is None:
        return _typed_by_content(reader.csv(path), tokens)
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    as_text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in st.fields])
    raw = reader.schema(as_text).csv(path)
    cols = []
    for f in st.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            cols.append(c)
        else:
            cleaned = F.when(F.trim(c).isin(tokens) | c.isNull(), F.lit(None)).otherwise(F.trim(c))
            cols.append(cleaned.cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def _typed_by_content(raw: DataFrame, tokens: list[str]) -> DataFrame:
    def clean(c: str):
        return F.when(~F.trim(F.col(f"`{c}`")).isin(tokens), F.trim(F.col(f"`{c}`")))

    checks = []
    for k, c in enumerate(raw.columns):
        v = clean(c)
        checks += [F.count(v).alias(f"n{k}"), F.count(F.when(v.isNotNull() & v.try_cast("double").isNull(), 1)).alias(f"text{k}"),
                   F.count(F.when(v.isNotNull() & v.try_cast("bigint").isNull() | v.rlike("[.eE]"), 1)).alias(f"broken{k}")]
    seen = raw.agg(*checks).first()
    out = []
    for k, c in enumerate(raw.columns):
        if not seen[f"n{k}"] or seen[f"text{k}"]:
            out.append(F.col(f"`{c}`"))
        else:
            out.append(clean(c).try_cast("double" if seen[f"broken{k}"] else "bigint").alias(c))
    return raw.select(*out)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def list_files(spark: SparkSession, directory: str, pattern: str = "*.parquet",
               recursive: bool = False) -> DataFrame:
    """(path, modificationTime, length) of files under ``directory``."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", str(recursive).lower()).load(directory)
            .select("path", "modificationTime", "length"))


def _is_file_path(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath) and fs.getFileStatus(hpath).isFile()


def resolve_latest_file(spark: SparkSession, source: str, recursive: bool = False,
                        pattern: str = "*.parquet") -> str:
    """A file path (ending in .parquet) is used as is; a directory / prefix
    resolves to its most recently modified matching file (ties: smallest
    path). No match -> error."""
    if source.endswith(".parquet") and (recursive or _is_file_path(spark, source)):
        return source
    try:
        files = list_files(spark, source, pattern, recursive)
        top = files.orderBy(F.col("modificationTime").desc(), F.col("path").asc()).limit(1).collect()
    except Exception as exc:  # missing directory
        raise SourceError(f"No parquet files found under {source}") from exc
    if not top:
        raise SourceError(f"No parquet files found under {source}")
    return top[0]["path"]


# Spark names the files of one write ``part-<task>-<write id>...``; the write
# id is a UUID shared by every file the job produced.
_WRITE_ID = re.compile(r"part-\d+-([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})")


def read_latest_drop(spark: SparkSession, source: str, recursive: bool = False,
                     pattern: str = "*.parquet") -> DataFrame:
    """Read the newest file under ``source`` (``resolve_latest_file``), widened
    to the whole write it belongs to. A single-file drop reads just that file;
    a Spark-written drop is many part-files (some possibly empty) whose newest
    member is arbitrary, so every file carrying the newest file's write id is
    read - by a glob on the listing, never a path list through the driver."""
    return _whole_write(spark, source, resolve_latest_file(spark, source, recursive, pattern), recursive, pattern)


def _whole_write(spark: SparkSession, source: str, newest: str, recursive: bool, pattern: str) -> DataFrame:
    m = _WRITE_ID.search(newest.rsplit("/", 1)[-1])
    if m is None or newest == source:
        return spark.read.parquet(newest)
    ext = pattern.lstrip("*")
    root = source if recursive else newest.rsplit("/", 1)[0]
    return (spark.read.option("recursiveFileLookup", str(recursive).lower())
            .option("pathGlobFilter", f"*{m.group(1)}*{ext}").parquet(root))


def resolve_greatest_key(spark: SparkSession, prefix: str, pattern: str = "*.parquet") -> str:
    """The lexicographically greatest file path under a prefix (recursive)."""
    files = list_files(spark, prefix, pattern, recursive=True)
    best = files.agg(F.max("path")).first()[0]
    if best is None:
        raise SourceError(f"No files matching {pattern} under {prefix}")
    return best


def read_latest_metadata(spark: SparkSession, prefix: str) -> DataFrame:
    """Newest pipeline metadata document (greatest key) as a DataFrame."""
    return spark.read.json(resolve_greatest_key(spark, prefix, "*.json"), multiLine=True)


_NO_TABLE = ("TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND")


def read_table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """A catalog table, or None when the catalog has none of that name or it is
    empty. Any other failure (permissions, damaged files) is raised."""
    try:
        df = spark.table(name)
        empty = df.isEmpty()
    except AnalysisException as exc:
        if exc.getCondition() in _NO_TABLE:
            return None
        raise
    return None if empty else df


def load_with_fallback(spark: SparkSession, table_name: str | None, prefix: str | None) -> DataFrame:
    """Catalog table -> the write with the greatest key under ``prefix`` -> error. Empty -> error."""
    df = read_table_or_none(spark, table_name) if table_name else None
    if df is None:
        if not prefix:
            raise SourceError("No table data and no parquet prefix given")
        key = resolve_greatest_key(spark, prefix)
        df = _whole_write(spark, key.rsplit("/", 1)[0], key, False, "*.parquet")
    if df.isEmpty():
        raise SourceError("Dataset is empty")
    return df


@dataclass
class SourceChoice:
    kind: str  # "parquet" | "csv"
    parquet: str | None = None
    train_csv: str | None = None
    val_csv: str | None = None


def choose_source(parquet: str | None = None, train_csv: str | None = None,
                  val_csv: str | None = None) -> SourceChoice:
    """Parquet XOR (train CSV and validation CSV)."""
    has_csv = bool(train_csv) or bool(val_csv)
    if parquet and has_csv:
        raise SourceError("Give either a parquet source or train/val CSVs, not both")
    if parquet:
        return SourceChoice("parquet", parquet=parquet)
    if train_csv and val_csv:
        return SourceChoice("csv", train_csv=train_csv, val_csv=val_csv)
    raise SourceError("Give a parquet source or both train and val CSVs")


def load_flag_split(spark: SparkSession, source: str, spec: DatasetSpec,
                    recursive: bool = False) -> FlagSplit:
    resolved = resolve_latest_file(spark, source, recursive=recursive) \
        if not source.endswith(".parquet") else source
    df = spark.read.parquet(source) if source.endswith(".parquet") else read_latest_drop(spark, source, recursive)
    from ..operators.schema import apply_column_rename
    fs = split_by_flag(apply_column_rename(df, spec.column_rename), spec, capture_run_date=True)
    fs.source_path = resolved
    return fs


def bundle_from_csv(spark: SparkSession, train_csv: str, val_csv: str, spec: DatasetSpec,
                    schema=None, key_columns=()) -> DatasetBundle:
    return assemble_bundle(read_csv(spark, train_csv, schema), read_csv(spark, val_csv, schema),
                           spec, key_columns)


def bundle_from_parquet(spark: SparkSession, source: str, spec: DatasetSpec,
                        key_columns=()) -> DatasetBundle:
    fs = load_flag_split(spark, source, spec)
    return assemble_bundle(fs.train, fs.eval, spec, key_columns)
