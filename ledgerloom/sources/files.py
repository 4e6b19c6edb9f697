"""Reading and writing JSONL, JSON and CSV, with record positions.

Spark rows have no order, yet "the first one wins" and record numbers need one.
Every reader therefore carries a position: the file, the byte range of the split
the record came from, and a sequence number within it. Comparing positions
gives file order however the file was cut into splits.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.json_text import float_text, indented, quote
from ledgerloom.functions.text import SPACE, strip
from ledgerloom.operators.scale import broadcast_if_small
from ledgerloom.session import checkpointed
from ledgerloom.sources.json_pieces import list_items

# File kinds by (case-insensitive) suffix, and the keys that wrap record lists.
GLOBS = {"jsonl": "*.[jJ][sS][oO][nN][lL]", "json": "*.[jJ][sS][oO][nN]", "csv": "*.[cC][sS][vV]"}
WRAPPERS = ("data", "examples", "records", "items")

#: Whole-file JSON up to this size is parsed by one task.
WHOLE_BYTES = 32 * 1024 * 1024

POSITION = ("file_path", "block_start", "block_length", "sequence")
RECORD_SCHEMA = (
    "id STRING, instruction STRING, context STRING, output STRING, category STRING, source STRING"
)


def _pin_splits(spark: SparkSession) -> None:
    """Make the way files are cut independent of how many executors are alive.

    Numbering records reads the files twice, and both reads must see the same
    splits. Without this setting the split size follows the current core count,
    which changes when executors come and go.
    """
    setting = "spark.sql.files.minPartitionNum"
    if spark.conf.get(setting, None) is None:
        spark.conf.set(setting, str(spark.sparkContext.defaultParallelism))


def file_kind(path: Column) -> Column:
    """``jsonl``, ``json`` or ``csv`` by suffix; the parts of a folder that a sink wrote by the folder's suffix. Else null."""
    of_folder = F.regexp_extract(path, r"(?i)\.(jsonl|json|csv)(?:/[^/]+=[^/]*)*/part-[^/]*$", 1)
    of_file = F.regexp_extract(path, r"(?i)\.(jsonl|json|csv)$", 1)
    return F.lower(F.coalesce(F.nullif(of_folder, F.lit("")), F.nullif(of_file, F.lit(""))))


def _reader(spark: SparkSession, kind: str):
    """Reader of the files that may be of a kind; ``_of_kind`` drops parts of folders of another kind."""
    _pin_splits(spark)
    pattern = f"{{{GLOBS[kind]},part-*}}"
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)


def _of_kind(kind: str) -> Column:
    return file_kind(F.col("_metadata.file_path")) == kind


def _position() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_block_length").alias("block_length"),
        F.monotonically_increasing_id().alias("sequence"),
    ]


def list_files(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """Supported files under each root, numbered in order; unknown paths raise.

    Only names are read. Roots keep their order; inside a root files sort by
    path, folder by folder.
    """
    listings = []
    for at, root in enumerate(roots):
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        ).select("path", F.col("_metadata.file_path").alias("file_path"))
        supported = file_kind(F.col("path")).isNotNull()
        if "." in root.rstrip("/").rsplit("/", 1)[-1]:
            alone = files.filter(F.col("path").endswith(root.rstrip("/")) & ~supported)
            if not alone.isEmpty():
                raise ValueError(f"unsupported file type: {root}")
        listings.append(files.filter(supported).select(F.lit(at).alias("root_ord"), "path", "file_path"))
    listed = reduce(DataFrame.unionByName, listings)
    order = Window.orderBy("root_ord", F.split("path", "/"))
    return listed.select(
        "root_ord",
        "file_path",
        file_kind(F.col("path")).alias("kind"),
        (F.row_number().over(order) - 1).alias("file_ord"),
    )


def read_lines(spark: SparkSession, root: str) -> DataFrame:
    """Non-blank JSONL lines with their positions."""
    lines = _reader(spark, "jsonl").text(root)
    return lines.filter(_of_kind("jsonl") & F.col("value").rlike(f"(?U)[^{SPACE[1:]}")).select(
        F.col("value").alias("record"), *_position()
    )


def escaped_path(file_path: str) -> str:
    """A path as the readers take it, from the URI of a file: nothing in it is a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file_path))


def _files_by_header(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Paths of the CSV files under a root, by their first line.

    One narrow pass keeps the first line of each file, combined map-side; the
    driver gets one line per file, as it has the list of files anyway.
    """
    lines = _reader(spark, "csv").text(root).filter(_of_kind("csv")).select(F.col("value"), *_position())
    firsts = (
        lines.filter(F.col("block_start") == 0).groupBy("file_path").agg(F.min_by("value", "sequence").alias("header"))
    )
    found: dict[str, list[str]] = {}
    for row in sorted(firsts.collect()):
        if row["header"].count('"') % 2:
            raise ValueError(f"a header with a line break is not read: {row['file_path']}")
        found.setdefault(row["header"].rstrip("\r"), []).append(escaped_path(row["file_path"]))
    return found


def read_csv(spark: SparkSession, root: str, multiline: bool = True) -> DataFrame:
    """CSV rows as JSON objects of the file's own columns; every value is a string.

    Files are grouped by their header and each group is one scan, so files under
    one root may have different columns. There should be few different headers.
    ``multiline`` allows line breaks inside quotes at the price of one task per file.
    """
    _pin_splits(spark)
    parts = []
    for header, paths in _files_by_header(spark, root).items():
        names = next(csv.reader([header]))
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
        reader = spark.read.schema(schema).option("header", "true").option("enforceSchema", "false")
        table = reader.option("multiLine", multiline).option("escape", '"').csv(paths)
        filled = [F.coalesce(F.col(f"`{name}`"), F.lit("")).alias(name) for name in table.columns]
        parts.append(table.select(F.to_json(F.struct(*filled)).alias("record"), *_position()))
    if not parts:
        return spark.createDataFrame([], "record string, file_path string, block_start long, block_length long, sequence long")
    return reduce(DataFrame.unionByName, parts)


def unwrapped(document: Column) -> Column:
    """Whole-file JSON -> array of record objects (as JSON text).

    A list gives its objects. An object gives the first wrapper key that holds a
    list (even an empty one), else all objects of all its lists, else itself.
    Anything else gives nothing.
    """
    strict = {"mode": "FAILFAST"}

    # What is used more than once is bound: a document may be tens of megabytes.
    def bound(value: Column, body: Callable[[Column], Column]) -> Column:
        return F.element_at(F.transform(F.array(value), body), 1)

    def listed(value: Column) -> Column:
        return F.when(value.startswith("["), F.from_json(value, "array<string>"))

    def objects(values: Column) -> Column:
        return F.filter(values, lambda value: value.startswith("{"))

    def nested(by_key: Column) -> Column:
        lists = F.transform(F.map_values(by_key), listed)
        return objects(F.flatten(F.filter(lists, lambda values: values.isNotNull())))

    def from_object(text: Column) -> Column:
        def of_keys(by_key: Column) -> Column:
            wrapped = F.coalesce(*[listed(F.element_at(by_key, F.lit(key))) for key in WRAPPERS])
            several = bound(nested(by_key), lambda found: F.when(F.size(found) > 0, found).otherwise(F.array(text)))
            return bound(wrapped, lambda found: F.when(found.isNotNull(), objects(found)).otherwise(several))

        return bound(F.from_json(text, "map<string,string>", strict), of_keys)

    def items(text: Column) -> Column:
        scalar = F.when(F.parse_json(text).isNotNull(), F.array().cast("array<string>"))
        return (
            F.when(text.startswith("["), objects(F.from_json(text, "array<string>", strict)))
            .when(text.startswith("{"), from_object(text))
            .otherwise(scalar)
        )

    return bound(strip(document), items)


def _whole_documents(files: DataFrame) -> DataFrame:
    # An inner explode would have the planner filter on the size of the list, which parses every document twice.
    return files.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.posexplode_outer(unwrapped(F.col("value"))).alias("record_ord", "record"),
    ).filter(F.col("record_ord").isNotNull()).select("record", "file_path", F.col("record_ord").cast("bigint").alias("record_ord"))


def read_documents(spark: SparkSession, root: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """Records of whole-file JSON documents, with ``record_ord`` inside the file.

    Documents up to ``whole_bytes`` are parsed by one task each. Larger ones are
    read in splits and never held as a whole (``json_pieces``), with the same
    result; only a large document that is itself one record has to be.
    """
    size = F.col("_metadata.file_size")
    files = _reader(spark, "json").text(root, wholetext=True).filter(_of_kind("json") & (size <= whole_bytes))
    small = _whole_documents(files)
    pieces = _reader(spark, "json").text(root, lineSep="}").filter(_of_kind("json") & (size > whole_bytes))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    if listed.filter((file_kind(F.col("path")) == "json") & (F.col("length") > whole_bytes)).select("path").isEmpty():
        return small
    items, alone = list_items(spark, pieces.select("value", size.alias("file_size"), *_position()), WRAPPERS)
    paths = [escaped_path(row["file_path"]) for row in alone.collect()]
    large = small.unionByName(items)
    return large.unionByName(_whole_documents(spark.read.text(paths, wholetext=True))) if paths else large


def numbered(rows: DataFrame) -> DataFrame:
    """Replace the split position by ``record_ord``, counted from 0 per file.

    One narrow pass counts the records per split; running totals of those counts
    are joined back, so rows are neither shuffled by file nor sorted.
    """
    splits = rows.groupBy("file_path", "block_start", "block_length").agg(
        F.count("*").alias("_rows"), F.min("sequence").alias("_first")
    )
    along = Window.partitionBy("file_path").orderBy("block_start")
    before = F.coalesce(
        F.sum("_rows").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = splits.withColumn("_before", before)
    joined = broadcast_if_small(offsets, ["file_path", "block_start", "block_length"], rows)
    inside = F.col("sequence") - F.col("_first")
    sound = (inside >= 0) & (inside < F.col("_rows"))
    ordinal = F.when(sound, F.col("_before") + inside).otherwise(
        F.raise_error(F.lit("files were split differently between two reads")).cast("bigint")
    )
    return joined.withColumn("record_ord", ordinal).drop(
        "_rows", "_first", "_before", "block_start", "block_length", "sequence"
    )


def load_records(spark: SparkSession, roots: Sequence[str], multiline_csv: bool = True) -> DataFrame:
    """Every record under the roots: ``file_ord, record_ord, record`` (JSON text)."""
    files = checkpointed(list_files(spark, roots))
    present = {(row.root_ord, row.kind) for row in files.select("root_ord", "kind").distinct().collect()}
    parts = []
    for at, root in enumerate(roots):
        found = []
        if (at, "jsonl") in present:
            found.append(numbered(read_lines(spark, root)))
        if (at, "json") in present:
            found.append(read_documents(spark, root))
        if (at, "csv") in present:
            found.append(numbered(read_csv(spark, root, multiline_csv)))
        parts += [part.withColumn("root_ord", F.lit(at)) for part in found]
    if not parts:
        return spark.createDataFrame([], "file_ord int, record_ord bigint, record string")
    rows = reduce(DataFrame.unionByName, parts)
    return broadcast_if_small(files.drop("kind"), ["root_ord", "file_path"], rows).select(
        "file_ord", "record_ord", "record"
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Canonical JSONL records with positions; a malformed line fails the job.

    ``context`` is read as the exact JSON text of the line, so ``1`` and ``1.0``
    stay apart.
    """
    _pin_splits(spark)
    reader = spark.read.schema(RECORD_SCHEMA).option("mode", "FAILFAST")
    return reader.json(path).select("*", *_position())


# --- sinks ---------------------------------------------------------------------


def json_line(df: DataFrame, raw: Sequence[str] = ("context",)) -> Column:
    """One JSON object per row: sorted keys, nulls left out.

    Columns in ``raw`` hold JSON text already and are embedded as they are.
    """

    def value(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if field.name in raw:
            return column
        if isinstance(field.dataType, T.StringType):
            return quote(column)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return float_text(column.cast("double"))
        if isinstance(field.dataType, (T.IntegralType, T.BooleanType)):
            return column.cast("string")
        return F.to_json(column)

    members = [
        F.concat(quote(F.lit(field.name)), F.lit(": "), value(field))
        for field in sorted(df.schema.fields, key=lambda field: field.name)
    ]
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*members)), ", "), F.lit("}"))


def write_jsonl(df: DataFrame, path: str, raw: Sequence[str] = ("context",), mode: str = "errorifexists") -> None:
    """Rows as JSONL; a folder named ``*.jsonl`` is read back as such."""
    df.select(json_line(df, raw).alias("value")).write.mode(mode).text(path)


def write_summary(summary: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A one-row summary as an indented JSON object."""
    line = F.to_json(F.struct(*summary.columns), {"ignoreNullFields": "false"})
    summary.select(indented(line).alias("value")).coalesce(1).write.mode(mode).text(path)


def write_splits(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """All splits as one dataset, one folder per split."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def read_splits(spark: SparkSession, path: str, names: Sequence[str] = ("train", "validation")) -> DataFrame:
    """Some splits of a written dataset; the other folders are not opened."""
    return spark.read.parquet(path).filter(F.col("split").isin(*names))


def read_split_files(spark: SparkSession, paths: dict[str, str], schema: str) -> DataFrame:
    """JSONL files per split name as one table with a ``split`` column."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    parts = [reader.json(path).withColumn("split", F.lit(name)) for name, path in paths.items()]
    return reduce(DataFrame.unionByName, parts)
