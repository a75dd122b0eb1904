"""Landed trade files: newline-delimited JSON to typed, complete trades."""

from __future__ import annotations

import codecs
import gzip
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.calendar import iso_utc
from barlake.schemas import (
    CORE_TRADE_COLUMNS,
    EXTENDED_TRADE_COLUMNS,
    RAW_TRADE,
    REQUIRED_TRADE_KEYS,
    TRADE_COLUMN_OF,
    TRADE_FIELDS,
    TRADES,
)
from barlake.session import scratch_dir

FILE = "file_name"


def read_trade_lines(spark: SparkSession, *paths: str, skip_unreadable: bool = False) -> DataFrame:
    """Lines with the name of their file; gzip is undone by the reader.

    A damaged file fails the read. With ``skip_unreadable`` it yields one
    malformed line that says why, and none of its own: the report of
    ``parse_trades`` then names it as rejected.
    """
    if skip_unreadable:
        return whole_lines(spark.read.format("binaryFile").load(list(paths)))
    return spark.read.text(list(paths)).select("value", F.col("_metadata.file_name").alias(FILE))


UNREADABLE = "unreadable: "


PIECE = 1 << 20


def _pieces(content: pa.Buffer, packed: bool) -> Iterator[bytes]:
    with pa.BufferReader(content) as raw, (gzip.GzipFile(fileobj=raw) if packed else raw) as data:
        while piece := data.read(PIECE):
            yield piece


def _lines(content: pa.Buffer, packed: bool) -> Iterator[list[str]]:
    """``splitlines`` of the whole text, some lines at a time."""
    decoder, rest = codecs.getincrementaldecoder("utf-8")(errors="replace"), ""
    for piece in _pieces(content, packed):
        # the last line may go on, or its end may, in the next piece
        *lines, rest = (rest + decoder.decode(piece)).splitlines(keepends=True) or [""]
        yield [line.splitlines()[0] for line in lines]
    yield (rest + decoder.decode(b"", final=True)).splitlines()


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in pieces: a packed file is read to its end once before any of its lines goes out."""
    for batch in batches:
        for path, value in zip(batch.column("path"), batch.column("content")):
            name, content = path.as_py().rsplit("/", 1)[-1], value.as_buffer()
            packed = name.endswith(".gz") or content[:2].to_pybytes() == b"\x1f\x8b"
            found: Iterable[list[str]] = _lines(content, packed)
            try:
                for _ in _pieces(content, packed) if packed else ():
                    pass
            except (OSError, EOFError, zlib.error) as error:
                found = [[f"{UNREADABLE}{error}"]]
            for lines in found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lines, pa.string()), pa.array([name] * len(lines), pa.string())], names=["value", FILE])


def whole_lines(files: DataFrame) -> DataFrame:
    """Lines of files read as a whole (``binaryFile``), each file or nothing of it.

    The text reader hands out the lines before the damage and cannot take them
    back. A task holds a file as it is stored, packed, and a piece of its lines.
    """
    return files.select("path", "content").mapInArrow(_unpacked, f"value string, {FILE} string")


def decode_lines(lines: DataFrame) -> DataFrame:
    """Text values of every known key, plus ``malformed``; blank lines are dropped.

    Keys are read as text first: a bad number must become a null field, not a
    malformed record. Unknown keys vanish, absent ones are null.
    """
    schema = T.StructType(RAW_TRADE.fields + [T.StructField("_corrupt", T.StringType())])
    record = F.from_json(
        F.col("value"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    return (
        lines.filter(F.length(F.trim("value")) > 0)
        .withColumn("record", record)
        .withColumn(
            "malformed", F.col("record").isNull() | F.col("record._corrupt").isNotNull()
        )
    )


def _typed(key: str, column: str, kind: str) -> Column:
    text = F.col(f"record.{key}")
    if kind == "TIMESTAMP_NTZ":
        value = iso_utc(text)
    elif kind == "BOOLEAN":
        value = F.coalesce(text == "H", F.lit(False))
    elif kind == "BIGINT":
        value = F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
    elif kind == "DOUBLE":
        value = text.try_cast("double")
    else:
        value = text
    return value.alias(column)


def rename_trade_fields(decoded: DataFrame, *keep: str) -> DataFrame:
    """The 22 columns in fixed order and type, plus any ``keep`` columns."""
    return decoded.select(*[_typed(*field) for field in TRADE_FIELDS], *keep)


def file_report(decoded: DataFrame) -> DataFrame:
    """One row per file: lines, malformed lines, required columns seen nowhere in it."""
    return _report(decoded, {k: F.col(f"record.{k}").isNotNull() for k in REQUIRED_TRADE_KEYS})


def _report(decoded: DataFrame, present: dict[str, Column]) -> DataFrame:
    seen = {key: F.coalesce(F.bool_or(flag), F.lit(False)) for key, flag in present.items()}
    missing = F.array_compact(
        F.array(*[F.when(~seen[k], F.lit(TRADE_COLUMN_OF[k])) for k in REQUIRED_TRADE_KEYS])
    )
    return (
        decoded.groupBy(FILE)
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if("malformed").alias("malformed_lines"),
            F.array_join(missing, ",").alias("missing_fields"),
        )
        .withColumn(
            "accepted", (F.col("malformed_lines") == 0) & (F.col("missing_fields") == "")
        )
    )


def parse_trades(lines: DataFrame, keep_file: bool = False) -> tuple[DataFrame, DataFrame]:
    """File-strict mode: trades of accepted files, and the report on all files.

    Every line is decoded once, into a stage in the shared scratch folder; the
    report and the trades are both read from it.
    """
    decoded = decode_lines(lines)
    stage = scratch_dir(lines.sparkSession, "decoded")
    present = {f"_has_{k}": F.col(f"record.{k}").isNotNull() for k in REQUIRED_TRADE_KEYS}
    rename_trade_fields(decoded.withColumns(present), FILE, "malformed", *present).write.parquet(stage)
    typed = lines.sparkSession.read.parquet(stage)
    report = _report(typed, {k: F.col(f"_has_{k}") for k in REQUIRED_TRADE_KEYS})
    good = report.filter("accepted").select(FILE)
    trades = typed.join(good, FILE, "left_semi").select(*TRADES.names, *([FILE] if keep_file else []))
    return trades, report


def parse_trades_by_row(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Row mode: trades of sound rows, and the lines to quarantine with a reason."""
    decoded = decode_lines(lines)
    absent = F.lit(False)
    for key in REQUIRED_TRADE_KEYS:
        absent = absent | F.col(f"record.{key}").isNull()
    bad_time = iso_utc("record.lastTradeTime").isNull()
    reason = (
        F.when(F.col("malformed"), "malformed")
        .when(absent, "missing_field")
        .when(bad_time, "bad_time")
    )
    judged = decoded.withColumn("reason", reason)
    sound = rename_trade_fields(judged.filter(F.col("reason").isNull()))
    return sound, judged.filter(F.col("reason").isNotNull()).select(FILE, "value", "reason")


def trades_schema_projection(trades: DataFrame, extended: bool = False) -> DataFrame:
    """Core (10) or extended (18) columns; identifiers that repeat each other are dropped."""
    wanted = EXTENDED_TRADE_COLUMNS if extended else CORE_TRADE_COLUMNS
    source = {
        "algo_trade": F.col("algo_indicator"),
        "source": F.col("source_name"),
        "quote_type": F.col("quote_type").try_cast("tinyint"),
    }
    return trades.select(*[source.get(c, F.col(c)).alias(c) for c in wanted])


def schema_violations(df: DataFrame) -> list[tuple[str, str, str]]:
    """(column, expected, found) for required columns that are absent or mistyped."""
    found = {f.name: f.dataType for f in df.schema.fields}
    checked = {TRADE_COLUMN_OF[k] for k in REQUIRED_TRADE_KEYS} | {"exec_venue"}
    optional = {"exec_venue"}
    problems = []
    for field in TRADES.fields:
        if field.name not in checked:
            continue
        actual = found.get(field.name)
        if actual is None:
            if field.name not in optional:
                problems.append((field.name, field.dataType.simpleString(), "absent"))
        elif actual != field.dataType:
            problems.append((field.name, field.dataType.simpleString(), actual.simpleString()))
    return problems


def validate_trade_schema(df: DataFrame) -> DataFrame:
    problems = schema_violations(df)
    if problems:
        raise ValueError(f"trade schema does not hold: {problems}")
    return df
