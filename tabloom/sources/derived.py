"""Stand-ins for the two input tables, derived row by row from `lineitem`.

The test tables hold neither dataset and no missing values, so both shapes (29
and 35 columns) are derived from real columns plus a hash of the row key. Every
derivation is a map over the scan. A small input is dealt over INGEST_PARTITIONS
and written once per application as a Parquet table in the shared folder. A larger
one has splits of its own and is never shuffled: queries of one pass read the
derivation itself, of which Spark computes the columns they use, and queries of many
passes (`stored`) read a Parquet table written once. A filter on many columns takes
hashes that are generated once a row (`filtered`). The expressions are
plain SQL that Spark and DuckDB read alike; only the hash is spelled differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.config import CLAIMS_COLUMNS, SIGNAL_FEATURES, SIGNAL_LABEL
from tabloom.functions.hashing import row_hash
from tabloom.session import compile_wide_stages, fresh_path
from tabloom.sources.csv import scan_csv_header, scan_csv_positional
from tabloom.sources.tables import read_table

ROW_ID = "row_id"
# Files of a table derived from a small input, whatever the number of cores or input files.
INGEST_PARTITIONS = 32
# Input up to this size has too few splits to keep the cores busy and is dealt out.
DEALT_BYTES = 32 << 20
# A compressed file is read by one task, so a file holds at most this many rows.
CSV_COMPRESSION, CSV_FILE_ROWS = "gzip", 1_000_000
ROW_KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
ROW_ID_SQL = "concat_ws('-', " + ", ".join(f"CAST({k} AS STRING)" for k in ROW_KEYS) + ")"

# column -> salt of its row hash
HASHES = {
    "m": "m", "n": "n", "sp": "split", "fold_hash": "fold",
    "small": "small", "under": "under",
}
# Hashes that values are made of, not rates: these have a range of their own.
VALUES, VALUE_RANGE = ("m", "n"), 1_000_000
# Two 60-bit words per digest, five 12-bit numbers per word.
WORDS = {f"w{d}{half}": (f"wide{d}", 1 + 15 * half) for d in range(3) for half in range(2)}


def _piece(i: int) -> str:
    word = list(WORDS)[i // 5]
    return f"1 + (({word} >> {12 * (i % 5)}) & 4095) / 4096.0E0"


SIGNAL_SQL = {
    SIGNAL_LABEL: (
        "CASE WHEN 2 * l_quantity / 50 + l_extendedprice / 50000 - 10 * l_discount + n / 1000000.0E0"
        " > 2.3E0 THEN 1.0E0 ELSE 0.0E0 END"
    ),
    **dict(
        zip(
            SIGNAL_FEATURES,
            (
                "l_quantity", "l_extendedprice", "l_discount", "l_tax", "CAST(l_linenumber AS DOUBLE)",
                *(_piece(i) for i in range(len(SIGNAL_FEATURES) - 5)),
            ),
        )
    ),
}

# Text as a CSV scan delivers it, with a few unusable values.
SIGNAL_TEXT_SQL = {name: f"CAST({sql} AS STRING)" for name, sql in SIGNAL_SQL.items()}
for _name, _mod, _bad in (
    ("missing energy magnitude", 97, "'n/a'"),
    ("missing energy phi", 89, "NULL"),
    ("jet 1 pt", 83, "'NaN'"),
):
    SIGNAL_TEXT_SQL[_name] = f"CASE WHEN m % {_mod} = 0 THEN {_bad} ELSE {SIGNAL_TEXT_SQL[_name]} END"


def _text(sql: str, *gaps: tuple[str, str]) -> str:
    cases = "".join(f" WHEN {condition} THEN {value}" for condition, value in gaps)
    return f"CASE{cases} ELSE CAST({sql} AS STRING) END" if gaps else f"CAST({sql} AS STRING)"


CLAIMS_SQL = {
    "Row_ID": ROW_ID_SQL,
    "Household_ID": _text("l_orderkey"),
    "Vehicle": _text("l_linenumber"),
    "Calendar_Year": _text("year(l_shipdate)"),
    "Model_Year": _text("year(l_shipdate) - m % 20"),
    "Blind_Make": "concat('M', CAST(l_suppkey % 20 AS STRING))",
    "Blind_Model": "concat('M', CAST(l_suppkey % 20 AS STRING), '.', CAST(l_partkey % 50 AS STRING))",
    "Blind_Submodel": "concat('S', CAST(l_partkey AS STRING), '.', CAST(l_suppkey AS STRING))",
    "Cat1": _text("l_returnflag", ("m % 9 = 0", "'?'"), ("m % 11 = 0", "NULL")),
    "Cat2": _text("l_linestatus", ("m % 5 < 2", "'?'"), ("m % 7 = 0", "NULL")),
    "Cat3": _text("l_linestatus"),
    "Cat4": _text("l_partkey % 10", ("m % 8 = 0", "'?'")),
    "Cat5": _text("l_suppkey % 5", ("m % 7 < 3", "'?'")),
    "Cat6": _text("month(l_shipdate)", ("m % 6 = 1", "NULL")),
    "Cat7": _text("concat(l_returnflag, l_linestatus)", ("m % 10 < 6", "'?'")),
    "Cat8": _text("l_linenumber % 3"),
    "Cat9": _text("l_partkey % 25", ("m % 29 = 0", "NULL")),
    "Cat10": _text("l_suppkey % 4", ("m % 31 = 0", "'?'")),
    # one value holds a third of all rows
    "Cat11": _text("concat('K', CAST(l_partkey % 40 AS STRING))", ("m % 3 = 0", "'hot'")),
    "Cat12": _text("l_returnflag", ("m % 4 < 3", "NULL")),
    "OrdCat": _text("l_linenumber", ("m % 13 = 0", "'?'")),
    "Var1": _text("l_quantity", ("m % 17 = 0", "NULL"), ("m % 19 = 0", "'?'")),
    "Var2": _text("l_tax", ("m % 5 < 2", "NULL")),
    "Var3": _text("l_extendedprice", ("m % 23 = 0", "'NaN'")),
    "Var4": _text("l_discount", ("m % 43 = 0", "NULL")),
    "Var5": _text("l_partkey % 1000"),
    "Var6": _text("l_suppkey", ("m % 47 = 0", "'n/a'")),
    "Var7": _text("m % 1000", ("m % 53 = 0", "'?'"), ("m % 59 = 0", "'NaN'")),
    "Var8": _text("l_orderkey % 100", ("m % 61 = 0", "NULL")),
    "NVCat": _text("concat('N', CAST(l_orderkey % 6 AS STRING))", ("m % 37 = 0", "NULL"), ("m % 41 = 0", "'?'")),
    "NVVar1": _text("l_quantity * 2", ("m % 67 = 0", "NULL")),
    "NVVar2": _text("l_discount"),
    "NVVar3": _text("l_tax", ("m % 71 = 0", "'bad'")),
    "NVVar4": _text("m % 100"),
    "Claim_Amount": (
        "CASE WHEN m % 50 = 0 THEN 'n/a' WHEN m % 50 = 1 THEN NULL WHEN m % 50 = 2 THEN '0.5'"
        " WHEN l_quantity >= 42 AND n / 1000000.0E0 < 0.55E0 THEN CAST(l_extendedprice / 100 AS STRING)"
        " ELSE '0' END"
    ),
}


def is_small(spark: SparkSession, folder: str) -> bool:
    """Whether the files of `lineitem` hold at most DEALT_BYTES."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/lineitem.parquet")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(path).getLength() <= DEALT_BYTES


def hashed_lineitem(
    spark: SparkSession, folder: str, partitions: int = INGEST_PARTITIONS, once: tuple[str, ...] = ()
) -> DataFrame:
    """`lineitem` with its row key and the hash columns the derivations use; a small one is dealt by row key.

    The columns of `once` are computed once a row, used or not. A filter on derived columns is otherwise moved below
    the hashes, and computes them anew wherever its condition mentions them.
    """
    rows = read_table(spark, folder, "lineitem")
    if is_small(spark, folder):
        rows = rows.repartition(partitions, *ROW_KEYS)
    rows = rows.withColumn(ROW_ID, F.expr(ROW_ID_SQL))
    hashes = {
        **{
            name: row_hash(salt, ROW_ID) % VALUE_RANGE if name in VALUES else row_hash(salt, ROW_ID)
            for name, salt in HASHES.items()
        },
        **{
            name: F.conv(
                F.substring(F.md5(F.concat(F.lit(f"{salt}:"), F.col(ROW_ID))), start, 15), 16, 10
            ).cast("bigint")
            for name, (salt, start) in WORDS.items()
        },
    }
    if once:
        # No filter on generated columns is moved below the generator.
        rows = rows.select("*", F.inline(F.array(F.struct(*(hashes.pop(name).alias(name) for name in once)))))
    return rows.withColumns(hashes)


def _derive(rows: DataFrame, columns: dict[str, str], *keep: str) -> DataFrame:
    return rows.select(*keep, *(F.expr(sql).alias(name) for name, sql in columns.items()))


_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, folder: str, name: str, write) -> str:
    """Path of a derived data set, written on first use by this application."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _written:
        path = fresh_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def release(spark: SparkSession) -> None:
    """Delete the derived tables this application wrote; they are written again on the next use."""
    own = [key for key in _written if key[0] == spark.sparkContext.applicationId]
    jvm = spark.sparkContext._jvm
    for key in own:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop(key))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _table(spark: SparkSession, folder: str, name: str, derive, stored: bool, once: tuple[str, ...] = ()) -> DataFrame:
    compile_wide_stages(spark)
    if not stored and not is_small(spark, folder):
        return derive(hashed_lineitem(spark, folder, once=once))
    path = _once(spark, folder, name, lambda p: derive(hashed_lineitem(spark, folder)).write.parquet(p))
    return spark.read.parquet(path)


def signal(spark: SparkSession, folder: str, stored: bool = False) -> DataFrame:
    """row_id, label, 28 doubles."""
    return _table(spark, folder, "signal", lambda rows: _derive(rows, SIGNAL_SQL, ROW_ID), stored)


def signal_text(spark: SparkSession, folder: str, stored: bool = False) -> DataFrame:
    """row_id and the 29 columns as text, in file order."""
    return _table(spark, folder, "signal_text", lambda rows: _derive(rows, SIGNAL_TEXT_SQL, ROW_ID), stored)


def claims(spark: SparkSession, folder: str, stored: bool = False, filtered: bool = False) -> DataFrame:
    """The 35 claims columns as text, in file order; `filtered` where a condition mentions many of them."""
    ordered = {c: CLAIMS_SQL[c] for c in CLAIMS_COLUMNS}
    return _table(spark, folder, "claims", lambda rows: _derive(rows, ordered), stored, VALUES if filtered else ())


def signal_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The signal table after a round trip through header-less, compressed CSV files."""
    rows = signal_text(spark, folder).drop(ROW_ID)
    path = _once(spark, folder, "signal_csv", lambda p: rows.write.option("maxRecordsPerFile", CSV_FILE_ROWS).csv(p, compression=CSV_COMPRESSION))
    return scan_csv_positional(spark, path)


def claims_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The claims table after a round trip through compressed CSV files with a header."""
    rows = claims(spark, folder)
    path = _once(spark, folder, "claims_csv", lambda p: rows.write.option("maxRecordsPerFile", CSV_FILE_ROWS).csv(p, header=True, compression=CSV_COMPRESSION))
    return scan_csv_header(spark, path)
