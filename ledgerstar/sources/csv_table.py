"""Header CSV under a contract: read as text by name, parse to types, set bad rows aside."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.contracts import Contract, exact, quoted
from ledgerstar.functions.cells import MISSING_TEXTS, parse, text_or_null
from ledgerstar.session import Scratch

MALFORMED = "_malformed_line"
SOURCE_FILE = "_source_file"
RAW_RECORD = "raw_record"
_RANGE = "_range_start"
# Small broken files that may be named in a plan.
MAX_WHOLE_FILES = 100
REJECT_REASON = "reject_reason"


class SourceError(RuntimeError):
    """The source cannot be read at all."""


def header_of(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names of the first file; Spark reads its first record only."""
    try:
        return spark.read.options(**_format(multi_line=True)).csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise SourceError(f"there is nothing to read at {path}") from error
        raise SourceError(f"{path} cannot be read as CSV: {error}") from error


def _ends_inside(line: str, inside: int) -> str:
    """SQL: 1 if a line that begins outside or inside a quoted cell ends inside one, else 0.

    The line is cut at its quotes. A quote opens a cell only at the cell's start, and closes one unless
    another follows at once. States are 0 outside, 1 inside and 2 just closed.
    """
    first = f"split({line}, '\"')[0]" if inside else f"concat(',', split({line}, '\"')[0])"
    step = (
        "named_struct('state', CASE WHEN s.state = 1 THEN 2 WHEN s.state = 2 AND s.before = '' THEN 1 "
        "WHEN s.before LIKE '%,' THEN 1 ELSE 0 END, 'before', piece)"
    )
    pieces = f"slice(split({line}, '\"'), 2, length({line}))"
    start = f"named_struct('state', {inside}, 'before', {first})"
    walked = f"aggregate({pieces}, {start}, (s, piece) -> {step}, s -> IF(s.state = 1, 1, 0))"
    return f"IF(instr({line}, '\"') = 0, {inside}, {walked})"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line as it stands, with its file and the byte at which its range of the file starts."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias(_RANGE),
        F.col("_metadata.file_size").alias("size"),
    )


def _range_bytes(spark: SparkSession) -> int:
    return spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def files_with_broken_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``_source_file, size`` of the files in which a line ends inside quotes: a record goes on in the next one.

    One text scan; lines without a quote are not looked into.
    """
    opens = F.expr(_ends_inside("value", 0)) == 1
    return _lines(spark, path).filter(opens).select(SOURCE_FILE, "size").distinct()


def _with_states(rows: DataFrame, keys: list[str], place: str) -> DataFrame:
    """``rows`` with the state before each one, ``before_0`` and ``before_1``, for both states at the start.

    A row that ends in ``from_0`` or ``from_1`` keeps the state, turns it, or sets it whatever it was. So the
    state is the one last set, or the one at the start, turned as often as rows have turned it since.
    """
    order = Window.partitionBy(*keys).orderBy(place)
    turns = F.sum(F.when((F.col("from_0") == 1) & (F.col("from_1") == 0), 1).otherwise(0)).over(order)
    odd = (F.col("_turns") % 2).cast("int")
    sets = F.when(F.col("from_0") == F.col("from_1"), F.col("from_0")).bitwiseXOR(odd)
    walked = rows.withColumn("_turns", turns).withColumn("_fixed", F.last(sets, True).over(order))
    walked = walked.withColumn("_odd", F.lag(odd, 1, 0).over(order)).withColumn("_fixed", F.lag("_fixed").over(order))
    states = {f"before_{start}": F.coalesce("_fixed", F.lit(start)).bitwiseXOR(F.col("_odd")) for start in (0, 1)}
    return walked.withColumns(states).drop("_turns", "_fixed", "_odd")


def records_of(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """``record, _source_file, first`` of files in which records may run over several lines.

    Files are read in ranges, as any text is. Each range is walked for both states that it may begin in, and
    one row for each range then tells which it was, how many records begin there, and which record its first
    lines belong to. No task holds more than a range and the records that begin in it.
    """
    numbered = lines.withColumn("line", F.monotonically_increasing_id()).selectExpr(
        "*", f"{_ends_inside('value', 0)} AS from_0", f"{_ends_inside('value', 1)} AS from_1"
    )
    here = [SOURCE_FILE, _RANGE]
    so_far = Window.partitionBy(*here).orderBy("line")
    walked = _with_states(numbered, here, "line").withColumns(
        {f"no_{i}": F.sum(1 - F.col(f"before_{i}")).over(so_far) for i in (0, 1)}
    )
    ends = {f"end_{i}": F.when(F.col(f"before_{i}") == 0, F.col("from_0")).otherwise(F.col("from_1")) for i in (0, 1)}
    walked = scratch.store(walked.select(*here, "line", "value", "no_0", "no_1", *[e.alias(n) for n, e in ends.items()]), "walked")

    ranges = walked.groupBy(*here).agg(
        *[F.max_by(f"end_{i}", "line").alias(f"from_{i}") for i in (0, 1)], *[F.max(f"no_{i}").alias(f"no_{i}") for i in (0, 1)]
    )
    begun = F.when(F.col("before_0") == 0, F.col("no_0")).otherwise(F.col("no_1"))
    earlier = Window.partitionBy(SOURCE_FILE).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(begun > 0, F.struct(F.col(_RANGE).alias("range"), begun.alias("no"))), True)
    known = _with_states(ranges, [SOURCE_FILE], _RANGE).select(*here, F.col("before_0").alias("start"), last.over(earlier).alias("owner"))

    number = F.when(F.col("start") == 0, F.col("no_0")).otherwise(F.col("no_1"))
    own = F.struct(F.col(_RANGE).alias("range"), number.alias("no"))
    owned = walked.join(known, here).select(
        SOURCE_FILE,
        F.when(number > 0, own).otherwise(F.col("owner")).alias("record_of"),
        F.struct(_RANGE, "line", "value").alias("part"),
    )
    parts = owned.groupBy(SOURCE_FILE, "record_of").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    text = F.array_join(F.transform("parts", lambda part: part["value"]), "\n")
    first = (F.col("record_of.range") == 0) & (F.col("record_of.no") == 1)
    return parts.select(F.regexp_replace(text, "\r$", "").alias("record"), SOURCE_FILE, first.alias("first"))


def _read_records(
    spark: SparkSession, path: str | list[str], broken: DataFrame, header: list[str], scratch: Scratch
) -> DataFrame:
    """The text columns of the broken files. Each must carry the header as its first record."""
    texts = ", ".join(f"{quoted(name)} string" for name in [*header, MALFORMED])
    options = {k: str(v) for k, v in _format(multi_line=True).items() if k in ("quote", "escape")}
    records = records_of(_lines(spark, path).join(broken, SOURCE_FILE, "left_semi"), scratch)
    plain = F.when(F.col("first"), F.regexp_replace("record", "^\ufeff", "")).otherwise(F.col("record"))
    cells = F.from_csv(plain, texts, {**options, "columnNameOfCorruptRecord": MALFORMED})
    read = records.filter(F.trim("record") != "").select(plain.alias("record"), cells.alias("cells"), SOURCE_FILE, "first")
    named = reduce(Column.__and__, [F.col("cells").getField(c).eqNullSafe(F.lit(c)) for c in header])
    checked = F.when(
        F.col("first") & ~(named & F.col("cells").getField(MALFORMED).isNull()),
        F.raise_error(F.concat(F.lit("another header in "), F.col(SOURCE_FILE))).cast("boolean"),
    ).otherwise(~F.col("first"))
    return read.filter(checked).select(*[F.col("cells").getField(c).alias(c) for c in [*header, MALFORMED]], SOURCE_FILE)


def read_text_table(spark: SparkSession, path: str | list[str], contract: Contract) -> DataFrame:
    """Contract columns as text, the whole line where its field count does not fit, and the file.

    Columns bind by header name, and a file whose header differs from the first one fails the read:
    a plain typed schema would bind by position and load values under the wrong names. Files that hold
    line breaks inside quotes are read by ranges whose records are put together again, or whole where that is
    one range; all others are split by line. So no part of a record is ever taken for a record, and no file is one task's work.
    """
    header = header_of(spark, path)
    contract.check_header(header)
    scratch = Scratch(spark)
    broken = scratch.store(files_with_broken_lines(spark, path), "broken")
    columns = [*[exact(c) for c in contract.columns], MALFORMED]
    lines = _by_header(spark.read, header, multi_line=False).csv(path)
    whole = lines.select(*columns, F.col("_metadata.file_path").alias(SOURCE_FILE))
    if broken.isEmpty():
        return whole
    # A relation and not a list: very many files may hold breaks.
    split = whole.join(broken, SOURCE_FILE, "left_anti").select(*columns, SOURCE_FILE)
    few = broken.limit(MAX_WHOLE_FILES + 1).collect()
    if len(few) <= MAX_WHOLE_FILES and all(r.size <= _range_bytes(spark) for r in few):
        # Each of them is one range anyway, and Spark's own reader finds the records of a whole file.
        records = _by_header(spark.read, header, multi_line=True).csv([r[SOURCE_FILE] for r in few])
        return records.select(*columns, F.col("_metadata.file_path").alias(SOURCE_FILE)).unionAll(split)
    return _read_records(spark, path, broken, header, scratch).select(*columns, SOURCE_FILE).unionAll(split)


def stream_text_table(
    spark: SparkSession,
    folder: str,
    contract: Contract,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The same rows, as a stream of the files that arrive in ``folder``.

    All files must carry the contract's columns in its order; another header fails the batch. Nothing
    is known of a file before it is read, so each is read record by record in one task.
    """
    reader = _by_header(spark.readStream, contract.columns, multi_line=True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder).select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def parse_table(
    text: DataFrame, contract: Contract, missing: tuple[str, ...] = MISSING_TEXTS
) -> DataFrame:
    """Typed contract columns with ``reject_reason``; rejected rows keep their text as JSON.

    A non-missing text that does not spell its type makes the row ``unparseable``; it is never
    turned into a NULL that looks like a missing value.
    """
    names = {f.name: quoted(f.name) for f in contract.fields}
    texts = {f.name: f"_text{i}" for i, f in enumerate(contract.fields)}
    cells = {f.name: f"_cell{i}" for i, f in enumerate(contract.fields)}
    rest = [SOURCE_FILE] if SOURCE_FILE in text.columns else []
    marked = text.selectExpr(
        *[f"{names[c]} AS {texts[c]}" for c in names],
        *[f"{text_or_null(names[c], missing)} AS {cells[c]}" for c in names],
        MALFORMED,
        *rest,
    )
    typed = marked.selectExpr(
        *[f"{parse(cells[f.name], f.type)} AS {names[f.name]}" for f in contract.fields], "*"
    )
    doubts = [f"({cells[c]} IS NOT NULL AND {names[c]} IS NULL)" for c in names]
    line = ", ".join(f"{texts[c]} AS {names[c]}" for c in names)
    return typed.selectExpr(
        *names.values(),
        f"coalesce({MALFORMED}, to_json(struct({line}))) AS {RAW_RECORD}",
        f"""CASE WHEN {MALFORMED} IS NOT NULL THEN 'malformed'
                 WHEN {" OR ".join(doubts)} THEN 'unparseable' END AS {REJECT_REASON}""",
        *rest,
    )


def files_of(df: DataFrame) -> list[str]:
    """Files a frame reads, in name order."""
    return sorted(df.inputFiles())


def _format(multi_line: bool) -> dict[str, object]:
    return {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "encoding": "UTF-8"}


def _by_header(reader, header: list[str], multi_line: bool):
    """Text columns named by ``header``, which every file must repeat, plus the misshapen lines."""
    fields = [T.StructField(name, T.StringType()) for name in [*header, MALFORMED]]
    return reader.schema(T.StructType(fields)).options(
        **_format(multi_line),
        enforceSchema=False,
        columnNameOfCorruptRecord=MALFORMED,
        columnPruning=False,  # a pruned parser would not see the field count
    )
