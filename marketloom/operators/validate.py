"""Validation of raw documents: every rule's errors, collected per document.

A document is one row, and its records are checked inside the row with array
functions. No records are shuffled, whatever their number per document.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom import config
from marketloom.functions import json_rules as J
from marketloom.functions.parsing import FIRST_DAY, LAST_DAY
from marketloom.sources.raw import RAW_FOLDERS, file_system, safe_symbol

# Fields of a document and of its records, and the array slots.
TOP_LEVEL_FIELDS = ["source", "symbol", "start_date", "end_date", "interval", "records"]
PRICE_FIELDS = ["Open", "High", "Low", "Close", "Volume"]
ARRAY_SLOTS = [
    "open_time",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "volume",
    "close_time",
    "quote_asset_volume",
    "number_of_trades",
    "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume",
]
INTEGER_SLOTS = {"open_time", "close_time", "number_of_trades"}
ARRAY_LENGTH = 12


def expected_files(
    assets: DataFrame, root: str, run_date: str, order: Sequence[str] = ()
) -> DataFrame:
    """One row per file that a run must have landed.

    ``file_no`` counts them in the manifest's order: equities, FX, crypto, each as ``order``
    lists the symbols, and by symbol beyond that. The window holds a row per file of a run.
    """
    classes = ["equity", "fx", "crypto"]
    group = F.array_position(F.array(*[F.lit(k) for k in classes]), F.col("asset_class"))
    place = F.array_position(
        F.array(*[F.lit(s) for s in order]).cast("array<string>"), F.col("symbol")
    )
    manifest = Window.orderBy(group, F.nullif(place, F.lit(0)).asc_nulls_last(), "symbol")

    def by_class(values: dict[str, str]) -> Column:
        pairs = [F.lit(x) for pair in values.items() for x in pair]
        return F.element_at(F.create_map(*pairs), F.col("asset_class"))

    folder = by_class({k: v[0] for k, v in RAW_FOLDERS.items()})
    source = by_class({k: v[1] for k, v in RAW_FOLDERS.items()})
    path = F.concat(
        F.lit(f"{root}/"), folder, F.lit("/source="), source, F.lit(f"/date={run_date}/"),
        safe_symbol(F.col("symbol")), F.lit(".json"),
    )
    return assets.select(
        group.alias("group_no"),
        F.row_number().over(manifest).cast("bigint").alias("file_no"),
        folder.alias("asset_class"),
        source.alias("source"),
        "symbol",
        path.alias("path"),
    )


def _python_text(value: str) -> str:
    """A value the way an error text shows it."""
    return (
        f"CASE schema_of_variant({value}) WHEN 'VOID' THEN 'None' "
        f"WHEN 'BOOLEAN' THEN initcap({J.text(value)}) ELSE {J.text(value)} END"
    )


def _mismatch(entries: str, name: str, expected: str) -> str:
    value = J.field(entries, name)
    same = f"({J.is_string('_v')} AND {J.text('_v')} = {expected})"
    got = f"concat('{name} mismatch: expected ', {expected}, ', got ', {_python_text('_v')})"
    return J.bind(value, "_v", f"CASE WHEN _v IS NOT NULL AND NOT {same} THEN {got} END")


def _boundary(entries: str, name: str) -> str:
    """A top-level date; NULL where it is missing, null or no date."""
    return J.bind(J.text(J.field(entries, name)), "_t", J.iso_date("_t"))


def _boundary_error(entries: str, name: str, date: str) -> str:
    value = J.field(entries, name)
    return (
        f"CASE WHEN {value} IS NOT NULL AND NOT is_variant_null({value}) AND {date} IS NULL "
        f"THEN 'top-level field {name} is not a valid date' END"
    )


def _label(pos: str, text: str) -> str:
    return f"concat('record ', {pos}, ' {text}')"


def _range_errors(day: str, pos: str) -> list[str]:
    """Errors of a record's day against the document's bounds, ``d.start`` and ``d.end``."""
    return [
        f"CASE WHEN {day} < d.start THEN {_label(pos, 'date is before start_date')} END",
        f"CASE WHEN {day} > d.end THEN {_label(pos, 'date is after end_date')} END",
    ]


def _errors(rules: list[str]) -> str:
    return f"array_compact(array({', '.join(rules)}))"


_NO_ERRORS = "cast(array() AS array<string>)"


def _record_errors(parsed: str, key: str, day: str, rules: str) -> str:
    """Errors of all records of ``d.records``, in order.

    ``parsed`` gives each record's value, pos, key, day and ``plain``: that all
    of its values are in the form they usually have, and right. Such a record is
    only compared with the others and with the document's bounds; the rules,
    which name what is wrong, run for the rest.
    """
    fine = (
        "p.plain AND NOT coalesce(again, false) "
        f"AND coalesce({day} >= d.start, true) AND coalesce({day} <= d.end, true)"
    )
    record = f"CASE WHEN {fine} THEN {_NO_ERRORS} ELSE {rules} END"
    flags = J.repeat_flags(f"transform(ps, p -> p.{key})")
    return J.bind(parsed, "ps", f"flatten(zip_with(ps, {flags}, (p, again) -> {record}))")


def _struct_record_errors() -> str:
    """Errors of Date/Open/High/Low/Close/Volume objects."""
    repeated = f"concat({_label('p.pos', 'has duplicate date ')}, p.day)"
    rules = [
        f"CASE WHEN {J.field('_e', 'Date')} IS NULL "
        f"THEN {_label('p.pos', 'missing field Date')} "
        f"WHEN p.day IS NULL THEN {_label('p.pos', 'field Date is not a valid date')} END",
        f"CASE WHEN again THEN {repeated} END",
        *_range_errors("p.day", "p.pos"),
    ]
    for name in PRICE_FIELDS:
        missing = _label("p.pos", f"missing field {name}")
        wrong = J.number_error("_v", _label("p.pos", f"field {name}"))
        rules.append(
            J.bind(
                J.field("_e", name),
                "_v",
                f"CASE WHEN _v IS NULL THEN {missing} ELSE {wrong} END",
            )
        )
    not_object = f"array({_label('p.pos', 'is not an object')})"
    named = J.bind(
        J.fields("p.value"),
        "_e",
        f"CASE WHEN _e IS NULL THEN {not_object} ELSE {_errors(rules)} END",
    )
    typed = "struct<Date string, " + ", ".join(f"{f} double" for f in PRICE_FIELDS) + ">"
    # Numbers in texts have forms of their own, which the rules look at; the date
    # is the one text of a plain record.
    one_text = "locate('STRING', s, locate('STRING', s) + 1) = 0"
    no_texts = J.bind("schema_of_variant(r)", "s", one_text)
    plain = " AND ".join(["q.day IS NOT NULL", *(f"t.{f} >= 0" for f in PRICE_FIELDS), no_texts])
    record = J.bind(
        f"try_variant_get(r, '$', '{typed}')",
        "t",
        J.bind(
            f"named_struct('day', {J.record_date('t.Date')})",
            "q",
            "named_struct('value', r, 'pos', i, 'day', q.day, "
            f"'plain', coalesce({plain}, false))",
        ),
    )
    return _record_errors(f"transform(d.records, (r, i) -> {record})", "day", "p.day", named)


def _has_day(opened: str) -> str:
    """Whether an open time lies in the years that dates have; NULL for a missing one."""
    return f"(floor({opened} / 86400000) BETWEEN {FIRST_DAY} AND {LAST_DAY})"


def _array_record_errors() -> str:
    """Errors of positional lists of at least 12 values."""

    def slot(values: str, name: str) -> str:
        return f"get({values}, {ARRAY_SLOTS.index(name)})"

    rules = []
    for name in ARRAY_SLOTS:
        check = J.integer_error if name in INTEGER_SLOTS else J.number_error
        wrong = check("_v", _label("p.pos", f"field {name}"))
        rules.append(J.bind(slot("_e", name), "_v", wrong))
    late = _label("p.pos", "close_time must be greater than open_time")
    repeated = f"concat({_label('p.pos', 'has duplicate open_time ')}, p.opened)"
    no_day = _label("p.pos", "field open_time is out of range")
    whole_days = "try_cast(floor(p.opened / 86400000) AS INT)"
    day = (
        f"date_add(date'1970-01-01', CASE WHEN {_has_day('p.opened')} THEN {whole_days} END)"
    )
    rules += [
        f"CASE WHEN p.closed <= p.opened THEN {late} END",
        f"CASE WHEN again THEN {repeated} END",
        f"CASE WHEN NOT {_has_day('p.opened')} THEN {no_day} END",
        *_range_errors(day, "p.pos"),
    ]
    named = J.bind(
        J.elements("p.value"),
        "_e",
        f"CASE WHEN _e IS NULL THEN array({_label('p.pos', 'is not a list')}) "
        f"WHEN size(_e) < {ARRAY_LENGTH} "
        f"THEN array({_label('p.pos', f'has fewer than {ARRAY_LENGTH} fields')}) "
        f"ELSE {_errors(rules)} END",
    )

    def whole(plain: str, name: str) -> str:
        careful = J.bind(
            slot("_l", name),
            "_v",
            J.bind(J.integer("_v"), "_n", "CASE WHEN _n >= 0 THEN _n END"),
        )
        long_enough = J.bind(
            J.elements("r"), "_l", f"CASE WHEN size(_l) >= {ARRAY_LENGTH} THEN {careful} END"
        )
        return f"CASE WHEN {plain} THEN bigint({slot('t', name)}) ELSE {long_enough} END"

    is_plain = (
        f"size(t) >= {ARRAY_LENGTH} "
        f"AND array_join(slice(t, 1, {len(ARRAY_SLOTS)}), ',') RLIKE '{J.PLAIN_LIST}'"
    )
    times = (
        f"named_struct('opened', {whole('q', 'open_time')}, "
        f"'closed', {whole('q', 'close_time')})"
    )
    record = J.bind(
        "try_variant_get(r, '$', 'array<string>')",
        "t",
        J.bind(
            f"coalesce({is_plain}, false)",
            "q",
            J.bind(
                times,
                "w",
                "named_struct('value', r, 'pos', i, 'opened', w.opened, 'closed', w.closed, "
                f"'plain', q AND w.closed > w.opened AND {_has_day('w.opened')})",
            ),
        ),
    )
    return _record_errors(f"transform(d.records, (r, i) -> {record})", "opened", day, named)


def payload_errors(document: str, source: str, symbol: str, record_rules: bool = True) -> str:
    """Errors of a parsed document, given the source and symbol it should hold.

    Top-level errors come first, then each record's in record order; without ``record_rules``
    those of the document and its list of records alone.
    """
    top = [
        f"CASE WHEN {J.field('d.entries', name)} IS NULL "
        f"THEN 'missing top-level field {name}' END"
        for name in TOP_LEVEL_FIELDS
    ] + [
        _mismatch("d.entries", "source", source),
        _mismatch("d.entries", "symbol", symbol),
        _boundary_error("d.entries", "start_date", "d.start"),
        _boundary_error("d.entries", "end_date", "d.end"),
    ]
    unsupported = f"concat('unsupported source for record validation: ', {source})"
    records = (
        f"CASE WHEN {J.field('d.entries', 'records')} IS NULL "
        f"THEN {_NO_ERRORS} "
        "WHEN d.records IS NULL THEN array('records is not a list') "
        "WHEN size(d.records) = 0 THEN array('records is empty') "
        f"WHEN {source} = 'yahoo' THEN {_struct_record_errors() if record_rules else _NO_ERRORS} "
        f"WHEN {source} = 'binance' THEN {_array_record_errors() if record_rules else _NO_ERRORS} "
        f"ELSE array({unsupported}) END"
    )
    parts = (
        "named_struct('entries', _m, "
        f"'records', {J.elements(J.field('_m', 'records'))}, "
        f"'start', {_boundary('_m', 'start_date')}, 'end', {_boundary('_m', 'end_date')})"
    )
    checked = J.bind(parts, "d", f"concat({_errors(top)}, {records})")
    of_object = J.bind(
        J.fields(document),
        "_m",
        f"CASE WHEN _m IS NULL THEN array('top-level JSON is not an object') ELSE {checked} END",
    )
    return (
        f"CASE WHEN {document} IS NULL THEN array('file is not valid JSON') ELSE {of_object} END"
    )


def validate_documents(documents: DataFrame, record_rules: bool = True) -> DataFrame:
    """Add ``errors`` to rows of (source, symbol, text): expected values and raw text.

    Without ``record_rules`` only errors of the document itself, none that begin with "record ".
    Sets the session to accept objects that hold a key twice.
    """
    # As JSON parsers do, the last value of a key that an object holds twice counts.
    documents.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    rules = payload_errors("_doc", "source", "symbol", record_rules)
    errors = J.bind(J.document("text"), "_doc", rules)
    return documents.withColumn("errors", F.expr(errors)).drop("text")


def with_status(results: DataFrame) -> DataFrame:
    return results.withColumn(
        "status", F.when(F.size("errors") == 0, F.lit("valid")).otherwise(F.lit("invalid"))
    )


def _comparable(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


# Bytes of files that a task hands on at a time.
HELD_BYTES = 8 << 20


def _looked_up(
    batches: Iterator[pa.RecordBatch], folders: Sequence[str]
) -> Iterator[pa.RecordBatch]:
    """Paths that exist: folders, empty files, and with their contents files below ``folders``."""
    below = tuple(f"{file_system(folder)[1].rstrip('/')}/" for folder in folders)
    kinds = [pa.string()] * 3 + [pa.bool_(), pa.int64(), pa.binary()]
    names = ["_key", "source", "symbol", "is_folder", "file_size_bytes", "content"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    rows, held = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            files, place = file_system(row["path"])
            found = files.get_file_info(place)
            known = row["_key"], row["source"], row["symbol"]
            if found.type == fs.FileType.Directory:
                rows.append((*known, True, None, None))
            elif found.type == fs.FileType.File and found.size == 0:
                rows.append((*known, False, 0, None))
            elif found.type == fs.FileType.File and place.startswith(below):
                with files.open_input_stream(place) as source:
                    content = source.read()
                rows.append((*known, False, len(content), content))
                held += len(content)
            if held > HELD_BYTES or len(rows) >= 1000:
                yield batch_of(rows)
                rows, held = [], 0
    if rows:
        yield batch_of(rows)


def validate_files(spark: SparkSession, manifest: DataFrame, folders: list[str]) -> DataFrame:
    """Validate the manifest's files below the run's partition folders.

    Tasks look up and read the expected files by their paths, so no folder is listed, whatever it
    holds; that takes a file system known to pyarrow. One row per expected file: asset_class,
    source, symbol, path, status, file_size_bytes, errors.
    """
    expected = manifest.withColumn("_key", _comparable(F.col("path")))
    # Reading and checking are this step's work; left open, the few bytes of the paths would
    # be one task's.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = expected.select("_key", "path", "source", "symbol").repartition(partitions, "_key")
    schema = (
        "_key string, source string, symbol string, is_folder boolean, file_size_bytes long, "
        "content binary"
    )
    found = asked.mapInArrow(lambda b: _looked_up(b, folders), schema)
    texts = found.withColumn("text", F.try_validate_utf8(F.col("content").cast("string")))
    checked = validate_documents(texts).select(
        "_key",
        "is_folder",
        "file_size_bytes",
        F.when(F.col("content").isNotNull(), F.col("errors")).alias("payload_errors"),
    )
    return file_results(expected, checked).drop("_key")


def validate_lines(spark: SparkSession, manifest: DataFrame, folders: list[str]) -> DataFrame:
    """``validate_files`` for documents landed as JSON Lines, found by folder and symbol.

    ``path`` is that of the manifest; a symbol without a document has a missing file, and
    one with several documents is an error.
    """
    present = [f for f in folders if _exists(spark, f)]
    if present:
        reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
        lines = reader.text(present).select(
            F.col("value").alias("text"), F.col("_metadata.file_path").alias("file")
        )
    else:
        lines = spark.createDataFrame([], "text string, file string")
    place = r"([^/]+)/source=([^/]+)/date=[^/]+/"
    found = lines.select(
        F.regexp_extract("file", place, 1).alias("_class"),
        F.regexp_extract("file", place, 2).alias("_source"),
        F.get_json_object("text", "$.symbol").alias("_symbol"),
        "text",
    )
    keys = [F.col("asset_class") == F.col("_class"), F.col("source") == F.col("_source")]
    keys.append(F.col("symbol") == F.col("_symbol"))
    expected = manifest.withColumn("_key", F.col("path"))
    matched = found.join(expected.select("_key", "asset_class", "source", "symbol"), keys)
    checked = validate_documents(matched.select("_key", "source", "symbol", "text"))
    several = F.when(F.count(F.lit(1)) > 1, F.lit("symbol has more than one document"))
    merged = checked.groupBy("_key").agg(
        F.array_compact(
            F.concat(F.array(several), F.flatten(F.array_sort(F.collect_list("errors"))))
        ).alias("payload_errors")
    )
    checked = merged.withColumn("file_size_bytes", F.lit(None).cast("bigint"))
    hidden = spark.createDataFrame([], "_key string, is_folder boolean")
    return file_results(expected, checked, hidden).drop("_key")


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def file_results(
    expected: DataFrame, checked: DataFrame, hidden: DataFrame | None = None
) -> DataFrame:
    """Status and errors per expected file, joined on ``_key``.

    ``checked`` has the payload errors of the readable files, ``hidden`` the
    entries that are folders or empty files, which may be rows of ``checked`` instead.
    """
    extension = F.when(
        ~F.lower("path").rlike(r"[^/]\.json$"), F.lit("file extension is not .json")
    )
    state = (
        F.when(F.col("payload_errors").isNotNull(), F.col("payload_errors"))
        .when(F.col("is_folder"), F.array(F.lit("path is not a file")))
        .when(~F.col("is_folder"), F.array(F.lit("file is empty")))
        .otherwise(F.array(F.lit("file does not exist")))
    )
    size = F.coalesce("file_size_bytes", F.when(~F.col("is_folder"), F.lit(0).cast("bigint")))
    joined = expected.join(checked, "_key", "left")
    if hidden is not None:
        joined = joined.join(hidden, "_key", "left")
    return with_status(
        joined.select(
            *expected.columns,
            size.alias("file_size_bytes"),
            F.concat(F.array_compact(F.array(extension)), state).alias("errors"),
        )
    )


def summarize(
    results: DataFrame, failure_threshold: float = config.VALIDATION_FAILURE_THRESHOLD
) -> DataFrame:
    """Counts, failure rate and verdict, one row; the run fails above the threshold."""
    total, valid = F.col("total_files"), F.col("valid_count")
    rate = F.when(total > 0, (total - valid) / total).otherwise(F.lit(0.0))
    return (
        results.agg(
            F.count(F.lit(1)).alias("total_files"),
            F.count_if(F.col("status") == "valid").alias("valid_count"),
        )
        .withColumn("invalid_count", total - valid)
        .withColumn("failure_rate", rate)
        .withColumn("failure_threshold", F.lit(float(failure_threshold)))
        .withColumn("should_fail_run", F.col("failure_rate") > failure_threshold)
    )


def run_summary(run_log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Successful and failed landings per run."""
    ok = F.col("status") == "success"
    return run_log.groupBy(*(by or [])).agg(
        F.count_if(ok).alias("ingestion_successes"),
        F.count_if(~ok).alias("ingestion_failures"),
    )


def error_rows(results: DataFrame, *columns: str) -> DataFrame:
    """One row per error."""
    return results.select(*columns, F.posexplode("errors").alias("error_no", "error"))


def valid_files(results: DataFrame) -> DataFrame:
    return results.filter(F.size("errors") == 0)


def rejected_files(results: DataFrame, root: str, rejected_root: str) -> DataFrame:
    """Invalid files that exist, with their place in the parallel rejected tree."""
    under_root = F.col("path").startswith(f"{root}/")
    relative = F.when(under_root, F.substr("path", F.lit(len(root) + 2))).otherwise(
        F.substring_index("path", "/", -1)
    )
    return results.filter(
        (F.size("errors") > 0) & ~F.array_contains("errors", F.lit("file does not exist"))
    ).withColumn("rejected_path", F.concat(F.lit(f"{rejected_root}/"), relative))


def report_lines(
    results: DataFrame,
    order: list[str],
    failure_threshold: float = config.VALIDATION_FAILURE_THRESHOLD,
) -> DataFrame:
    """The validation report as lines: section 0 head, 1 files and errors, 2 verdict.

    ``order`` names the result columns that the file lines are sorted by.
    """
    summary = summarize(results, failure_threshold)
    is_valid = F.col("status") == "valid"
    file_line = F.format_string(
        "%-8s%-12s %s", F.when(is_valid, "VALID").otherwise("INVALID"), "symbol", "path"
    )
    errors = F.transform("errors", lambda e: F.concat(F.lit("        - "), e))
    files = results.select(
        F.lit(1).alias("section"),
        *order,
        F.posexplode(F.concat(F.array(file_line), errors)).alias("line_no", "line"),
    )
    head = F.format_string(
        "Validated %d expected Bronze files: %d valid, %d invalid",
        "total_files", "valid_count", "invalid_count",
    )
    verdict = F.array(
        F.format_string("Validation failure rate: %.2f%%", F.col("failure_rate") * 100),
        F.format_string("Validation failure threshold: %.2f%%", F.col("failure_threshold") * 100),
        F.concat(
            F.lit("Validation decision: "),
            F.when(F.col("should_fail_run"), "FAIL run").otherwise("PASS run"),
        ),
    )
    frame = F.array(
        F.struct(F.lit(0).alias("section"), F.array(head).alias("lines")),
        F.struct(F.lit(2).alias("section"), verdict.alias("lines")),
    )
    ends = summary.select(F.explode(frame).alias("s")).select(
        "s.section", F.posexplode("s.lines").alias("line_no", "line")
    )
    return files.unionByName(ends, allowMissingColumns=True).orderBy("section", *order, "line_no")
