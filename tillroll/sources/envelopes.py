"""Landed JSON files -> bronze records.

A landed file holds one or more JSON values: an envelope (an object with the
entity's records under its key, plus ``total``), or a bare list of records.  It
may be pretty-printed (one value over many lines, as the API client lands it)
or hold one value per line (as :func:`land` writes it).  Framing is found line
by line, never declared: a line that is an envelope or a list of objects by
itself is one; all other lines of a file are one value together.  Files of up to
``WHOLE_BYTES`` are put together for that; of larger ones
:mod:`tillroll.sources.framing` finds the records block by block.

A value is parsed once, records and all, with the declared schema.  Only a value
in which something does not fit is taken apart again: into the raw text of its
records, each parsed on its own, so that a record that does not fit the schema,
or a value that is no JSON of a known shape, becomes a quarantined row that keeps
its raw text.  So loaded plus quarantined rows account for all that was landed.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CART, ENTITIES
from ..sinks import stored
from .framing import framed_values

CORRUPT = "_corrupt_record"
# Lines of files up to this size are brought together where a value has many lines.
WHOLE_BYTES = 32 << 20
CART_HEADER = T.StructType([f for f in CART.fields if f.name != "products"])
LANDING_COLUMNS = ("_source", "_landed", "_total")
# ``<entity>_YYYYMMDD_HHMMSS``: the name of one fetch, a file or a folder of part files.
FETCH = r"^(.*/[^/]*_\d{8}_\d{6})"


def require_folder(spark: SparkSession, path: str) -> str:
    """``path``, or FileNotFoundError when it is missing, whatever its URI scheme."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(path)
    return path


def _line_columns() -> list[Column]:
    return [F.col("value"), F.col("_metadata.file_path").alias("_source"),
            F.col("_metadata.file_modification_time").alias("_landed"),
            F.col("_metadata.file_block_start").alias("_block"), F.col("_metadata.file_size").alias("_size")]


def read_lines(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Lines of all ``*.json`` files below ``root/entity``, at any depth."""
    path = require_folder(spark, f"{root.rstrip('/')}/{entity}")
    return (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
            .text(path).select(*_line_columns()))


def stream_lines(spark: SparkSession, root: str, entity: str, max_files: int | None = None) -> DataFrame:
    """The same lines as a stream that yields each file once."""
    path = require_folder(spark, f"{root.rstrip('/')}/{entity}")
    r = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.text(path).select(*_line_columns())


def largest_file(spark: SparkSession, root: str, entity: str) -> int:
    """Bytes of the largest landed file, from file metadata alone; 0 when there is none."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
             .load(require_folder(spark, f"{root.rstrip('/')}/{entity}")))
    return files.agg(F.max("length").alias("n")).first()["n"] or 0


def landed_values(lines: DataFrame, entity: str, whole_bytes: int = WHOLE_BYTES, largest: int | None = None) -> DataFrame:
    """One row per JSON value of a file: ``_source, _landed, text, _fault``.

    Only lines that are no value by themselves are brought together, and only
    those of files up to ``whole_bytes``; a larger file gives a value per record.
    ``_fault`` marks text that can't be taken as a value.  ``largest``, where the
    caller knows it, is the size of the largest file.
    """
    key = ENTITIES[entity][0]
    whole = F.col("value").rlike(
        rf'^\s*(\{{.*"{key}"\s*:\s*(\[|\{{|null).*\}}|\[\s*(\{{.*\}})?\s*\])\s*$')
    alone = lines.where(whole).select("_source", "_landed", F.col("value").alias("text"))
    rest = lines.where(~whole & (F.trim("value") != ""))
    # Ids rise with the line inside a block, blocks with their start in the file.
    at = F.struct(F.col("_block"), F.monotonically_increasing_id().alias("line"), F.col("value"))
    together = (rest.where(F.col("_size") <= whole_bytes).withColumn("_at", at)
                .groupBy("_source", "_landed").agg(F.sort_array(F.collect_list("_at")).alias("_lines"))
                .select("_source", "_landed", F.array_join(F.col("_lines.value"), "\n").alias("text")))
    values = alone.unionByName(together).withColumn("_fault", F.lit(False))
    if largest is not None and largest <= whole_bytes:
        return values
    return values.unionByName(framed_values(rest.where(F.col("_size") > whole_bytes), key))


def _ddl(record: T.StructType, *more: str) -> str:
    return f"struct<{','.join([*(f'`{f.name}`:{f.dataType.simpleString()}' for f in record.fields), *more])}>"


def _taken_apart(key: str, record: T.StructType) -> str:
    """What a value ``text`` holds in which something does not fit, as an array of
    (_total, raw text of what is bad, record); a malformed value, or one of an unknown shape, is one bad row."""
    plain, checked = _ddl(record), _ddl(record, f"{CORRUPT}:string")
    bad = f"array(named_struct('_total', CAST(NULL AS BIGINT), '_bad', text, 'rec', CAST(NULL AS {plain})))"
    # Inside brackets a text parses as a list of its values, and anything
    # after or between them that is no JSON makes the whole malformed.
    roots = (f"transform(from_json(concat('[', text, ']'), 'array<string>'), root -> named_struct('root', root, 'env', "
             f"CASE WHEN startswith(root, '{{') THEN from_json(root, 'struct<`{key}`:string,total:string>') END))")
    texts = (f"CASE WHEN startswith(x.root, '[') THEN from_json(x.root, 'array<string>') WHEN x.env.`{key}` IS NULL THEN array() "
             f"WHEN startswith(ltrim(x.env.`{key}`), '[') THEN from_json(x.env.`{key}`, 'array<string>') "
             f"ELSE array(x.env.`{key}`) END")  # a single record without its list
    parsed = (f"transform({texts}, raw -> named_struct('raw', raw, 'rec', from_json(raw, '{checked}', "
              f"map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '{CORRUPT}'))))")
    fields = ", ".join(f"'{f.name}', y.rec.`{f.name}`" for f in record.fields)
    records = (f"transform({parsed}, y -> named_struct('_total', try_cast(x.env.total AS BIGINT), "
               f"'_bad', CASE WHEN y.rec IS NULL THEN coalesce(y.raw, 'null') ELSE y.rec.{CORRUPT} END, "
               f"'rec', CASE WHEN y.rec.{CORRUPT} IS NULL AND y.rec IS NOT NULL THEN named_struct({fields}) END))")
    known = "startswith(x.root, '[') OR x.env IS NOT NULL"  # neither malformed nor a scalar
    return (f"CASE WHEN size({roots}) > 0 THEN flatten(transform({roots}, x -> CASE WHEN {known} THEN {records} ELSE {bad} END)) "
            f"ELSE {bad} END")


def parse_records(values: DataFrame, entity: str) -> DataFrame:
    """One row per landed record (U1): ``_source, _landed, _total, <record>, _bad``.

    ``_bad`` is NULL, or the raw text of what could not be loaded: the whole
    value when it is malformed or of an unknown shape, else one record.
    Values without records (no key, NULL, an empty list) give no row.
    """
    key, record, single = ENTITIES[entity]
    plain = _ddl(record)
    # A bare list is the list of an envelope.  Parsing ends with the first value of a text; the number behind
    # it, which no text holds by chance, shows that this value ended where the text does.
    enveloped = f"""CASE WHEN startswith(ltrim(text), '[') THEN concat('{{"{key}":', text, '}}') ELSE text END"""
    schema = f"struct<_:array<struct<`{key}`:array<{plain}>,total:string>>,end:bigint,{CORRUPT}:string>"
    parsed = values.withColumn("_env", F.expr(
        f"""from_json(concat('{{"_":[', {enveloped}, '],"end":', CAST(xxhash64(text) AS STRING), '}}'), '{schema}',
            map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '{CORRUPT}'))"""))
    held = f"_env._[0].`{key}`"
    fits = (f"coalesce(_env.{CORRUPT} IS NULL AND _env.end = xxhash64(text) AND size(_env._) = 1 "
            f"AND coalesce(NOT exists({held}, r -> r IS NULL), true), false)")
    good = (f"transform({held}, r -> named_struct('_total', try_cast(_env._[0].total AS BIGINT), '_bad', CAST(NULL AS STRING), "
            f"'rec', r))")
    fault = f"array(named_struct('_total', CAST(NULL AS BIGINT), '_bad', text, 'rec', CAST(NULL AS {plain})))"
    fault = f"WHEN _fault THEN {fault}" if "_fault" in values.columns else ""
    rows = F.expr(f"CASE {fault} WHEN {fits} THEN {good} ELSE {_taken_apart(key, record)} END")
    return parsed.select("_source", "_landed", F.explode(rows).alias("_r")).select(
        "_source", "_landed", "_r._total", "_r._bad", F.col("_r.rec").alias(single))


def split(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(loaded, quarantined) rows of :func:`parse_records`."""
    return records.where("_bad IS NULL").drop("_bad"), records.where("_bad IS NOT NULL").select(
        "_source", "_landed", F.col("_bad").alias("text"))


def load(spark: SparkSession, root: str, entity: str) -> tuple[DataFrame, DataFrame]:
    """(loaded, quarantined) records of all landed files of an entity."""
    return split(parse_records(landed_values(read_lines(spark, root, entity), entity), entity))


def explode_lines(carts: DataFrame) -> DataFrame:
    """The lines of bronze carts: ``cart_id, line``, one row per order line.

    Carts without lines are dropped after the explode: a plain one would make
    Spark check the array below it, and so parse a cart's JSON once more."""
    return carts.select(F.col("cart.id").alias("cart_id"), F.explode_outer("cart.products").alias("line")).where(
        "line IS NOT NULL")


def landed_files(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Paths of all ``*.json`` files below ``root/entity``, any depth (file metadata only)."""
    path = require_folder(spark, f"{root.rstrip('/')}/{entity}")
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.json").load(path).select("path"))


def frozen_schema(spark: SparkSession, root: str, entity: str) -> T.StructType | None:
    """The schema inferred from the lexicographically first landed file,
    or None when nothing was landed.  Inference reads that one file only;
    the result is meant to be frozen (stored) and passed to later reads."""
    try:
        first = landed_files(spark, root, entity).agg(F.min("path").alias("p")).first()["p"]
    except FileNotFoundError:
        return None
    if first is None:
        return None
    return spark.read.option("multiLine", True).json(first).schema


def create_raw_table_if_needed(spark: SparkSession, table: str, root: str, entity: str,
                               path: str | None = None) -> bool:
    """True when the raw table exists or was created from the first file's
    schema; False when no file was landed."""
    if spark.catalog.tableExists(table):
        return True
    schema = frozen_schema(spark, root, entity)
    if schema is None:
        return False
    from ..sinks import create_empty

    return create_empty(spark, table, schema, path)


def batch_counts(bronze: DataFrame, entity: str) -> DataFrame:
    """Records per landed file.  Files without records never reach bronze."""
    return bronze.groupBy(F.col("_source").alias("source")).agg(F.count(F.lit(1)).alias("records")).select(
        F.lit(entity).alias("entity"), "source", "records")


def load_totals(frames: dict[str, DataFrame]) -> DataFrame:
    """Per entity, records loaded and files they came from."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("_source").alias("files")).select(
            F.lit(entity).alias("entity"), "records", "files")
        for entity, df in frames.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fetch_of(source: Column) -> Column:
    """The fetch a file belongs to: its path up to ``<entity>_YYYYMMDD_HHMMSS``, else the file itself."""
    named = F.regexp_extract(source, FETCH, 1)
    return F.when(named != "", named).otherwise(source)


def file_counts(records: DataFrame, total: str = "_total") -> DataFrame:
    """One row a landed file, combined map-side: ``_source, _landed_n, _reported``."""
    return records.groupBy("_source").agg(F.count(F.lit(1)).alias("_landed_n"), F.max(total).alias("_reported"))


def completeness(frames: dict[str, DataFrame]) -> DataFrame:
    """Per fetch, records landed against the total that fetch reports
    (the landed count when it reports none).  Records are counted per file
    first, so a file's name is taken apart once."""
    return fetch_completeness({entity: file_counts(df) for entity, df in frames.items()})


def fetch_completeness(files: dict[str, DataFrame]) -> DataFrame:
    """A21 from one row a file (:func:`file_counts`, or a load's ledger): no record is read."""
    parts = []
    for entity, df in files.items():
        g = df.groupBy(fetch_of(F.col("_source")).alias("batch")).agg(
            F.sum("_landed_n").alias("landed"), F.max("_reported").alias("_said"))
        parts.append(g.select(
            F.lit(entity).alias("entity"), "batch", "landed",
            F.coalesce(F.col("_said"), F.col("landed")).alias("reported_total"),
        ).withColumn("complete", F.col("landed") >= F.col("reported_total")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def page_of(page_size: int) -> Column:
    """A page number that at most ``page_size`` rows share, whatever the data:
    row ids are consecutive inside a partition and unique over all."""
    return F.expr(f"monotonically_increasing_id() div {page_size}")


def page_records(records: DataFrame, key: str, page_size: int = 100, total: int | None = None) -> DataFrame:
    """Pack record rows into envelopes of at most ``page_size`` records (K1).

    Pages follow ``monotonically_increasing_id``, which is consecutive inside
    a partition, so every page holds rows of one partition and never more than
    ``page_size`` of them, whatever the key distribution.
    """
    rec_cols = [c for c in records.columns]
    with_id = records.withColumn("_rid", F.monotonically_increasing_id())
    page = F.expr(f"_rid div {page_size}")
    g = with_id.groupBy(page.alias("_page")).agg(
        F.collect_list(F.struct(F.col("_rid"), F.struct(*rec_cols).alias("r"))).alias("_rs"))
    # By the id alone, since not all records can be ordered.
    arr = F.transform(F.array_sort("_rs", lambda a, b: (a["_rid"] - b["_rid"]).cast("int")), lambda x: x["r"])
    tot = F.lit(total).cast("bigint") if total is not None else F.lit(None).cast("bigint")
    return g.select(arr.alias(key), tot.alias("total"), (F.col("_page") * page_size).alias("skip"),
                    F.lit(page_size).cast("bigint").alias("limit"))


def land(records: DataFrame, root: str, entity: str, at: str | _dt.datetime | None = None, page_size: int = 100,
         total: int | None = None, pretty: bool = False) -> str:
    """Write records as envelopes, one per line, under
    ``root/entity/YYYY/MM/DD/<entity>_YYYYMMDD_HHMMSS/`` (K1, K2: the URI
    scheme picks the file system, e.g. ``s3a://``).  ``pretty`` writes a file of
    many lines for each envelope.  ``at`` is the time of the fetch in UTC, now by
    default; paths of one entity sort by it.  Returns the folder written.

    A fetch lands once: its folder has a marker file when all of it is there.  A
    call for a fetch that has landed writes nothing; one that finds part of a
    fetch without the marker writes the whole anew."""
    spark = records.sparkSession
    when = _dt.datetime.now(_dt.timezone.utc) if at is None else _dt.datetime.fromisoformat(str(at))
    out = (f"{root.rstrip('/')}/{entity}/{when:%Y/%m/%d}/{entity}_{when:%Y%m%d_%H%M%S}")
    if not stored(spark, f"{out}/_SUCCESS"):
        w = page_records(records, ENTITIES[entity][0], page_size, total).write.mode("overwrite")
        if pretty:
            w = w.option("pretty", True).option("maxRecordsPerFile", 1)
        w.json(out)
    return out


def landing_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Landed files per entity and day, from file metadata only
    (the file content is never read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.json").load(root).select("path", "length"))
    rx = r"/([^/]+)/(\d{4})/(\d{2})/(\d{2})/"
    return files.select(
        F.regexp_extract("path", rx, 1).alias("entity"),
        F.concat_ws("-", F.regexp_extract("path", rx, 2), F.regexp_extract("path", rx, 3),
                    F.regexp_extract("path", rx, 4)).alias("landing_date"),
        "path", "length",
    )


def validate_landing(manifest: DataFrame) -> DataFrame:
    """Files and bytes per entity and day; raises when nothing was landed."""
    summary = manifest.groupBy("entity", "landing_date").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    if summary.isEmpty():
        raise RuntimeError("no landed files found")
    return summary
