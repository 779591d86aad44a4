"""Tab-separated extracts: file inspection, required-column check, typed read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import null_words_to_null
from ..operators._util import small_table
from ..operators.load import ARRIVAL, landed_at
from ..schema import EXTRACT_COLUMNS, EXTRACT_SCHEMA, FLOW

BOM = "\ufeff"
_UTF16 = {"FFFE": "UTF-16LE", "FEFF": "UTF-16BE"}
#: How a file is read: its lines are records; lines are joined to records; by one task.
LINES, RECORDS, WHOLE = "lines", "records", "whole"
# One field of a line, and a line that starts outside (inside) quotes and ends outside.
_FIELD = '(?:"[^"]*+(?:""[^"]*+)*+"[^\t]*+|[^"\t][^\t]*+|)'
_CLOSED_FROM_OUTSIDE = rf"\A{_FIELD}(?:\t{_FIELD})*+\z"
_CLOSED_FROM_INSIDE = rf'\A[^"]*+(?:""[^"]*+)*+"[^\t]*+(?:\t{_FIELD})*+\z'


def _lines(spark: SparkSession, paths, encoding: str) -> DataFrame:
    """Lines of files of one encoding, cut at line ends in their own code units by a
    splittable scan: FILE, BLOCK (start of the split), ROW (order in the scan), LANDED, LINE, RAW."""
    reader = spark.read.option("lineSep", "\n")
    if encoding in _UTF16.values():
        reader = reader.option("encoding", encoding)
    raw = F.col("value").cast("binary")
    line = F.regexp_replace(F.decode(raw, encoding) if encoding != "UTF-8" else F.col("value"), f"^{BOM}|\r$", "")
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("FILE"), F.col("_metadata.file_block_start").alias("BLOCK"),
        F.monotonically_increasing_id().alias("ROW"), landed_at().alias("LANDED"), line.alias("LINE"), raw.alias("RAW"))


def _open_from(outside: bool):
    """Whether a line that starts outside (inside) quotes ends inside them. As the
    parser has it, only a quote at the start of a field opens one."""
    return ~F.col("LINE").rlike(_CLOSED_FROM_OUTSIDE if outside else _CLOSED_FROM_INSIDE)


def inspect_files(spark: SparkSession, path) -> DataFrame:
    """(FILE, ENCODING, HEADER, MODE) of every file under ``path``, written once.

    By byte-order mark FF FE / FE FF -> UTF-16LE / UTF-16BE, EF BB BF -> UTF-8;
    without a mark UTF-8 when every line is valid UTF-8, else ISO-8859-1. MODE:
    "records" for files with a line break inside quotes, "whole" for UTF-16
    files in which two characters in a row hold the bytes of a line end at odd
    places (rare; only such a file is read by one task), else "lines". Empty
    files do not appear.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("FILE"), F.col("_metadata.file_block_start").alias("_BLOCK"),
        F.monotonically_increasing_id().alias("_ROW"), F.col("value").cast("binary").alias("_B"),
        F.is_valid_utf8("value").alias("_VALID"), F.col("value").alias("LINE"))
    first = F.when(F.col("_BLOCK") == 0, F.col("_B"))
    found = small_table(lines.groupBy("FILE").agg(
        F.min_by(first, F.when(F.col("_BLOCK") == 0, F.col("_ROW"))).alias("_H"),
        F.bool_and("_VALID").alias("_VALID"), F.bool_or(_open_from(outside=True)).alias("_OPEN")), "landed-files")
    mark = F.hex(F.substring("_H", 1, 2))
    wide = F.create_map(*[F.lit(x) for pair in _UTF16.items() for x in pair])[mark]
    whole = F.expr("substring(_H, 1, length(_H) - length(_H) % 2)")     # the line end cuts a two-byte unit
    header = (F.when(wide.isNotNull(), F.decode(whole, "UTF-16")).when(F.col("_VALID"), F.decode("_H", "UTF-8"))
              .otherwise(F.decode("_H", "ISO-8859-1")))
    files = found.select(
        "FILE", F.coalesce(wide, F.when(F.col("_VALID"), "UTF-8").otherwise("ISO-8859-1")).alias("ENCODING"),
        F.regexp_replace(header, f"^{BOM}|[\r\n]+$", "").alias("HEADER"),
        F.when(F.col("_OPEN"), RECORDS).otherwise(LINES).alias("MODE"))
    kinds = [r[0] for r in files.select("ENCODING").distinct().collect()]
    if not set(kinds) & set(_UTF16.values()):
        return files
    # lines of UTF-16 files are known only now: their quotes and odd places are looked at apart
    parts = [files.where(~F.col("ENCODING").isin(*_UTF16.values()))]
    for encoding in sorted(set(kinds) & set(_UTF16.values())):
        own = files.where(F.col("ENCODING") == encoding).drop("MODE")
        odd = small_table(_lines(spark, _paths(own), encoding).groupBy("FILE").agg(F.bool_or(F.octet_length("RAW") % 2 == 1).alias("_ODD")), "landed-files")
        own = own.join(odd, "FILE")
        parts.append(own.where("_ODD").select("FILE", "ENCODING", "HEADER", F.lit(WHOLE).alias("MODE")))
        even = _paths(own.where("NOT _ODD"))
        if even:        # only these can be decoded line by line
            seen = _lines(spark, even, encoding).groupBy("FILE").agg(F.bool_or(_open_from(outside=True)).alias("_OPEN"))
            parts.append(own.join(seen, "FILE").select("FILE", "ENCODING", "HEADER", F.when(F.col("_OPEN"), RECORDS).otherwise(LINES).alias("MODE")))
    return small_table(reduce(DataFrame.unionByName, parts), "landed-files")


def _paths(files: DataFrame, among: DataFrame | None = None) -> list[str]:
    """Paths to read for ``files``: a folder where all of its files (``among``) are
    wanted, single files elsewhere."""
    folder = F.regexp_extract("FILE", r"^(.*)/[^/]*$", 1).alias("_FOLDER")
    wanted = files.select("FILE", folder)
    if among is None:
        return [r.FILE for r in wanted.collect()]
    size = among.groupBy(folder).agg(F.count(F.lit(1)).alias("_ALL"))
    full = wanted.groupBy("_FOLDER").agg(F.count(F.lit(1)).alias("_N")).join(size, "_FOLDER").withColumn("_FULL", F.col("_N") == F.col("_ALL"))
    folders = [r._FOLDER for r in full.where("_FULL").select("_FOLDER").collect()]
    single = wanted.join(full.where("NOT _FULL").select("_FOLDER"), "_FOLDER", "left_semi")
    return sorted(folders + [r.FILE for r in single.select("FILE").collect()])


_CSV = {"sep": "\t", "quote": '"', "escape": '"', "mode": "FAILFAST"}


def _read_group(spark: SparkSession, paths, names: list[str], encoding: str, mode: str) -> DataFrame:
    """Files of one encoding and one header, all values as strings, with LANDED and
    ROW. A row with more or fewer fields than the header stops the read."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    if mode == WHOLE or (mode == LINES and encoding not in _UTF16.values()):
        raw = (spark.read.schema(schema).options(**_CSV).option("header", True)
               .option("encoding", "UTF-16" if mode == WHOLE else encoding).option("multiLine", mode == WHOLE)
               .option("columnPruning", False).csv(paths))
        return raw.select("*", landed_at().alias("LANDED"), F.monotonically_increasing_id().alias("ROW"))
    lines = _lines(spark, paths, encoding)
    if mode == LINES:       # UTF-16: the header line has the byte-order mark
        rows = lines.where(~((F.col("BLOCK") == 0) & F.hex(F.substring("RAW", 1, 2)).isin(*_UTF16)))
    else:
        rows = _records(lines.drop("RAW"))
    rows = rows.where(F.col("LINE").rlike(r"[^\x00-\x20]"))
    ddl = ", ".join(f"`{c}` string" for c in names)
    return rows.select(F.from_csv("LINE", ddl, _CSV).alias("_R"), "LANDED", "ROW").select("_R.*", "LANDED", "ROW")


def _state(start, const, flips):
    """Inside quotes (1) or not (0): the last state that was certain, or that at the
    ``start``, turned ``flips`` times."""
    return F.pmod(F.coalesce(const, start) + flips, F.lit(2)).cast("int")


def _running(rows: DataFrame, window, const: str, flip: str) -> DataFrame:
    """Adds _C, the last non-null ``const`` up to a row, and _F, the flips since."""
    w = window.rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumn("_ALL", F.sum(flip).over(w))
    at = F.last(F.when(F.col(const).isNotNull(), F.col("_ALL")), ignorenulls=True).over(w)
    return out.withColumns({"_C": F.last(const, ignorenulls=True).over(w), "_F": F.pmod(F.col("_ALL") - F.coalesce(at, F.lit(0)), F.lit(2))}).drop("_ALL")


def _records(lines: DataFrame) -> DataFrame:
    """Lines joined to records where a line break stands inside quotes; without headers.

    A line turns the state (inside quotes or not), keeps it, or leaves a certain
    one. The turns are summed inside each block (one split of a file), the
    blocks' sums run over the blocks of a file, and so every line learns the
    state it starts in. Lines that start and end outside are records; only the
    others are brought together, each record under its first line.
    """
    f0, f1 = _open_from(True).cast("int"), _open_from(False).cast("int")
    lines = lines.withColumns({"_F0": f0, "_F1": f1})
    lines = lines.withColumns({"_CONST": F.when(F.col("_F0") == F.col("_F1"), F.col("_F0")),
                               "_FLIP": ((F.col("_F0") == 1) & (F.col("_F1") == 0)).cast("int")})
    inside, along = Window.partitionBy("FILE", "BLOCK").orderBy("ROW"), Window.partitionBy("FILE").orderBy("BLOCK")
    lines = _running(lines, inside, "_CONST", "_FLIP").drop("_F0", "_F1", "_CONST", "_FLIP")
    lines = small_table(lines.withColumn("_NO", F.row_number().over(inside)), "landed-lines")
    blocks = lines.groupBy("FILE", "BLOCK").agg(F.max_by(F.struct("_C", "_F"), "ROW").alias("_L")).select(
        "FILE", "BLOCK", F.when(F.col("_L._C").isNotNull(), F.pmod(F.col("_L._C") + F.col("_L._F"), F.lit(2))).alias("_CONST"),
        F.when(F.col("_L._C").isNull(), F.col("_L._F")).otherwise(0).alias("_FLIP"))
    after = _running(blocks, along, "_CONST", "_FLIP")
    begin = F.coalesce(F.lag(_state(F.lit(0), F.col("_C"), F.col("_F"))).over(along), F.lit(0))
    lines = lines.join(after.select("FILE", "BLOCK", begin.alias("_BEGIN")), ["FILE", "BLOCK"])
    lines = lines.withColumn("_AFTER", _state(F.col("_BEGIN"), F.col("_C"), F.col("_F")))
    lines = lines.withColumn("_BEFORE", F.coalesce(F.lag("_AFTER").over(inside), F.col("_BEGIN")))
    lines = lines.withColumn("_START", F.last(F.when(F.col("_BEFORE") == 0, F.struct("BLOCK", "ROW")), ignorenulls=True)
                             .over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    lines = small_table(lines.select("FILE", "BLOCK", "ROW", "LANDED", "LINE", "_NO", "_BEFORE", "_AFTER", "_START"), "landed-lines")
    # a block may begin inside a record of an earlier one
    last = lines.groupBy("FILE", "BLOCK").agg(F.max("_START").alias("_LAST"))
    earlier = F.last("_LAST", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    lines = lines.join(last.select("FILE", "BLOCK", earlier.alias("_EARLIER")), ["FILE", "BLOCK"])
    lines = lines.withColumn("_START", F.coalesce("_START", "_EARLIER")).where(~((F.col("BLOCK") == 0) & (F.col("_NO") == 1)))
    alone = (F.col("_BEFORE") == 0) & (F.col("_AFTER") == 0)
    one = lines.where(alone).select("LINE", "LANDED", "ROW")
    part = F.struct("BLOCK", "ROW", "LINE", "LANDED")
    many = lines.where(~alone).groupBy("FILE", "_START").agg(F.array_sort(F.collect_list(part)).alias("_P"))      # the lines of one record
    many = many.select(F.array_join("_P.LINE", "\n").alias("LINE"), F.col("_P")[0]["LANDED"].alias("LANDED"), F.col("_START.ROW").alias("ROW"))
    return one.unionByName(many)


def read_extracts(spark: SparkSession, path, flow: str | None = None, columns=EXTRACT_COLUMNS,
                  schema=EXTRACT_SCHEMA, encoding: str | None = None, arrival: bool = False) -> DataFrame:
    """Read every file under ``path``, each by its own encoding and header.

    Columns are matched by header name in every file; a required column that
    any file lacks raises before data is read. Extra columns are dropped.
    Strings a pandas reader takes as missing become null, then values are
    cast to ``schema``; a malformed row or value raises. ``encoding`` replaces
    the detected one. ``arrival`` adds the landing order of each row for
    ``keep_last``.

    The files are inspected once; one row per (encoding, header, mode) comes to
    the driver, and paths: folders where all files are of one kind, single files
    elsewhere. Every kind is read in splits, UTF-16 and files with line breaks
    inside quotes included (see ``inspect_files`` for the exception).
    """
    files = inspect_files(spark, path)
    kinds = ["ENCODING", "HEADER", "MODE"]
    groups = [tuple(r) for r in files.select(*kinds).distinct().collect()]
    if not groups:
        raise ValueError(f"no extract files under {path}")
    paths = {groups[0]: path}
    if len(groups) > 1:
        paths = {}
        for g in groups:
            same = reduce(lambda x, y: x & y, [F.col(k) == F.lit(v) for k, v in zip(kinds, g)])
            paths[g] = _paths(files.where(same), files)
    names = {g: [c.strip().strip('"').strip() for c in g[1].split("\t")] for g in groups}
    missing = sorted({c for g in groups for c in columns if c not in names[g]})
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    repeated = sorted({c for g in groups for c in columns if names[g].count(c) > 1})
    if repeated:
        raise ValueError(f"Columns named twice: {repeated}")
    types = {f.name: f.dataType for f in schema.fields}
    parts = []
    for g in sorted(groups):
        labels = [c if c in columns else f"_X{i}" for i, c in enumerate(names[g])]
        raw = _read_group(spark, paths[g], labels, encoding or g[0], g[2])
        out = [null_words_to_null(F.col(c)).cast(types.get(c, "string")).alias(c) for c in columns]
        if flow is not None:
            out = [F.lit(flow).alias(FLOW), *out]
        if arrival:
            out.append(F.struct("LANDED.*", "ROW").alias(ARRIVAL))
        parts.append(raw.select(*out))
    return reduce(DataFrame.unionByName, parts)


def read_extract(spark: SparkSession, paths, flow: str | None = None, encoding: str = "UTF-8",
                 columns=EXTRACT_COLUMNS, schema=EXTRACT_SCHEMA) -> DataFrame:
    """Read extract file(s) known to have one encoding; else as ``read_extracts``."""
    return read_extracts(spark, paths, flow, columns, schema, encoding)


def write_extract(df: DataFrame, path: str, encoding: str = "UTF-8", bom: bool = False,
                  columns=EXTRACT_COLUMNS) -> None:
    """Write rows as a TSV extract (test landing files). ``bom`` prefixes the
    header with a byte-order mark (UTF-16 writers add their own)."""
    out = df.select(*columns)
    if bom:
        out = out.withColumnRenamed(columns[0], BOM + columns[0])
    (out.write.mode("overwrite").option("header", True).option("sep", "\t").option("escape", "\"")
     .option("encoding", encoding).csv(path))
