"""CSV landing files (S1-S3): read with NULL spellings, quarantine torn lines, export.

Landed files are read as lines of text, lines that a quoted line break tears are
joined to records (``records``), and each record is parsed by ``from_csv``
with an all-STRING schema, so a bad value never fails the whole job and the
record itself is at hand: NULL spellings become NULL, then ``try_cast`` types
each column. Records with the wrong number of fields, and values that do not
cast, are reported with the original text. A batch and a stream of files go
through the same expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlake import schema as S
from tickerlake.sources import records as R

CORRUPT = "_corrupt_record"

# One dialect for readers and writers: a quote inside a quoted field is doubled.
DIALECT = {"quote": '"', "escape": '"'}
WRITE_OPTIONS = {**DIALECT, "header": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
                 "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"}


def _text_schema(schema: T.StructType, corrupt: bool = False) -> T.StructType:
    fields = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(fields)


def _nullify(c: Column, nulls: Sequence[str]) -> Column:
    return F.when(c.isin(list(nulls)), F.lit(None)).otherwise(c)


def read_bars_csv(spark: SparkSession, path: str, schema: T.StructType = S.RAW_BAR_SCHEMA,
                  nulls: Sequence[str] = S.CSV_NULL_STRINGS, mode: str = "PERMISSIVE") -> DataFrame:
    """Header CSV into ``schema``; ``nulls`` read as NULL.

    A value that does not parse becomes NULL here (see ``quarantine_malformed``
    to report it instead). ``mode="FAILFAST"`` raises on a malformed record,
    ``"DROPMALFORMED"`` leaves it out. By default, files without a quoted line
    break are read by Spark's own reader; the others, and in these two modes all, are read
    record by record. Each file's first line is left out.
    """
    told = mode != "PERMISSIVE"
    lines = R.read_lines(spark, path)
    breaks = F.broadcast(R.files_with_breaks(lines))
    own = R.numbered(lines)
    body = R.broken_records(own if told else own.join(breaks, "file", "left_semi")).filter(~F.col("head") & (F.trim("value") != ""))
    rows = body.select(F.explode(F.array(_parsed(F.col("value"), schema))).alias("p")).select("p.*")
    torn = F.col(CORRUPT).isNotNull()
    if mode == "DROPMALFORMED":
        rows = rows.filter(~torn)
    elif told:
        rows = rows.filter(F.when(torn, F.raise_error(F.concat(F.lit("malformed record: "), F.col(CORRUPT))).cast("boolean")).otherwise(True))
    else:
        text = _text_schema(schema)
        plain = (spark.read.schema(text).options(header=True, **DIALECT).csv(path).select(*text.names, F.col("_metadata.file_path").alias("_file"))
                 .join(F.broadcast(breaks.withColumnRenamed("file", "_file")), "_file", "left_anti").select(*text.names))
        rows = plain.unionByName(rows.select(*text.names))
    return rows.select(*[_nullify(F.col(f.name), nulls).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def _parsed(text: Column, schema: T.StructType, corrupt: bool = True, mode: str = "PERMISSIVE") -> Column:
    """A record's fields as strings."""
    kinds = _text_schema(schema, corrupt).simpleString()[len("struct<"):-1].replace(":", " ")
    return F.from_csv(text, kinds, {**DIALECT, "mode": mode, "columnNameOfCorruptRecord": CORRUPT})


def tag_lines(lines: DataFrame, schema: T.StructType = S.RAW_BAR_SCHEMA,
              nulls: Sequence[str] = S.CSV_NULL_STRINGS, mode: str = "PERMISSIVE") -> DataFrame:
    """Records of header CSV files (column ``value``, batch or stream) as typed
    columns with ``raw_line`` and ``reasons``, an array that is empty for a
    good line. Blank lines and headers (the first names of the schema, or all)
    are left out."""
    squeezed = F.lower(F.regexp_replace("value", "[\"\\s]", ""))
    header = F.lit(",".join(f.name.lower() for f in schema.fields) + ",")
    body = lines.filter((squeezed != "") & ~header.startswith(F.concat(squeezed, F.lit(","))))
    # Filters on the fields stay above a generator; below it they would parse the line, or a value, once per use.
    p = body.select(F.col("value").alias("raw_line"), F.explode(F.array(_parsed(F.col("value"), schema, mode=mode))).alias("p"))
    torn = F.col(f"p.{CORRUPT}").isNotNull()
    texts = {f.name: _nullify(F.col(f"p.{f.name}"), nulls) for f in schema.fields}
    values = F.struct(*[texts[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])
    p = p.select("raw_line", "p", F.explode(F.array(values)).alias("t"))
    typed = {n: F.col(f"t.{n}") for n in texts}
    problems = [F.when(torn, F.lit("malformed"))] + [
        F.when(~torn & texts[n].isNotNull() & typed[n].isNull(), F.lit(f"unparseable:{n}")) for n in texts]
    return p.select(*[typed[n].alias(n) for n in typed], "raw_line",
                    F.filter(F.array(*problems), lambda x: x.isNotNull()).alias("reasons"))


def quarantine_malformed(spark: SparkSession, path: str, schema: T.StructType = S.RAW_BAR_SCHEMA,
                         nulls: Sequence[str] = S.CSV_NULL_STRINGS, mode: str = "PERMISSIVE"
                         ) -> tuple[DataFrame, DataFrame]:
    """Split landed lines into ``(good, bad)``.

    ``bad`` holds every line with the wrong number of fields (``malformed``)
    or a non-NULL value that does not cast to its type (``unparseable:<col>``),
    as ``(raw_line, reasons)`` with the line, or the lines of the record, as landed.
    ``mode="FAILFAST"`` raises instead.
    """
    tagged = tag_lines(R.records(R.read_lines(spark, path)), schema, nulls, mode)
    good = tagged.filter(F.size("reasons") == 0).drop("raw_line", "reasons")
    bad = tagged.filter(F.size("reasons") > 0).select("raw_line", "reasons")
    return good, bad


def _content(df: DataFrame) -> list[Column]:
    """Row count and an order-independent sum over all values; a NULL and the
    spellings read as NULL are one."""
    cols = [_nullify(F.col(f"`{f.name}`"), S.CSV_NULL_STRINGS) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields]
    tags = [F.concat_ws("|", *[F.lit(i).cast("string"), F.coalesce(c.cast("string"), F.lit("\\N"))]) for i, c in enumerate(cols)]
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*tags).cast("decimal(38,0)")).alias("content")]


def write_bars_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """S3: header CSV export, published atomically by the job commit (``_SUCCESS``).

    Rows and their values are summed up during the write (an ``Observation``);
    the files are read back and compared, and a difference raises.
    """
    obs = Observation("csv_export")
    (df.observe(obs, *_content(df)).write.mode(mode).options(**WRITE_OPTIONS).csv(path))
    wrote = obs.get
    back = read_bars_csv(df.sparkSession, path, df.schema)
    seen = back.agg(*_content(back)).first()
    if (seen["rows"], seen["content"]) != (wrote["rows"], wrote["content"]):
        raise ValueError(f"CSV export differs from its source: {wrote['rows']} rows out, {seen['rows']} rows back")
    return wrote["rows"]
