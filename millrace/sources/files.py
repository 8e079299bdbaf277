"""Incremental and idempotent file ingestion."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import ANY_AGE, read_if_present, written


def with_provenance(df: DataFrame) -> DataFrame:
    """Add ``arrival_time`` and ``source_file`` to a frame that reads files."""
    return df.select(
        "*",
        F.current_timestamp().alias("arrival_time"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def _stored(spark: SparkSession, location: str) -> DataFrame:
    """The schemas stored under ``location``, one JSON text per widening."""
    try:
        return spark.read.schema("seq BIGINT, body STRING").json(location)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "seq BIGINT, body STRING")


def _stored_schema(spark: SparkSession, location: str) -> T.StructType | None:
    newest = _stored(spark, location).agg(F.max_by("body", "seq")).first()[0]
    return newest and T.StructType.fromJson(json.loads(newest))


def _store_schema(spark: SparkSession, location: str, schema: T.StructType) -> None:
    seq = _stored(spark, location).agg(F.count(F.lit(1))).first()[0]
    row = spark.range(0, 1, 1, 1).select(F.lit(seq).alias("seq"), F.lit(schema.json()).alias("body"))
    row.write.mode("append").json(location)


_WIDER = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def merge_types(old: T.DataType, new: T.DataType, text: bool, place: str = "") -> T.DataType:
    """The type that holds values of both: structs, arrays and maps field by field, numbers widened.

    Formats that store ``text`` (JSON, CSV) also read any plain value as a string; others
    refuse such a conflict, as a file's values could not be read back.
    """
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merge_schemas(old, new, text, place)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        element = merge_types(old.elementType, new.elementType, text, f"{place}[]")
        return T.ArrayType(element, old.containsNull or new.containsNull)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(
            merge_types(old.keyType, new.keyType, text, f"{place}.key"), merge_types(old.valueType, new.valueType, text, f"{place}.value"),
            old.valueContainsNull or new.valueContainsNull)
    if old in _WIDER and new in _WIDER:
        return max(old, new, key=_WIDER.index)
    if {type(old), type(new)} <= {T.FloatType, T.DoubleType, *map(type, _WIDER)}:
        return T.DoubleType()
    nested = (T.StructType, T.ArrayType, T.MapType)
    if text and not isinstance(old, nested) and not isinstance(new, nested):
        return T.StringType()
    raise ValueError(f"{place or 'the files'}: {old.simpleString()} and {new.simpleString()} have no common type")


def merge_schemas(old: T.StructType, new: T.StructType, text: bool = True, place: str = "") -> T.StructType:
    """``old``, widened where ``new`` needs it, plus the fields only ``new`` has, at any depth."""
    later = {f.name: f for f in new.fields}
    merged = [
        T.StructField(f.name, merge_types(f.dataType, later[f.name].dataType, text, f"{place}.{f.name}".lstrip(".")),
                      f.nullable or later[f.name].nullable) if f.name in later else f
        for f in old.fields
    ]
    known = set(old.fieldNames())
    return T.StructType(merged + [f for f in new.fields if f.name not in known])


# new files whose names are handed to the reader; more are read by their folder
NAMED_FILES = 10_000


def _unseen_files(spark: SparkSession, folder: str, location: str) -> tuple[list[str] | None, Callable[[], None]]:
    """Files of ``folder`` that no earlier inference has looked at, and what notes them as seen.

    None stands for all: too many to name, or no earlier inference. Listing reads no content.
    """
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    seen = read_if_present(spark, f"{location}/files", "path STRING")
    new = written(names.join(seen, "path", "left_anti"), f"{location}/arrivals")
    found = None if seen.isEmpty() else [r["path"] for r in new.limit(NAMED_FILES + 1).collect()]
    note = lambda: new.write.mode("append").parquet(f"{location}/files")
    return (None if found is None or len(found) > NAMED_FILES else found), note


def evolving_schema(spark: SparkSession, folder: str, fmt: str, schema_location: str,
                    options: dict[str, str] | None = None) -> T.StructType:
    """Schema of the files in ``folder``, inferred once and widened when new fields appear.

    Kept under ``schema_location`` with the names of the files it was inferred from; a
    restart only reads files that came since. New fields are found at any depth, of
    parquet and ORC files too, and numbers are widened (``merge_types``). A stream's schema is
    fixed while it runs, so fields that show up during a run are picked up by the next.
    """
    stored = _stored_schema(spark, f"{schema_location}/schemas")
    unseen, note = _unseen_files(spark, folder, schema_location)
    if stored is not None and unseen == []:
        return stored
    reader = spark.read.format(fmt).option("mergeSchema", "true").options(**(options or {}))
    found = reader.load(unseen or folder).schema
    schema = found if stored is None else merge_schemas(stored, found, text=fmt in ("json", "csv", "xml"))
    if schema != stored:
        _store_schema(spark, f"{schema_location}/schemas", schema)
    note()
    return schema


def file_stream(spark: SparkSession, path: str, fmt: str, schema: str | T.StructType,
                options: dict[str, str] | None = None, max_bytes: int | None = None) -> DataFrame:
    """A stream of the files at ``path``, whatever their dates; ``max_bytes`` bounds a micro-batch."""
    limits = {"maxFileAge": ANY_AGE} | ({"maxBytesPerTrigger": str(max_bytes)} if max_bytes else {})
    return spark.readStream.format(fmt).schema(schema).options(**limits | (options or {})).load(path)


def ingest_files(spark: SparkSession, folder: str, fmt: str, schema: str | T.StructType | None = None,
                 schema_location: str | None = None, options: dict[str, str] | None = None,
                 max_bytes: int | None = None) -> DataFrame:
    """A stream of the files in ``folder``, each delivered exactly once per checkpoint.

    Give the schema, or a ``schema_location`` where an inferred one is kept. Files of any
    date are taken; ``max_bytes`` bounds what one micro-batch reads.
    """
    if schema is None:
        if schema_location is None:
            raise ValueError("either a schema or a schema_location is needed")
        schema = evolving_schema(spark, folder, fmt, schema_location, options)
    return file_stream(spark, folder, fmt, schema, options, max_bytes)


def copy_into(spark: SparkSession, target: str, folder: str, fmt: str, checkpoint: str,
              schema: str | T.StructType | None = None, merge_schema: bool = False,
              options: dict[str, str] | None = None, max_bytes: int | None = None) -> DataFrame:
    """Load the files of ``folder`` that no earlier call has loaded into a parquet folder.

    Built on an available-now file stream: its checkpoint lists the loaded files and
    scales to very many, so a call with nothing new adds nothing. With ``merge_schema``
    fields that are new in the files widen the table; without it a file with other
    fields or types than the table's is refused. A schema that is given decides alone.
    """
    place = f"{checkpoint}-schema"
    if schema is None:
        stored = _stored_schema(spark, f"{place}/schemas")
        if stored is not None and not merge_schema:
            unseen, note = _unseen_files(spark, folder, place)
            if unseen != []:
                found = spark.read.format(fmt).option("mergeSchema", "true").options(**(options or {})).load(unseen or folder).schema
                if merge_schemas(stored, found, text=fmt in ("json", "csv", "xml")) != stored:
                    raise ValueError(f"files have {found.simpleString()}, the table {stored.simpleString()}; merge_schema widens it")
                note()
            schema = stored
        else:
            schema = evolving_schema(spark, folder, fmt, place, options)
    stream = ingest_files(spark, folder, fmt, schema, options=options, max_bytes=max_bytes)
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)
