"""Landing directory: ``ingest_date=YYYY-MM-DD/*.json``, one payload per line."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    AtomicType,
    DataType,
    DateType,
    MapType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from rampline.contracts import CORRUPT_COLUMN, RESCUED_COLUMN, landing_schema
from rampline.operators.bronze import with_audit, with_upload_date

_LINE_SCHEMA = StructType([StructField("value", StringType()), StructField("ingest_date", DateType())])

# A file source skips files much older than the newest it has seen; landing must not.
ANY_AGE = "36500d"
# So much of a backlog makes one micro-batch unless told otherwise.
BATCH_BYTES = 64 << 30
_UNITS = {"k": 10, "m": 20, "g": 30, "t": 40}

_TEXT_MAP = MapType(StringType(), StringType())


def landing_lines(
    spark: SparkSession,
    path: str,
    stream: bool = True,
    max_bytes: str | None = None,
    max_files: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Raw lines with the date of their directory.

    As a stream only files that no earlier run has seen are read, however old
    they are. The limits bound one micro-batch, so that a backlog is worked off in pieces.

    With ``archive``, a directory outside of ``path`` on the same file system, each file
    moves there under its full path when a later micro-batch, of this run or the next with
    news, begins. So what a run has to list and infer from stays as small as the last batch
    and the news. A file that has moved is
    remembered by its name: one that lands under the same name again is not read.
    """
    reader = (spark.readStream if stream else spark.read).schema(_LINE_SCHEMA)
    if stream:
        reader = bounded(reader, max_bytes, max_files)
        if archive is not None:
            reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.text(path)


def byte_count(text: str | int) -> int:
    """A number of bytes, which may be written as 64g."""
    text = str(text).strip().lower()
    unit = _UNITS.get(text[-1:], 0)
    return int(text[:-1] if unit else text) << unit


def bounded(reader, max_bytes: str | None = None, max_files: int | None = None):
    """A stream reader that takes files of any age, so many at a time."""
    reader = reader.option("maxFileAge", ANY_AGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None or max_files is None:
        reader = reader.option("maxBytesPerTrigger", byte_count(max_bytes or BATCH_BYTES))
    return reader


# What no text but one JSON value can stand before: a value that is followed by anything else,
# closing brackets included, does not make a list of two.
_SENTINEL = ",0]"


def _before_sentinel(value: str | Column = "value") -> Column:
    return F.concat(F.lit("["), value, F.lit(_SENTINEL))


def documents(lines: DataFrame) -> DataFrame:
    """Lines as a JSON reader takes them: blank ones are none, an array is one for each element.

    An array with text after it stays one line, so that the text is not lost. Blank lines are
    dropped by the explode: a filter would be pushed below whatever made the line and make it twice.
    """
    text = F.btrim("value", F.lit(" \t\r\n"))
    alone = F.from_json(_before_sentinel(), ArrayType(StringType()))
    elements = F.from_json(F.when(F.size(alone) == 2, F.get(alone, 0)), ArrayType(StringType()))
    elements = F.transform(elements, lambda element: F.coalesce(element, F.lit("null")))
    each = F.when(text.startswith("["), F.coalesce(elements, F.array("value"))).when(text != "", F.array("value"))
    carried = [name for name in lines.columns if name != "value"]
    return lines.select(F.explode(each).alias("value"), *carried)


def _surplus(keys: Column, known: list[str], prefix: str = "") -> Column:
    """Keys that the schema does not name."""
    surplus = F.array_except(F.coalesce(keys, _no_texts()), F.array(*map(F.lit, known)))
    return F.transform(surplus, lambda key: F.concat(F.lit(prefix), key))


def _no_texts() -> Column:
    return F.array().cast("array<string>")


def _is_text(kind: DataType) -> bool:
    return isinstance(kind, StringType | VariantType)


def _typed(text: Column, kind: DataType) -> Column:
    if _is_text(kind):
        return text
    return text.try_cast(kind) if isinstance(kind, AtomicType) else F.from_json(text, kind)


def _misfit(readings: Column, field: StructField) -> Column:
    """The name of a field of readings, where one of them has a value that is not of its type."""

    def misfit(reading: Column) -> Column:
        return reading[field.name].isNotNull() & _typed(reading[field.name], field.dataType).isNull()

    return F.when(F.exists(readings, misfit), F.lit(f"snapshots.{field.name}"))


def _texts(fields: StructType) -> StructType:
    """The same fields as text, but for variants."""
    return StructType([field if _is_text(field.dataType) else StructField(field.name, StringType()) for field in fields])


def _distinct_keys(maps: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(maps, lambda m: F.coalesce(F.map_keys(m), _no_texts()))))


class _Strict:
    """What a line's one strict parse, the variant ``_told``, says of its payload."""

    def __init__(self, schema: StructType) -> None:
        self.schema = schema
        self.metadata, self.reading = schema["metadata"].dataType, schema["snapshots"].dataType.elementType

    @staticmethod
    def _part(name: str, kind: str, of: str | Column = "_told") -> Column:
        return F.try_variant_get(of, f"$[0]['{name}']", kind)

    def parts(self) -> dict[str, Column]:
        """Columns of their own, each read once."""
        sentinel = F.try_variant_get("_told", "$[1]", "int") == 0  # second, and last
        found = {"_strict": F.coalesce(sentinel & F.try_variant_get("_told", "$[2]", "variant").isNull(), F.lit(False))}
        for field in self.schema:
            if field.name == "metadata":
                part = self._part(field.name, _texts(self.metadata).simpleString())
            elif field.name == "snapshots":
                part = self._part(field.name, ArrayType(_texts(self.reading)).simpleString())
            elif isinstance(field.dataType, AtomicType):
                part = _typed(self._part(field.name, "string"), field.dataType)
            else:
                part = self._part(field.name, field.dataType.simpleString())
            found[f"_{field.name}"] = part
        found["_keys"] = F.map_keys(F.try_variant_get("_told", "$[0]", "map<string,variant>"))
        found["_inner_keys"] = F.map_keys(self._part("metadata", "map<string,variant>"))
        found["_reading_keys"] = _distinct_keys(self._part("snapshots", "array<map<string,variant>>"))
        return found

    # What is missing is rare: only then the line is asked again whether it was sent.

    def strange_element(self) -> Column:
        """Whether a reading is neither an object nor null."""

        def wrong(element: Column) -> Column:
            is_object = F.try_variant_get(element, "$", "map<string,variant>").isNotNull()
            return element.isNotNull() & ~F.is_variant_null(element) & ~is_object

        elements = self._part("snapshots", "array<variant>", F.try_parse_json(_before_sentinel()))
        return F.exists("_snapshots", lambda reading: reading.isNull()) & F.exists(elements, wrong)

    def mistyped(self) -> Column:
        """Whether a value was sent that is not of its field's type."""

        def lost(name: str) -> Column:
            sent = self._part(name, "variant", F.try_parse_json(_before_sentinel()))
            return F.col(f"_{name}").isNull() & sent.isNotNull() & ~F.is_variant_null(sent)

        faults = [lost(name) for name in self.schema.fieldNames()] + [self.strange_element()]
        for field in self.metadata:
            text = F.col("_metadata")[field.name]
            if not _is_text(field.dataType):
                faults.append(text.isNotNull() & _typed(text, field.dataType).isNull())
        return reduce(or_, (F.coalesce(fault, F.lit(False)) for fault in faults))


def _unexpected_keys(schema: StructType, keys: Column, inner: Column, readings: Column) -> Column:
    reading = schema["snapshots"].dataType.elementType
    return F.concat(
        _surplus(keys, schema.fieldNames()),
        _surplus(inner, schema["metadata"].dataType.fieldNames(), "metadata."),
        _surplus(readings, reading.fieldNames(), "snapshots."),
    )


class _Lenient:
    """The same of a line that the strict parse refuses, such as one with a bare ``NaN`` or a repeated key."""

    def __init__(self, schema: StructType) -> None:
        self.schema, self.reading = schema, schema["snapshots"].dataType.elementType

    def parts(self) -> dict[str, Column]:
        """Columns of their own, as each is used more than once."""
        line = F.col("value")
        fields = [
            StructField("snapshots", ArrayType(_TEXT_MAP)) if field.name == "snapshots" else field for field in self.schema
        ]
        parsed = StructType([*fields, StructField(CORRUPT_COLUMN, StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
        top = F.from_json(line, _TEXT_MAP)
        inner = F.from_json(F.try_element_at(top, F.lit("metadata")), _TEXT_MAP)
        return {
            "_payload": F.from_json(line, parsed, options),
            "_loose_keys": F.coalesce(F.json_object_keys(line), F.map_keys(top)),
            "_loose_inner_keys": F.map_keys(inner),
            "_alone": F.from_json(_before_sentinel(), ArrayType(StringType())),
        }

    def reading_keys(self) -> Column:
        return _distinct_keys(F.coalesce(F.col("_payload.snapshots"), F.array().cast(ArrayType(_TEXT_MAP))))

    def readings(self) -> Column:
        """Readings as texts, of which the first counts where a key is repeated."""

        def read(m: Column) -> Column:
            return F.when(m.isNotNull(), F.struct(*(F.try_element_at(m, F.lit(f.name)).alias(f.name) for f in self.reading)))

        return F.transform("_payload.snapshots", read)

    def lossy(self) -> Column:
        """Whether a key is repeated, or text follows the object."""

        def repeated(keys: Column) -> Column:
            return F.coalesce(F.size(F.array_distinct(keys)) < F.size(keys), F.lit(False))

        again = F.coalesce(F.exists("_payload.snapshots", lambda m: repeated(F.map_keys(m))), F.lit(False))
        alone = F.coalesce(F.size("_alone") == 2, F.lit(False))
        return repeated(F.col("_loose_keys")) | repeated(F.col("_loose_inner_keys")) | again | ~alone


def parse_payloads(lines: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Replace ``value`` by typed payload columns, rescued keys and corrupt text.

    * A line that is not a JSON object is kept whole in ``corrupt_record``.
    * A line that is one, but of which something would be lost, is kept whole
      in ``rescued_data``: keys that the schema does not know, at the top, in
      ``metadata`` or in any reading, are listed next to it; so are fields of
      readings that do not have the type of the schema. ``mistyped`` marks values
      of the wrong type elsewhere, ``lossy`` a repeated key or text after the object.

    A line is parsed once, by the strict parser of variants, which refuses repeated
    keys; a sentinel after the line makes it refuse what follows an object too. Only
    lines it refuses are parsed again, by the lenient JSON functions.
    """
    schema = schema or landing_schema()
    strict, lenient = _Strict(schema), _Lenient(schema)
    carried = [name for name in lines.columns if name != "value"]
    told = documents(lines).select(*carried, "value", F.try_parse_json(_before_sentinel()).alias("_told"))
    read = told.select(*carried, "value", *(part.alias(name) for name, part in strict.parts().items()))
    own = F.col("_strict")
    parsed = read.select("*", *(F.when(~own, part).alias(name) for name, part in lenient.parts().items()))

    def either(name: str, otherwise: Column) -> Column:
        return F.when(own, F.col(name)).otherwise(otherwise)

    broken = F.coalesce(F.col(f"_payload.{CORRUPT_COLUMN}"), F.when(F.col("_payload").isNull(), F.col("value")))
    values = {name: either(f"_{name}", F.col(f"_payload.{name}")) for name in schema.fieldNames()}
    values["metadata"] = F.when(own, _typed_struct(F.col("_metadata"), strict.metadata)).otherwise(F.col("_payload.metadata"))
    values["snapshots"] = F.when(own & F.coalesce(strict.strange_element(), F.lit(False)), None).otherwise(
        either("_snapshots", lenient.readings())
    )
    keys = either("_keys", F.col("_loose_keys"))
    unexpected = _unexpected_keys(
        schema, keys, either("_inner_keys", F.col("_loose_inner_keys")), either("_reading_keys", lenient.reading_keys())
    )
    misfits = [_misfit(values["snapshots"], field) for field in strict.reading if not _is_text(field.dataType)]
    if misfits:
        unexpected = F.concat(unexpected, F.array_compact(F.array(*misfits)))
    judged = parsed.select(
        *carried,
        "value",
        *(value.alias(f"_{name}") for name, value in values.items()),
        keys.isNotNull().alias("_is_object"),
        F.when(keys.isNotNull(), unexpected).alias("_unexpected"),
        F.when(own, strict.mistyped()).otherwise(broken.isNotNull()).alias("_mistyped"),
        F.when(own, F.lit(False)).otherwise(lenient.lossy()).alias("_lossy"),
        F.when(keys.isNull(), F.coalesce(F.when(~own, broken), F.col("value"))).alias("_corrupt"),
    )
    rescued = F.when(
        F.col("_is_object") & (F.col("_mistyped") | F.col("_lossy") | (F.size("_unexpected") > 0)),
        F.to_json(
            F.struct(
                F.col("_unexpected").alias("keys"),
                F.when(F.col("_mistyped"), F.lit(True)).alias("mistyped"),
                F.when(F.col("_lossy"), F.lit(True)).alias("lossy"),
                F.col("value").alias("line"),
            )
        ),
    )
    columns = {name: F.col(f"_{name}") for name in schema.fieldNames()}
    if misfits:
        columns["snapshots"] = F.transform("_snapshots", lambda texts: _typed_struct(texts, strict.reading))
    return judged.select(
        *(column.alias(name) for name, column in columns.items()),
        *carried,
        rescued.alias(RESCUED_COLUMN),
        F.col("_corrupt").alias(CORRUPT_COLUMN),
    )


def _typed_struct(texts: Column, kind: StructType) -> Column:
    if all(_is_text(field.dataType) for field in kind):
        return texts
    fields = (_typed(texts[field.name], field.dataType).alias(field.name) for field in kind)
    return F.when(texts.isNotNull(), F.struct(*fields))


def to_bronze(lines: DataFrame, run_id: str, schema: StructType | None = None) -> DataFrame:
    """Bronze rows from landing lines. Audit columns are taken from the file scan.

    Meant to be written as a table before it is validated: a filter on a parsed
    column would be pushed below the parser and parse every line once more.
    """
    return with_upload_date(parse_payloads(with_audit(lines, run_id), schema))
