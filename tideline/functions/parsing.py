"""Line parsers: text columns to typed feature columns, all built-in expressions.

Casts follow ANSI mode, so a malformed number fails the job unless a lenient
variant is asked for.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

INT_PATTERN = r"^[+-]?[0-9]+$"
# Every character up to and including the space counts as blank, tabs included.
UNTIL_LAST_INK = r"(?s)^[\x00-\x20]*(.*[^\x00-\x20])"
NOT_BLANK_NOR_COMMENT = r"^[\x00-\x20]*[^\x00-\x20#]"
SPACE = 32
SPARSE_KIND = 0  # tag of a sparse value in the vector type's own storage
DENSE_WIDTH = 16  # up to here a dense vector is cheaper to build than a sparse one


def _fields(line: Column, separator: str) -> Column:
    """Split on a separator; empty fields at the end do not count."""
    body = F.when(
        line.endswith(separator), F.regexp_replace(line, f"{separator}+$", "")
    ).otherwise(line)
    return F.split(body, separator)


def _numbers(tokens: Column) -> Column:
    return tokens.cast("array<double>")


def _rest(tokens: Column) -> Column:
    return F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0)))


def _kept(df: DataFrame, line: str) -> list[str]:
    return [c for c in df.columns if c != line]


def _staged(df: DataFrame, line: str, value: Column) -> tuple[DataFrame, list[str]]:
    """``df`` with ``value`` as column ``_parts`` in place of the line, and the kept names.

    What is used several times is given a column of its own, so that it is
    computed once per row.
    """
    kept = _kept(df, line)
    return df.select(*kept, value.alias("_parts")), kept


def parse_label_csv(df: DataFrame, line: str = "value") -> DataFrame:
    """``label,f0,f1,...`` to (label, features); other columns pass through."""
    staged, kept = _staged(df, line, _numbers(_fields(F.col(line), ",")))
    return staged.select(
        *kept,
        F.element_at("_parts", 1).alias("label"),
        array_to_vector(_rest(F.col("_parts"))).alias("features"),
    )


def parse_label_space(df: DataFrame, line: str = "value") -> DataFrame:
    """``label,f0 f1 f2`` to (label, features)."""
    staged, kept = _staged(df, line, _fields(F.col(line), ","))
    return staged.select(
        *kept,
        F.element_at("_parts", 1).cast("double").alias("label"),
        array_to_vector(_numbers(_fields(F.element_at("_parts", 2), " "))).alias("features"),
    )


def parse_keyed_csv(df: DataFrame, line: str = "value") -> DataFrame:
    """``id,f0,f1,...`` to (id, features); the id stays text."""
    staged, kept = _staged(df, line, _fields(F.col(line), ","))
    return staged.select(
        *kept,
        F.element_at("_parts", 1).alias("id"),
        array_to_vector(_numbers(_rest(F.col("_parts")))).alias("features"),
    )


def trimmed(line: Column) -> Column:
    """The line without blank characters at its ends.

    Spaces go the fast way; the pattern runs only where another blank is left.
    """
    body = F.trim(line)
    other = (F.ascii(body) < SPACE) | (F.ascii(F.right(body, F.lit(1))) < SPACE)
    return F.when(other, F.regexp_extract(line, UNTIL_LAST_INK, 1)).otherwise(body)


def clean_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """Trim, and drop blank lines and ``#`` comments.

    The filter looks at the raw line, so the trimming is not done twice.
    """
    return df.where(F.col(line).rlike(NOT_BLANK_NOR_COMMENT)).withColumn(
        line, trimmed(F.col(line))
    )


def parse_libsvm(df: DataFrame, line: str = "value") -> DataFrame:
    """``label i:v i:v`` to (label, indices from 0, values); spare spaces are ignored."""
    tokens, kept = _staged(df, line, F.filter(F.split(F.col(line), " "), lambda t: t != ""))
    items = tokens.select(
        *kept, F.element_at("_parts", 1).cast("double").alias("label"),
        _rest(F.col("_parts")).alias("_items"),
    )
    def index_text(item: Column) -> Column:
        return F.substring_index(item, ":", 1)

    def value_text(item: Column) -> Column:
        # An item without a colon leaves an empty text, which no cast accepts.
        return F.substr(item, F.length(index_text(item)) + 2)

    return items.select(
        *kept, "label",
        F.transform("_items", lambda t: index_text(t).cast("int") - 1).alias("indices"),
        F.transform("_items", lambda t: value_text(t).cast("double")).alias("values"),
    )


def infer_width(df: DataFrame) -> DataFrame:
    """One row: largest last index (0 for a line without features) plus one."""
    last = F.coalesce(F.try_element_at("indices", F.lit(-1)), F.lit(0))
    return df.agg((F.max(last) + 1).alias("width"))


def to_vector(df: DataFrame, width: int) -> DataFrame:
    """Replace (indices, values) by a ``features`` vector of ``width`` slots.

    Indices must increase strictly from 0 to at most ``width`` - 1, whatever the
    width; else it is an error. Narrow vectors are filled slot by slot. Wide ones
    are sparse: the vector type is stored as a struct of type, size, indices and values, and
    batches of that struct are handed over, as they are, to a schema that names the type.
    """
    kept = [c for c in df.columns if c not in ("indices", "values")]
    df = df.withColumn("indices", _checked_indices(width))
    if width <= DENSE_WIDTH:
        return df.select(*kept, array_to_vector(_filled_slots(width)).alias("features"))
    stored = F.struct(
        F.lit(SPARSE_KIND).cast("tinyint").alias("type"),
        F.lit(width).cast("int").alias("size"),
        F.col("indices"),
        F.col("values"),
    )
    rows = df.select(*kept, stored.alias("features"))
    typed = StructType([*rows.drop("features").schema.fields, StructField("features", VectorUDT())])
    return rows.mapInArrow(lambda batches: batches, typed)


def _checked_indices(width: int) -> Column:
    """The indices, if each is larger than the one before (the first than -1) and below the width."""
    i = F.col("indices")
    increasing = i == F.array_distinct(F.sort_array(i))
    inside = (F.size(i) == 0) | ((F.try_element_at(i, F.lit(1)) >= 0) & (F.try_element_at(i, F.lit(-1)) < width))
    fits = F.coalesce(increasing & inside & (F.size(i) == F.size("values")), F.lit(False))
    message = F.lit(f"feature indices must increase strictly from 0 to {width - 1}")
    return F.when(fits, i).otherwise(F.raise_error(message).cast("array<int>"))


def _filled_slots(width: int) -> Column:
    """Values by slot."""
    def slot(i: int) -> Column:
        place = F.nullif(F.array_position("indices", i).cast("int"), F.lit(0))
        return F.coalesce(F.try_element_at("values", place), F.lit(0.0))

    return F.array(*[slot(i) for i in range(width)])


def parse_int(df: DataFrame, line: str = "value", strict: bool = True) -> DataFrame:
    """Message to ``number INT``; a bad message fails the job, or is dropped when lenient."""
    text = F.col(line)
    well_formed = text.rlike(INT_PATTERN)
    if strict:
        number = F.when(well_formed, text.cast("int")).otherwise(
            F.raise_error(F.concat(F.lit("not an integer: "), F.coalesce(text, F.lit("null"))))
        )
        return df.select(*_kept(df, line), number.cast("int").alias("number"))
    lenient = df.select(*_kept(df, line), F.when(well_formed, text.try_cast("int")).alias("number"))
    return lenient.where(F.col("number").isNotNull())


def tokens_of(line: Column) -> Column:
    """Tokens between single spaces: inner empties stay, trailing ones go.

    An empty line is one empty token; a line of spaces only has none.
    """
    body = F.rtrim(line)
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(F.split(body, " "))
    )


def tokenize(df: DataFrame, line: str = "value") -> DataFrame:
    """One row per token, in column ``word``."""
    return df.select(*_kept(df, line), F.explode(tokens_of(F.col(line))).alias("word"))
