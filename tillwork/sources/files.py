"""Reviews from JSON, preferences and specifications from XML, exported counts from CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwork import schemas
from tillwork.functions.names import clean_names
from tillwork.sources import splitting


def read_json_array(spark: SparkSession, path: str, schema: StructType, layout: str) -> DataFrame:
    """One row per element of top-level arrays.

    ``document``: an array may be spread over lines in any way; each file is read by one task, so
    large inputs should be many files. ``split``: any formatting, and many tasks read one file, which is scanned
    three times for that (``sources.splitting``). ``lines``: no element spans two lines (an array with an
    element per line, an array per line, or plain JSON lines); such files are split and scanned once. Malformed
    input fails the job in all.
    """
    if layout == "split":
        records = splitting.read_records(spark, path, splitting.JsonText())
        return records.select(F.from_json("text", schema, {"mode": "FAILFAST"}).alias("row")).select("row.*")
    if layout == "document":
        return spark.read.schema(schema).options(multiLine=True, mode="FAILFAST").json(path)
    if layout != "lines":
        raise ValueError(f"unknown layout {layout!r}; use 'document', 'split' or 'lines'")
    line = F.col("value")
    elements = F.regexp_extract(line, r"(?s)^\s*\[?\s*(\{.*\})\s*,?\s*\]?\s*,?\s*$", 1)
    # Lines of brackets, commas and blanks hold no element.
    empty = line.rlike(r"^[\s\[\],]*$")
    checked = F.when(empty, "").when(elements != "", elements).otherwise(
        F.raise_error(F.concat(F.lit("not a line of whole JSON objects: "), F.substring(line, 1, 200)))
    )
    array_type = f"array<{schema.simpleString()}>"
    return (
        spark.read.text(path)
        .select(F.concat(F.lit("["), checked, F.lit("]")).alias("elements"))
        .select(F.from_json("elements", array_type, {"mode": "FAILFAST"}).alias("rows"))
        .select(F.inline("rows"))
    )


def aspect_array(aspects: Column) -> Column:
    """Aspects as an array. A single object counts as an array of one, and so does a bare text, number or flag: a name without a rating.

    Anything else that does not fit, such as a rating that is no number, fails the job as other malformed input does.
    """
    kind = F.schema_of_variant(aspects)
    named = F.struct(F.variant_get(aspects, "$", "string").alias("name"), F.lit(None).cast("double").alias("rating"))
    return (
        F.when(kind.startswith("ARRAY") | (kind == "VOID"), F.variant_get(aspects, "$", schemas.ASPECTS_TYPE))
        .when(kind.startswith("OBJECT"), F.array(F.variant_get(aspects, "$", schemas.ASPECT_TYPE)))
        .when(kind.isNotNull(), F.array(named))
    )


def project_reviews(raw: DataFrame) -> DataFrame:
    """Typed review columns from the raw fields. Ratings round half up to whole numbers."""
    whole = "decimal(38,0)"
    return raw.select(
        "review_id",
        "product_id",
        "customer_id",
        F.col("rating").cast(whole).alias("rating"),
        "title",
        "content",
        F.col("date").cast("date").alias("review_date"),
        "verified_purchase",
        F.col("helpful_votes").cast(whole).cast("long").alias("helpful_votes"),
        aspect_array(F.col("aspects")).alias("aspects"),
    )


def read_reviews(spark: SparkSession, path: str, layout: str) -> DataFrame:
    return project_reviews(read_json_array(spark, path, schemas.REVIEWS_JSON, layout))


def with_lineage(df: DataFrame, source_file: str) -> DataFrame:
    """Add where the rows came from and when they were loaded."""
    return df.withColumns({"source_file": F.lit(source_file), "last_updated": F.current_timestamp()})


def read_xml_records(spark: SparkSession, path: str, row_tag: str, schema: StructType, layout: str) -> DataFrame:
    """One row per ``row_tag`` element.

    ``document``: Spark's XML reader; each file is read by one task, so large inputs should be many
    files. ``split``: many tasks read one file in UTF-8, with comments, CDATA and quoted attributes that hold the tag; it is
    scanned three times for that (``sources.splitting``). ``records``: the text is cut at the closing tags and scanned once, which
    suits generated files whose tags appear only as such. Malformed input fails
    the job in all, and an empty element, ``<tag/>`` too, is a row in all.
    """
    if layout == "split":
        records = splitting.read_records(spark, path, splitting.XmlText(row_tag))
        return records.select(F.from_xml("text", schema, {"mode": "FAILFAST"}).alias("row")).select("row.*")
    if layout == "document":
        return spark.read.schema(schema).options(rowTag=row_tag, mode="FAILFAST").xml(path)
    if layout != "records":
        raise ValueError(f"unknown layout {layout!r}; use 'document', 'split' or 'records'")
    closing = f"</{row_tag}>"
    opening = rf"(?s)<{row_tag}(?:\s[^>]*[^/>])?>.*"
    empty = rf"<{row_tag}(?:\s[^>]*)?/>"
    whole = F.regexp_extract("value", opening, 0)
    pieces = F.concat(
        F.regexp_extract_all("value", F.lit(empty), F.lit(0)),
        F.when(whole != "", F.array(F.concat(whole, F.lit(closing)))).otherwise(F.array().cast("array<string>")),
    )
    return (
        spark.read.option("lineSep", closing)
        .text(path)
        .select(F.explode(pieces).alias("record"))
        .select(F.from_xml("record", schema, {"mode": "FAILFAST"}).alias("row"))
        .select("row.*")
    )


def _children_of(records: DataFrame, path: str, key: str, child: str, outs: dict[str, str]) -> DataFrame:
    """One row per child element; a record without children gives none."""
    exploded = with_lineage(records, path).select(key, "source_file", "last_updated", F.explode(child).alias("_child"))
    return exploded.select(
        F.col(key).cast("string").alias(key),
        "source_file",
        "last_updated",
        *[F.col("_child").getField(name).cast("string").alias(out) for name, out in outs.items()],
    )


def read_preferences(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """``customer`` records with ``preference`` children."""
    records = read_xml_records(spark, path, "customer", schemas.PREFERENCES_XML, layout)
    outs = {"type": "preference_type", "value": "preference_value"}
    return _children_of(records, path, "customer_id", "preference", outs)


def read_specifications(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """``product`` records with ``specification`` children."""
    records = read_xml_records(spark, path, "product", schemas.SPECIFICATIONS_XML, layout)
    outs = {"name": "spec_name", "value": "spec_value"}
    return _children_of(records, path, "product_id", "specification", outs)


def read_preference_counts(spark: SparkSession, path: str) -> DataFrame:
    """The exported counts, with cleaned names."""
    reader = spark.read.schema(schemas.PREFERENCE_COUNTS).option("header", True).option("escape", '"')
    return clean_names(reader.csv(path))


def project_paths(df: DataFrame, column: str, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """``alias -> (path, type)`` columns out of JSON text; the text is parsed once per row."""
    document = F.col("_document")
    parsed = df.withColumn("_document", F.parse_json(column))
    values = [F.variant_get(document, path, kind).alias(alias) for alias, (path, kind) in paths.items()]
    return parsed.select(*[F.col(name) for name in df.columns if name != column], *values)
