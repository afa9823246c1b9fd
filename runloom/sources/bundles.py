"""Loading and saving the metadata collections."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import safe_identifier
from ..operators.bundle import ACCESSION_COLLECTIONS, Bundle
from ..ordering import ORD
from ..violations import violation_rows
from .schemas import struct_type


def _exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def save_bundle(bundle: Bundle, directory: str, *, format: str = "parquet", mode: str = "overwrite") -> None:
    """Write each present collection to its own folder, order column included."""
    for field in fields(Bundle):
        df = getattr(bundle, field.name)
        if df is not None:
            df.write.mode(mode).format(format).save(f"{directory.rstrip('/')}/{field.name}")


def load_bundle(spark: SparkSession, directory: str, *, format: str = "parquet") -> Bundle:
    """Read the collections back; an absent folder is an empty collection."""
    found = {}
    for field in fields(Bundle):
        path = f"{directory.rstrip('/')}/{field.name}"
        if _exists(spark, path):
            found[field.name] = spark.read.format(format).load(path)
    return Bundle(**found).filled(spark)


def collections_from_document(spark: SparkSession, path: str, *, lines: bool = False) -> Bundle:
    """A bundle from JSON documents with one list per collection; absent ones are empty.

    A file is one document, which one task reads as a whole, or with ``lines`` one per line,
    so files are read in splits; writers keep large collections in many documents.
    """
    wide = T.StructType(
        [T.StructField(f.name, T.ArrayType(_loose(struct_type(f.name)))) for f in fields(Bundle)]
    )
    found = {}
    for field in fields(Bundle):
        # A reader parses what its schema names, so it names this collection only.
        documents = spark.read.schema(T.StructType([wide[field.name]])).option("multiLine", not lines).json(path)
        place = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_block_start")] if lines else [F.col("_metadata.file_path").alias("file")]
        order = F.struct(F.col("file_path").alias("file"), F.col("file_block_start").alias("split"), "row_id", "pos") if lines else F.struct("file", "pos")
        rows = documents.select(
            *place, F.monotonically_increasing_id().alias("row_id"), F.posexplode(field.name).alias("pos", "row")
        ).select("row.*", order.alias(ORD))
        if "attributes" in rows.columns:
            rows = rows.withColumn("attributes", _attribute_lists(F.col("attributes")))
        found[field.name] = rows
    return Bundle(**found)


def _attribute_lists(text: Column) -> Column:
    """JSON text of an object whose values are one text or a list, as a map of lists."""
    one = F.from_json(text, "map<string,string>")
    return F.transform_values(
        one, lambda _, v: F.when(F.startswith(F.ltrim(v), F.lit("[")), F.coalesce(F.from_json(v, "array<string>"), F.array(v))).otherwise(F.array(v))
    )


def _loose(schema: T.StructType) -> T.StructType:
    """The schema with attribute maps left as text, where a value may be one or many."""
    return T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == "attributes" else f.dataType) for f in schema.fields]
    )


def shape_violations(spark: SparkSession, path: str) -> DataFrame:
    """Collections of a JSON document that are not lists of objects, as violation rows."""
    names = [f.name for f in fields(Bundle)]
    documents = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("doc")
    )
    kinds = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.schema_of_variant(F.try_variant_get("doc", f"$.{n}", "variant")).alias("kind"))
            for n in names
        ]
    )
    wrong = documents.select("file", F.explode(kinds).alias("c")).filter(
        F.col("c.kind").isNotNull() & ~F.col("c.kind").rlike(r"^ARRAY<(OBJECT<.*>|VOID)>$|^ARRAY<>$")
    )
    not_object = documents.filter(F.col("doc").isNull() | ~F.schema_of_variant("doc").startswith("OBJECT"))
    return violation_rows(wrong, "load_bundle", F.col("c.name"), F.lit("must be a list of mappings")).unionByName(
        violation_rows(not_object, "load_bundle", F.col("file"), F.lit("must be a mapping"))
    )


def save_ndjson(bundle: Bundle, directory: str) -> None:
    """JSON lines per collection with sorted names, for exchange with other tools."""
    for name in ACCESSION_COLLECTIONS:
        df = getattr(bundle, name)
        if df is None:
            continue
        columns = sorted(c for c in df.columns if c != ORD)
        df.select(*columns).write.mode("overwrite").json(f"{directory.rstrip('/')}/{name}.ndjson")


def save_descriptions(maps: DataFrame, path: str) -> None:
    """One JSON document per row, spread over folders by a hash of the experiment."""
    (
        maps.select(
            F.hex(F.pmod(F.xxhash64("experiment"), F.lit(256))).alias("bucket"),
            F.to_json(
                F.struct(safe_identifier(F.col("experiment")).alias("id"), *[c for c in maps.columns if c != "experiment"])
            ).alias("document"),
        )
        .write.mode("overwrite")
        .partitionBy("bucket")
        .text(path)
    )


def save_index(index: DataFrame, path: str) -> None:
    """Write the completeness index as a table."""
    index.write.mode("overwrite").parquet(path)
