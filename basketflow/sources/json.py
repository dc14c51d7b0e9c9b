"""Exported product-view hits (nested JSON) and their flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

N_CHARACTERISTICS = 10

# Layout of an exported product-view hit (the domain classes).
_NAME_VALUE = "array<struct<name: string, value: string>>"
PRODUCT_VIEW_SCHEMA = (
    "`_index` string, `_type` string, `_id` string, `_score` long, "
    "`_source` struct<`@timestamp`: string, `@version`: string, sessionId: string, "
    "product: struct<id: string, date: string, description: string, title: string, "
    "productInfo: string, account: string, price: double, enabled: boolean, "
    f"tags: array<string>, characteristic: {_NAME_VALUE}, "
    "category: struct<title: string, description: string, parent: string, "
    f"characteristics: {_NAME_VALUE}>>>"
)


def read_product_views(spark: SparkSession, path: str, multi_line: bool = True,
                       schema: str | None = PRODUCT_VIEW_SCHEMA) -> DataFrame:
    """Read search-index hits (a JSON array per file, or JSON lines).

    The declared schema avoids an inference pass over all the data; pass
    ``schema=None`` to infer it instead. Missing fields read as NULL.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def flatten_product_views(hits: DataFrame, flag: str | None = None,
                          further: str | None = None) -> DataFrame:
    """Hits -> one row per view, shaped like the product-flag training table.

    Columns: ``session_id, product_id, category_title, price,
    characteristic_1..characteristic_10`` (value of the i-th characteristic,
    NULL when the product has fewer) and ``flag`` when a flag column is
    named. Missing characteristics become NULL, which the ``keep`` string
    indexer maps to its extra bucket. A product with more than ten keeps the
    values of the others in the list column that ``further`` names; without
    such a column it fails the job, rather than losing them.
    """
    src = F.col("_source")
    product = src["product"]
    chars = product["characteristic"]
    cols = [src["sessionId"].alias("session_id"),
            product["id"].alias("product_id"),
            product["category"]["title"].alias("category_title"),
            product["price"].cast("double").alias("price")]
    if further is None:
        too_many = F.size(chars) > N_CHARACTERISTICS
        chars = F.when(~F.coalesce(too_many, F.lit(False)), chars).otherwise(F.raise_error(F.concat(
            F.lit(f"more than {N_CHARACTERISTICS} characteristics: product "),
            F.coalesce(product["id"], F.lit("without id")))))
    cols += [F.get(chars, i - 1)["value"].cast("string").alias(f"characteristic_{i}")
             for i in range(1, N_CHARACTERISTICS + 1)]
    if further is not None:
        rest = F.slice(chars, N_CHARACTERISTICS + 1, F.greatest(F.size(chars), F.lit(1)))
        cols.append(F.transform(rest, lambda c: c["value"].cast("string")).alias(further))
    if flag is not None:
        cols.append(F.col(flag).cast("string").alias("flag"))
    return hits.select(*cols)


def read_hit_arrays(spark: SparkSession, path: str) -> DataFrame:
    """``(file, hit)``: exported hits in array form, one array per file, each
    hit a VARIANT.

    A file is one value (VARIANT allows 128 MB), so files are the unit of
    parallelism; hits may differ in shape, nothing is inferred or lost. A file
    that is no array of JSON fails the job; an empty array has no hits.
    """
    files = spark.read.text(path, wholetext=True) \
        .select(F.input_file_name().alias("file"), F.parse_json("value").alias("array"))
    elements = spark.tvf.variant_explode(F.col("array").outer())
    return files.lateralJoin(elements).select("file", F.col("value").alias("hit"))


def variant_product_views(hits: DataFrame, hit: str = "hit") -> DataFrame:
    """The domain class of a product view, from VARIANT hits: ids and titles as
    text, ``price`` as an exact decimal, ``enabled`` as a boolean and
    ``viewed_at`` from the product's ISO time string. Fields that a hit lacks are
    null; a field of another type than declared fails the job."""
    def field(path: str, kind: str) -> Column:
        return F.variant_get(F.col(hit), f"$._source.{path}", kind)

    return hits.select(
        field("sessionId", "string").alias("session_id"), field("product.id", "string").alias("product_id"),
        field("product.title", "string").alias("title"), field("product.price", "decimal(18,2)").alias("price"),
        field("product.enabled", "boolean").alias("enabled"),
        field("product.date", "timestamp").cast("timestamp_ntz").alias("viewed_at"),
        field("product.tags", "array<string>").alias("tags"),
        field("product.characteristic", "array<struct<name:string,value:string>>").alias("characteristic"))
