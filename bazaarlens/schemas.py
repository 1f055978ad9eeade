"""Explicit schemas of every record the engine reads or writes."""

from pyspark.sql import types as T

PRICE = T.StructType(
    [
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("currency", T.StringType(), False),
    ]
)
STOCK = T.StructType(
    [T.StructField("available", T.IntegerType()), T.StructField("reserved", T.IntegerType())]
)
IMAGE = T.StructType([T.StructField("url", T.StringType()), T.StructField("alt", T.StringType())])

PRODUCT = T.StructType(
    [
        T.StructField("product_id", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("description", T.StringType()),
        T.StructField("price", PRICE),
        T.StructField("category", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("stock", STOCK),
        T.StructField("sku", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("images", T.ArrayType(IMAGE)),
        T.StructField("specifications", T.MapType(T.StringType(), T.StringType())),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("index", T.StringType()),
        T.StructField("store_id", T.StringType()),
    ]
)

REQUEST = T.StructType(
    [T.StructField("product_name", T.StringType()), T.StructField("timestamp", T.StringType())]
)

POPULAR = T.StructType(
    [
        T.StructField("rank", T.IntegerType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("search_count", T.LongType()),
    ]
)

RECOMMENDATION = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("alternatives", T.ArrayType(T.StringType())),
        T.StructField("timestamp", T.StringType()),
    ]
)

FILTERED_PRODUCT = T.StructType(
    [
        T.StructField("price", PRICE),
        T.StructField("product_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

ALLOW_LIST = T.StructType(
    [T.StructField("position", T.LongType()), T.StructField("product_id", T.StringType())]
)

# The columns of a topic message, as Spark's own topic source names them.
MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

MESSAGE_TEXT = T.StructType([T.StructField("value", T.StringType())])

METRIC_SAMPLE = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("metric", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("cluster", T.StringType()),
        T.StructField("instance", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("value", T.DoubleType()),
    ]
)
