"""Declared schemas.  Nothing is inferred: every read passes a StructType."""

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
SALE = T.DecimalType(18, 2)
# sums are widened to 38 digits so that a 100 TB fact cannot overflow them
MONEY = T.DecimalType(38, 2)

SUPPLIER_DIM = T.StructType([
    T.StructField("supplier_id", T.LongType(), False),
    T.StructField("supplier_name", T.StringType()),
])

PRODUCT_DIM = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_name", T.StringType()),
    T.StructField("supplier_id", T.LongType()),
    T.StructField("price", PRICE),
])

CUSTOMER_DIM = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("customer_name", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("product_id", T.LongType()),
])

STORE_DIM = T.StructType([
    T.StructField("store_id", T.IntegerType(), False),
    T.StructField("store_name", T.StringType()),
    T.StructField("product_id", T.LongType()),
])

CUSTOMER = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("customer_name", T.StringType()),
    T.StructField("segment", T.StringType()),
])

PRODUCT_STORE = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("store_id", T.IntegerType()),
    T.StructField("store_name", T.StringType()),
])

# the reference's Time_Dimension is really the order-line table
TIME_DIM = T.StructType([
    T.StructField("time_id", T.LongType(), False),
    T.StructField("order_id", T.LongType()),
    T.StructField("line_number", T.IntegerType()),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("minute", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("qty", T.IntegerType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
])

SALES_FACT = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("time_id", T.LongType(), False),
    T.StructField("store_id", T.IntegerType(), False),
    T.StructField("total_sale", SALE),
    T.StructField("year", T.IntegerType()),   # partition column
])


# what a load keeps of a row that it could not use, with all its fields as text
REJECTS = T.StructType([
    T.StructField("source", T.StringType()),   # file or table the row came from
    T.StructField("key", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("reason", T.StringType()),
])


FACT_REJECTS = T.StructType([
    T.StructField("time_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("qty", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("reason", T.StringType()),
])

# place of a row of master data: file, start of the read block, place in the block
ROW_ORD = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("place", T.LongType()),
])

# dimensions as a warehouse stores them: the winning row of each key, with what it won by
SUPPLIER_LOG = T.StructType([*SUPPLIER_DIM, T.StructField("row_ord", ROW_ORD)])
PRODUCT_LOG = T.StructType([
    *PRODUCT_DIM, *PRODUCT_STORE.fields[1:], T.StructField("row_ord", ROW_ORD)])
STORE_LOG = T.StructType([*STORE_DIM, T.StructField("row_ord", ROW_ORD)])
CUSTOMER_LOG = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("customer_name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("bought", T.BooleanType()),   # has a line of its own
    T.StructField("undated", T.BooleanType()),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("qty", T.IntegerType()),
])

LOAD_AUDIT = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("attempted", T.LongType()),
    T.StructField("loaded", T.LongType()),
    T.StructField("rejected", T.LongType()),
    T.StructField("repeated", T.LongType()),
])

# what the incremental checks of streamed lines have found
VIOLATIONS = T.StructType([
    T.StructField("constraint", T.StringType()),
    T.StructField("key", T.StringType()),
])

# the files whose lines a version holds
LANDED = T.StructType([T.StructField("file", T.StringType())])


def by_batch(schema: T.StructType) -> T.StructType:
    """``schema`` and the columns that lay out a table by stream and batch."""
    return T.StructType([*schema, T.StructField("stream", T.StringType()),
                         T.StructField("batch_id", T.LongType())])


def conform(df, schema: T.StructType):
    """The declared columns of ``schema``, in its order and with its types
    (the DDL of the reference's tables, applied at write time)."""
    from pyspark.sql import functions as F
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])

# CSV round trip of the supplier dimension; short or long rows go to _corrupt
SUPPLIER_CSV = T.StructType([
    T.StructField("supplier_id", T.LongType()),
    T.StructField("supplier_name", T.StringType()),
    T.StructField("_corrupt", T.StringType()),
])


# fixed values: header names of the reference's two input files, in file order
MASTER_CSV_COLUMNS = ("productID", "productName", "productPrice", "supplierID",
                      "supplierName", "storeID", "storeName")
TRANSACTION_CSV_COLUMNS = ("Order ID", "Order Date", "ProductID", "CustomerID",
                           "CustomerName", "Gender", "Quantity Ordered")


def csv_strings(columns) -> T.StructType:
    """All-string schema for a CSV file, plus the corrupt-record column."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns]
                        + [T.StructField("_corrupt", T.StringType())])
