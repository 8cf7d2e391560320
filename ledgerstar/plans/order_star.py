"""The same star model over an order table: one wide row per order with customer and nation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.contracts import Contract, Field, Reference
from ledgerstar.operators.star import Attribute, Dimension, Star
from ledgerstar.plans.star_build import StarTables, build_star
from ledgerstar.session import Scratch
from ledgerstar.sources.tables import table

ORDER_STAR = Star(
    fact="fact_orders",
    fact_key="order_id",
    members=(
        Attribute("order_key", "bigint", "o_orderkey"),
        Attribute("customer_name", "string", "c_name"),
        Attribute("customer_balance", "double", "c_acctbal"),
        Dimension("dim_nation", "nation_id", "nation_name", "n_name"),
        Dimension("dim_segment", "segment_id", "segment_name", "c_mktsegment"),
        Attribute("order_date", "date", "o_orderdate"),
        Dimension("dim_priority", "priority_id", "priority_name", "o_orderpriority"),
        Dimension("dim_status", "status_id", "status_name", "o_orderstatus"),
        Attribute("order_price", "double", "o_totalprice"),
    ),
)

EXPECTED_ORDER_MEMBERS = {"dim_nation": 25, "dim_priority": 5, "dim_segment": 5, "dim_status": 3}

# Amounts in cents, so that the text a fingerprint is taken of does not depend on float formatting.
ORDERS = Contract(
    "orders",
    (
        Field("o_orderkey", "bigint"),
        Field("o_custkey", "bigint"),
        Field("o_orderstatus", "string"),
        Field("o_totalprice", "decimal(18,2)"),
        Field("o_orderdate", "date"),
        Field("o_orderpriority", "string"),
    ),
)
STORED_ORDERS = Contract("stored_orders", (Field("row_hash", "string"), *ORDERS.fields), key=("row_hash",))

LAST_ORDERS = Contract(
    "last_orders",
    (
        Field("o_custkey", "bigint"),
        Field("o_orderdate", "date"),
        Field("o_orderkey", "bigint"),
        Field("o_totalprice", "double"),
    ),
    key=("o_custkey",),
)

CUSTOMER_EXTRACT = Contract(
    "customer_extract",
    (
        Field("c_custkey", "bigint"),
        Field("c_name", "string"),
        Field("c_nationkey", "int"),
        Field("c_acctbal", "double"),
        Field("c_mktsegment", "string"),
    ),
)
STORED_CUSTOMERS = Contract(
    "stored_customers", (Field("row_hash", "string"), *CUSTOMER_EXTRACT.fields), key=("row_hash",)
)

STORED_DOCUMENTS = Contract(
    "stored_documents",
    (Field("row_hash", "string"), Field("text", "string"), Field("lang", "string")),
    key=("row_hash",),
)

# Declared constraints of the given tables; some of them do not hold in the data.
TABLE_CONTRACTS = (
    Contract("nation", (Field("n_nationkey", "int"), Field("n_name", "string", True)), ("n_nationkey",)),
    Contract(
        "customer",
        (
            Field("c_custkey", "bigint"),
            Field("c_name", "string", True),
            Field("c_nationkey", "int"),
        ),
        key=("c_custkey",),
        unique=(("c_name",),),
        references=(Reference("c_nationkey", "nation", "n_nationkey"),),
    ),
    Contract(
        "orders",
        (Field("o_orderkey", "bigint"), Field("o_custkey", "bigint", True)),
        key=("o_orderkey",),
        references=(Reference("o_custkey", "customer", "c_custkey"),),
    ),
    Contract(
        "lineitem",
        (Field("l_orderkey", "bigint"), Field("l_linenumber", "int")),
        key=("l_orderkey", "l_linenumber"),
        references=(Reference("l_orderkey", "orders", "o_orderkey"),),
    ),
    Contract(
        "documents",
        (Field("doc_id", "bigint"), Field("text", "string", True), Field("lang", "string", True)),
        key=("doc_id",),
        unique=(("text", "lang"),),
    ),
)


def flat_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order. A customer with very many orders is split by AQE's skew join."""
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    customer = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "inner"
    )
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "inner").select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        "o_orderpriority",
        "c_name",
        "c_acctbal",
        "c_mktsegment",
        "n_name",
    )


def build_order_star(spark: SparkSession, folder: str) -> StarTables:
    """Stage the wide rows once, then build the star from them, in a folder of its own."""
    scratch = Scratch(spark)
    flat_orders(spark, folder).write.mode("overwrite").parquet(scratch.path("raw"))
    return build_star(spark, scratch.path("raw"), ORDER_STAR, scratch.path("star"))
