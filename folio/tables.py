"""The model of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions.predicates import field
from folio.model import ArrayOf, Collection, GeoPoint, MapOf, Model, Reference, SubCollection
from folio.operators.query import DocQuery, query

MODEL = Model(
    Collection("region", "r_regionkey"),
    Collection("nation", "n_nationkey", references=(Reference("region", "region", "n_regionkey"),)),
    Collection("customer", "c_custkey", references=(Reference("nation", "nation", "c_nationkey"),), children=(SubCollection("orders", "orders", "o_custkey"),)),
    Collection("tenant_customer", "c_custkey", table="customer", default_filter=lambda: field("c_mktsegment") == "BUILDING"),
    Collection("profile", "c_custkey", table="customer_profile", references=(Reference("home", "nation", "account.nation"),)),
    Collection("supplier", "s_suppkey", references=(Reference("nation", "nation", "s_nationkey"),)),
    Collection("part", "p_partkey", table="part_tagged", arrays=(ArrayOf("tags"),), persist_null=frozenset({"p_brand"})),
    Collection("orders", "o_orderkey", references=(Reference("customer", "customer", "o_custkey"),), children=(SubCollection("lines", "lineitem", "l_orderkey"),), enums={"o_orderstatus": ("F", "O", "P")}, persist_null=frozenset({"priority"})),
    Collection("nullable_orders", "o_orderkey", table="orders_nullable", persist_null=frozenset({"priority"})),
    Collection("lineitem", None, references=(Reference("part", "part", "l_partkey"), Reference("supplier", "supplier", "l_suppkey"), Reference("order", "orders", "l_orderkey"))),
    Collection("rich_supplier", "s_suppkey", table="supplier", references=(Reference("nation", "far_nation", "s_nationkey"),)),
    Collection("far_nation", "n_nationkey", table="far_nation"),
    Collection("event", "event_id", table="events_mapped", maps=(MapOf("props"),)),
    Collection("basket", "o_orderkey", table="baskets", arrays=(ArrayOf("parts", "reference", "part"),)),
    Collection("order_lists", "o_orderkey", arrays=(ArrayOf("quantities"), ArrayOf("discounts"), ArrayOf("flags"), ArrayOf("spots", "geo"), ArrayOf("lots", "embedded", ignore=("secret",))), enums={"flags": ("A", "N", "R")}),
    Collection("place", "s_suppkey", table="places", points=(GeoPoint("spot", "north", "east"), GeoPoint("address.spot", "north", "east")), maps=(MapOf("rooms", ignore=("secret",)),)),
    Collection("buyer", "c_custkey", table="customer", children=(SubCollection("baskets", "filled_basket", "o_custkey"),)),
    Collection("filled_basket", "o_orderkey", table="filled_baskets", arrays=(ArrayOf("items", "reference", "part", fk="part_id"),)),
    Collection("shelf", "o_orderkey", table="shelves", arrays=(ArrayOf("boxes.items", "reference", "part", fk="part_id"),)),
)


def frames(spark: SparkSession, sf_dir: str):
    """Tables by name; some are derived, for shapes that the plain tables don't have."""

    def plain(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def lists() -> DataFrame:
        return plain("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("parts")).withColumnRenamed("l_orderkey", "o_orderkey")

    def order_lists() -> DataFrame:
        values = {"quantities": F.col("l_quantity").cast("int"), "discounts": F.col("l_discount"), "flags": F.col("l_returnflag"), "spots": F.struct(F.col("l_discount").alias("latitude"), F.col("l_tax").alias("longitude")), "lots": F.struct(F.col("l_partkey").alias("part_id"), F.col("l_linenumber").alias("line"), F.col("l_linestatus").alias("secret"))}
        return plain("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(*[F.collect_list(v).alias(k) for k, v in values.items()])

    derived = {
        "part_tagged": lambda: plain("part").withColumns({"tags": F.split("p_name", " "), "is_large": F.col("p_size") > 25}),
        "customer_profile": lambda: plain("customer").select("c_custkey", "c_name", F.struct(F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).alias("account")),
        "orders_nullable": lambda: plain("orders").select("o_orderkey", "o_totalprice", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority")),
        "far_nation": lambda: plain("nation").filter("n_regionkey > 1"),
        "events_mapped": lambda: plain("events").withColumn("props", F.from_json("props", "map<string,int>")),
        "baskets": lists,
        "order_lists": order_lists,
        "places": lambda: plain("supplier").select("s_suppkey", (F.col("s_acctbal") / 1000).alias("north"), F.col("s_nationkey").alias("east"), F.struct(F.col("s_name").alias("street"), F.struct(F.col("s_acctbal").alias("north"), F.lit(1.5).alias("east")).alias("spot")).alias("address"), F.create_map(F.lit("first"), F.struct(F.col("s_nationkey").alias("beds"), F.lit("x").alias("secret"))).alias("rooms")),
        "filled_baskets": lambda: plain("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_partkey").alias("part_id"), F.col("l_quantity").alias("n"))).alias("items")).join(plain("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", "o_custkey", "items"),
        "thin_profile": lambda: plain("customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.struct(F.col("c_acctbal").alias("balance"), F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).alias("group"))).alias("account")),
        "shelves": lambda: lists().select("o_orderkey", F.array(F.struct(F.lit("all").alias("label"), F.transform("parts", lambda p: F.struct(p.alias("part_id"))).alias("items"))).alias("boxes")),
    }
    return lambda name: derived[name]() if name in derived else plain(name)


def documents(spark: SparkSession, sf_dir: str, name: str) -> DocQuery:
    return query(MODEL, frames(spark, sf_dir), name)
