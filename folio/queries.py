"""Registered queries over the driver's tables, each with its DuckDB twin."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions.predicates import field, if_set
from folio.model import Collection, Model, SubCollection
from folio.operators import writes as W
from folio.operators.query import cast, child, query
from folio.sources.store import ParquetStore
from folio.tables import MODEL, documents, frames

_found: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}


def _query(sql: str, name: str | None = None):
    def register(f: Callable) -> Callable:
        _found[name or f.__name__] = f, sql
        return f

    return register


def _doc(name: str, collection: str, build: Callable, sql: str) -> None:
    """A query that is one builder expression."""
    _found[name] = (lambda spark, sf_dir: build(documents(spark, sf_dir, collection)).df()), sql


ORDER = ("o_orderkey", "o_totalprice")
_O = "select o_orderkey, o_totalprice from orders"
_P = "select p_partkey, p_name from part"
f = field

# filters
_doc("eq_string", "orders", lambda q: q.where(f("o_orderstatus") == "F").select(*ORDER), f"{_O} where o_orderstatus = 'F'")
_doc("eq_int", "part", lambda q: q.where(f("p_size") == 7).select("p_partkey", "p_size"), "select p_partkey, p_size from part where p_size = 7")
_doc("eq_double", "lineitem", lambda q: q.where(f("l_discount") == 0.05).count(), "select count(*) as value from lineitem where l_discount = 0.05")
_doc("eq_equals", "orders", lambda q: q.where(f("o_orderstatus").equals("P")).select(*ORDER), f"{_O} where o_orderstatus = 'P'")
_doc("ne_enum", "orders", lambda q: q.where(f("o_orderstatus") != 2).select(*ORDER), f"{_O} where o_orderstatus <> 'P'")
_doc("cmp_gt", "orders", lambda q: q.where(f("o_totalprice") > 400000).select(*ORDER), f"{_O} where o_totalprice > 400000")
_doc("cmp_ge", "orders", lambda q: q.where(f("o_totalprice") >= 400000).select(*ORDER), f"{_O} where o_totalprice >= 400000")
_doc("cmp_lt", "orders", lambda q: q.where(f("o_totalprice") < 20000).select(*ORDER), f"{_O} where o_totalprice < 20000")
_doc("cmp_le", "orders", lambda q: q.where(f("o_totalprice") <= 20000).select(*ORDER), f"{_O} where o_totalprice <= 20000")
_doc("date_between", "orders", lambda q: q.where(f("o_orderdate").between(datetime.datetime(1995, 1, 1), datetime.datetime(1995, 6, 30))).select(*ORDER), f"{_O} where o_orderdate between timestamp '1995-01-01' and timestamp '1995-06-30'")
_doc("reversed_cmp", "part", lambda q: q.where(5 < f("p_size")).select("p_partkey", "p_name"), f"{_P} where 5 < p_size")
_doc("and3", "part", lambda q: q.where((f("p_size") > 10) & (f("p_size") < 40) & (f("p_retailprice") > 1000)).select("p_partkey", "p_name"), f"{_P} where p_size > 10 and p_size < 40 and p_retailprice > 1000")
_doc("or_diff_fields", "orders", lambda q: q.where((f("o_orderstatus") == "P") | (f("o_totalprice") > 450000)).select(*ORDER), f"{_O} where o_orderstatus = 'P' or o_totalprice > 450000")
_doc("and_nested_or", "orders", lambda q: q.where((f("o_totalprice") > 200000) & ((f("o_orderstatus") == "P") | (f("o_orderpriority") == "1-URGENT"))).select(*ORDER), f"{_O} where o_totalprice > 200000 and (o_orderstatus = 'P' or o_orderpriority = '1-URGENT')")
_doc("or_of_ands", "orders", lambda q: q.where(((f("o_totalprice") > 300000) & (f("o_orderstatus") == "F")) | (f("o_orderpriority") == "5-LOW")).select(*ORDER), f"{_O} where (o_totalprice > 300000 and o_orderstatus = 'F') or o_orderpriority = '5-LOW'")
_doc("optional_param_set", "orders", lambda q: q.where(f("o_totalprice") > 300000, if_set("F", lambda v: f("o_orderstatus") == v)).select(*ORDER), f"{_O} where o_totalprice > 300000 and o_orderstatus = 'F'")
_doc("optional_param_none", "orders", lambda q: q.where(f("o_totalprice") > 300000, if_set(None, lambda v: f("o_orderstatus") == v)).select(*ORDER), f"{_O} where o_totalprice > 300000")
_doc("chained_where", "orders", lambda q: q.where(f("o_totalprice") > 100000).where(f("o_totalprice") < 120000).select(*ORDER), f"{_O} where o_totalprice > 100000 and o_totalprice < 120000")
_doc("bool_implicit", "part", lambda q: q.where(f("is_large")).select("p_partkey", "p_name"), f"{_P} where p_size > 25")
_doc("bool_negated", "part", lambda q: q.where(~f("is_large")).select("p_partkey", "p_name"), f"{_P} where not (p_size > 25)")
_doc("bool_negated_in_or", "part", lambda q: q.where(~f("is_large") | (f("p_size") == 50)).select("p_partkey", "p_name"), f"{_P} where not (p_size > 25) or p_size = 50")
_doc("in_list", "orders", lambda q: q.where(f("o_orderpriority").is_in(["1-URGENT", "5-LOW"])).select(*ORDER), f"{_O} where o_orderpriority in ('1-URGENT', '5-LOW')")
_doc("not_in_list", "orders", lambda q: q.where(f("o_orderpriority").not_in(["1-URGENT", "5-LOW"])).select(*ORDER), f"{_O} where o_orderpriority not in ('1-URGENT', '5-LOW')")
_doc("starts_with", "part", lambda q: q.where(f("p_name").starts_with("b")).select("p_partkey", "p_name"), f"{_P} where p_name >= 'b' and p_name < 'b' || chr(65535)")
_doc("starts_with_in_or", "part", lambda q: q.where(f("p_name").starts_with("s") | (f("p_size") == 3)).select("p_partkey", "p_name"), f"{_P} where starts_with(p_name, 's') or p_size = 3")
_doc("array_contains", "part", lambda q: q.where(f("tags").contains("blue")).select("p_partkey", "p_name"), f"{_P} where list_contains(string_split(p_name, ' '), 'blue')")
_doc("array_contains_any", "part", lambda q: q.where(f("tags").contains_any(["blue", "red", "green"])).select("p_partkey", "p_name"), f"{_P} where list_has_any(string_split(p_name, ' '), ['blue', 'red', 'green'])")
_doc("nested_path_filter", "profile", lambda q: q.where((f("account").segment == "BUILDING") & (f("account.balance") > 5000)).select("c_custkey", "account.balance"), "select c_custkey, c_acctbal as balance from customer where c_mktsegment = 'BUILDING' and c_acctbal > 5000")
_doc("reference_identity", "customer", lambda q: q.where(f("nation.n_nationkey") == 3).select("c_custkey", "c_name"), "select c_custkey, c_name from customer where c_nationkey = 3")
_doc("find_by_id", "customer", lambda q: q.find(42), "select * from customer where c_custkey = 42")
_doc("id_and_tenant", "customer", lambda q: q.where((f("c_custkey") == 4) & (f("c_mktsegment") == "BUILDING")), "select * from customer where c_custkey = 4 and c_mktsegment = 'BUILDING'")
_NULLABLE = "select o_orderkey, o_totalprice from orders where nullif(o_orderpriority, '5-LOW')"
_doc("is_null", "nullable_orders", lambda q: q.where(f("priority").is_null()).select(*ORDER), f"{_NULLABLE} is null")
_doc("is_not_null", "nullable_orders", lambda q: q.where(f("priority").is_not_null()).select(*ORDER), f"{_NULLABLE} is not null")
_doc("ne_drops_null", "nullable_orders", lambda q: q.where(f("priority") != "1-URGENT").select(*ORDER), f"{_NULLABLE} <> '1-URGENT'")
_doc("default_filter", "tenant_customer", lambda q: q.select("c_custkey", "c_mktsegment"), "select c_custkey, c_mktsegment from customer where c_mktsegment = 'BUILDING'")
_doc("ignore_filters", "tenant_customer", lambda q: q.ignore_filters().select("c_custkey", "c_mktsegment"), "select c_custkey, c_mktsegment from customer")

# sort, limits, cardinality
_doc("scan", "nation", lambda q: q, "select * from nation")
_doc("order_asc", "orders", lambda q: q.order_by("o_totalprice").take(50).select(*ORDER), f"{_O} order by o_totalprice, o_orderkey limit 50")
_doc("order_desc", "orders", lambda q: q.order_by("o_totalprice", desc=True).take(50).select(*ORDER), f"{_O} order by o_totalprice desc, o_orderkey limit 50")
_doc("then_by", "customer", lambda q: q.order_by("c_mktsegment").then_by("c_acctbal").take(50).select("c_custkey", "c_acctbal"), "select c_custkey, c_acctbal from customer order by c_mktsegment, c_acctbal, c_custkey limit 50")
_doc("then_by_desc", "customer", lambda q: q.order_by("c_mktsegment").then_by("c_acctbal", desc=True).take(50).select("c_custkey", "c_acctbal"), "select c_custkey, c_acctbal from customer order by c_mktsegment, c_acctbal desc, c_custkey limit 50")
_doc("order_omits_null", "nullable_orders", lambda q: q.order_by("priority").then_by("o_totalprice").take(40).select("o_orderkey", "priority"), "select o_orderkey, nullif(o_orderpriority, '5-LOW') as priority from orders where nullif(o_orderpriority, '5-LOW') is not null order by priority, o_totalprice, o_orderkey limit 40")
_doc("take", "orders", lambda q: q.where(f("o_orderstatus") == "F").order_by("o_orderkey").take(10).select(*ORDER), f"{_O} where o_orderstatus = 'F' order by o_orderkey limit 10")
_doc("skip_take", "orders", lambda q: q.order_by("o_totalprice", desc=True).skip(20).take(10).select(*ORDER), f"{_O} order by o_totalprice desc, o_orderkey limit 10 offset 20")
_doc("take_last", "orders", lambda q: q.order_by("o_totalprice").take_last(10).select(*ORDER), f"select * from ({_O} order by o_totalprice desc, o_orderkey desc limit 10)")
_doc("first", "orders", lambda q: q.where(f("o_orderstatus") == "P").order_by("o_totalprice").first().select(*ORDER), f"{_O} where o_orderstatus = 'P' order by o_totalprice, o_orderkey limit 1")
_doc("single", "customer", lambda q: q.single(f("c_custkey") == 7).select("c_custkey", "c_name"), "select c_custkey, c_name from customer where c_custkey = 7")
_doc("start_after", "orders", lambda q: q.order_by("o_totalprice").start_after(250000.0, 100).take(20).select(*ORDER), f"{_O} where o_totalprice > 250000.0 or (o_totalprice = 250000.0 and o_orderkey > 100) order by o_totalprice, o_orderkey limit 20")

# scalar aggregates
_doc("count", "orders", lambda q: q.count(), "select count(*) as value from orders")
_doc("count_pred", "orders", lambda q: q.count(f("o_orderstatus") == "F"), "select count(*) as value from orders where o_orderstatus = 'F'")
_doc("any", "orders", lambda q: q.any(f("o_totalprice") > 400000), "select count(*) > 0 as value from orders where o_totalprice > 400000")
_doc("any_none", "orders", lambda q: q.any(f("o_totalprice") < 0), "select count(*) > 0 as value from orders where o_totalprice < 0")
_doc("sum_int", "part", lambda q: q.sum("p_size"), "select cast(sum(p_size) as bigint) as value from part")
_found["sum"] = (lambda s, d: documents(s, d, "orders").sum("o_totalprice").df().select(F.round("value", 2).alias("value")), "select round(sum(o_totalprice), 2) as value from orders")
_doc("sum_empty", "orders", lambda q: q.where(f("o_totalprice") < 0).sum("o_totalprice"), "select coalesce(sum(o_totalprice), 0) as value from orders where o_totalprice < 0")
_found["avg"] = (lambda s, d: documents(s, d, "orders").avg("o_totalprice").df().select(F.round("value", 4).alias("value")), "select round(avg(o_totalprice), 4) as value from orders")
_doc("min", "orders", lambda q: q.min("o_totalprice"), "select min(o_totalprice) as value from orders")
_doc("max", "orders", lambda q: q.max("o_orderdate"), "select max(o_orderdate) as value from orders")
_doc("count_limited", "orders", lambda q: q.order_by("o_totalprice").take(25).count(), "select count(*) as value from (select * from orders order by o_totalprice limit 25)")
_doc("min_after_order", "orders", lambda q: q.order_by("o_totalprice", desc=True).take(5).min("o_totalprice"), "select min(o_totalprice) as value from (select o_totalprice from orders order by o_totalprice desc, o_orderkey limit 5)")

# projections
_doc("select_fields", "customer", lambda q: q.select("c_custkey", "c_name", "c_acctbal"), "select c_custkey, c_name, c_acctbal from customer")
_doc("select_rename", "customer", lambda q: q.select(id="c_custkey", label="c_name"), "select c_custkey as id, c_name as label from customer")
_doc("select_cast", "part", lambda q: q.select("p_partkey", size=cast("p_size", "double")), "select p_partkey, cast(p_size as double) as size from part")
_doc("select_single_drops_null", "nullable_orders", lambda q: q.select("priority"), "select nullif(o_orderpriority, '5-LOW') as priority from orders where nullif(o_orderpriority, '5-LOW') is not null")
_doc("select_struct_field", "profile", lambda q: q.select("c_custkey", "account.segment"), "select c_custkey, c_mktsegment as segment from customer")
_found["select_struct"] = (lambda s, d: documents(s, d, "profile").select("c_custkey", "account").df().select("c_custkey", F.col("account.balance").alias("balance"), F.col("account.segment").alias("segment")), "select c_custkey, c_acctbal as balance, c_mktsegment as segment from customer")
_found["select_array"] = (lambda s, d: documents(s, d, "part").select("p_partkey", "tags").df().select("p_partkey", F.array_join("tags", "|").alias("tags")), "select p_partkey, array_to_string(string_split(p_name, ' '), '|') as tags from part")
_found["select_map_value"] = (lambda s, d: documents(s, d, "event").select("event_id", k="props.k").df(), "select event_id, cast(json_extract(props, '$.k') as int) as k from events")
_found["select_nested_object"] = (lambda s, d: documents(s, d, "customer").select(id="c_custkey", who={"name": "c_name", "place": {"nation": "nation.n_name"}}).df().select("id", F.col("who.name").alias("name"), F.col("who.place.nation").alias("nation")), "select c_custkey as id, c_name as name, n_name as nation from customer left join nation on c_nationkey = n_nationkey")

# references
_doc("ref_scalar", "customer", lambda q: q.select("c_custkey", "nation.n_name"), "select c_custkey, n_name from customer left join nation on c_nationkey = n_nationkey")
_doc("ref_nested", "customer", lambda q: q.select("c_custkey", "nation.n_name", "nation.region.r_name"), "select c_custkey, n_name, r_name from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey")
_doc("ref_same_type_twice", "lineitem", lambda q: q.where(f("l_quantity") > 49).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", buyer="order.customer.nation.n_name", seller="supplier.nation.n_name"), "select l_orderkey, l_partkey, l_suppkey, l_linenumber, b.n_name as buyer, s.n_name as seller from lineitem left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey left join nation b on c_nationkey = b.n_nationkey left join supplier on l_suppkey = s_suppkey left join nation s on s_nationkey = s.n_nationkey where l_quantity > 49")
_doc("ref_null", "rich_supplier", lambda q: q.select("s_suppkey", "nation.n_name"), "select s_suppkey, n_name from supplier left join (select * from nation where n_regionkey > 1) on s_nationkey = n_nationkey")
_doc("ref_in_struct", "profile", lambda q: q.select("c_custkey", "home.n_name"), "select c_custkey, n_name from customer left join nation on c_nationkey = n_nationkey")
_found["ref_whole"] = (lambda s, d: documents(s, d, "rich_supplier").select("s_suppkey", "nation").df().select("s_suppkey", F.col("nation").isNull().alias("missing"), F.col("nation.n_name").alias("n_name")), "select s_suppkey, n_name is null as missing, n_name from supplier left join (select * from nation where n_regionkey > 1) on s_nationkey = n_nationkey")
_found["include_reference"] = (lambda s, d: documents(s, d, "customer").include("nation").df().select("c_custkey", F.col("nation.n_name").alias("n_name"), F.col("nation.n_regionkey").alias("n_regionkey")), "select c_custkey, n_name, n_regionkey from customer left join nation on c_nationkey = n_nationkey")
_found["include_reference_in_struct"] = (lambda s, d: documents(s, d, "profile").include("home").df().select("c_custkey", F.col("home.n_name").alias("n_name")), "select c_custkey, n_name from customer left join nation on c_nationkey = n_nationkey")


# sub-collections
@_query("select c_custkey, o_orderkey, o_totalprice from customer join orders on c_custkey = o_custkey")
def include_children(spark, sf_dir):
    nested = documents(spark, sf_dir, "customer").include(child("orders")).df()
    return nested.select("c_custkey", F.explode("orders").alias("o")).select("c_custkey", "o.o_orderkey", "o.o_totalprice")


@_query("select c_custkey, cast(count(o_orderkey) as int) as n from customer left join (select * from orders where o_totalprice > 480000) on c_custkey = o_custkey group by c_custkey")
def include_children_missing(spark, sf_dir):
    nested = documents(spark, sf_dir, "customer").include(child("orders").where(f("o_totalprice") > 480000)).df()
    return nested.select("c_custkey", F.size("orders").alias("n"))


@_query("select c_custkey, o_orderkey, cast(rn as int) as rn from (select o_custkey as c_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) - 1 as rn from orders where o_orderstatus = 'F') where rn >= 1 and rn < 3")
def include_filtered_topk(spark, sf_dir):
    kids = child("orders").where(f("o_orderstatus") == "F").order_by("o_totalprice", desc=True).skip(1).take(2)
    nested = documents(spark, sf_dir, "customer").include(kids).df()
    return nested.select("c_custkey", F.posexplode("orders").alias("p", "o")).select("c_custkey", "o.o_orderkey", (F.col("p") + 1).alias("rn"))


@_query("select c_custkey, o_orderkey, cast(count(l_orderkey) as int) as n_lines from customer join orders on c_custkey = o_custkey left join lineitem on o_orderkey = l_orderkey group by all")
def include_two_level(spark, sf_dir):
    nested = documents(spark, sf_dir, "customer").include(child("orders").include(child("lines"))).df()
    return nested.select("c_custkey", F.explode("orders").alias("o")).select("c_custkey", "o.o_orderkey", F.size("o.lines").alias("n_lines"))


@_query("select c_custkey, coalesce((select string_agg(o_orderkey || ':' || o_orderstatus, ',' order by o_orderkey) from orders where o_custkey = c_custkey), '') as orders from customer")
def child_projection(spark, sf_dir):
    nested = documents(spark, sf_dir, "customer").select("c_custkey", kids=child("orders").select("o_orderkey", "o_orderstatus")).df()
    return nested.select("c_custkey", F.array_join(F.transform("kids", lambda o: F.concat_ws(":", o["o_orderkey"].cast("string"), o["o_orderstatus"])), ",").alias("orders"))


@_query("select c_custkey, coalesce((select string_agg(o_orderkey, ',' order by o_totalprice desc, o_orderkey) from orders where o_custkey = c_custkey and o_totalprice > 300000), '') as orders from customer")
def child_scalar_list(spark, sf_dir):
    kids = child("orders").where(f("o_totalprice") > 300000).order_by("o_totalprice", desc=True).select("o_orderkey")
    return documents(spark, sf_dir, "customer").select("c_custkey", kids=kids).df().select("c_custkey", F.array_join("kids", ",").alias("orders"))


@_query("select c_custkey, o_orderkey from (select o_custkey as c_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) as rn from orders) where rn <= 2")
def child_top_k(spark, sf_dir):
    nested = documents(spark, sf_dir, "customer").select("c_custkey", kids=child("orders").order_by("o_orderdate", desc=True).take(2).select("o_orderkey")).df()
    return nested.select("c_custkey", F.explode("kids").alias("o_orderkey"))


@_query("select n_nationkey as k, c_custkey, cast(count(o_orderkey) as int) as n from nation join customer on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey group by all")
def child_nested_levels(spark, sf_dir):
    model = Model(Collection("nation", "n_nationkey", children=(SubCollection("customers", "customer", "c_nationkey"),)), Collection("customer", "c_custkey", children=(SubCollection("orders", "orders", "o_custkey"),)), Collection("orders", "o_orderkey"))
    kids = child("customers").select("c_custkey", ids=child("orders").select("o_orderkey"))
    nested = query(model, frames(spark, sf_dir), "nation").select("n_nationkey", kids=kids).df()
    return nested.select(F.col("n_nationkey").alias("k"), F.explode("kids").alias("c")).select("k", "c.c_custkey", F.size("c.ids").alias("n"))


def _per_customer(**aggregates: tuple) -> Callable:
    return lambda spark, sf_dir: documents(spark, sf_dir, "customer").select("c_custkey", **{k: v for k, (v, _) in aggregates.items()}).df().select("c_custkey", *[(F.round(k, r) if r else F.col(k)).alias(k) for k, (_, r) in aggregates.items()])


_LOJ = "from customer left join orders on c_custkey = o_custkey"
_found["child_count"] = _per_customer(n=(child("orders").count(), 0)), f"select c_custkey, count(o_orderkey) as n {_LOJ} group by c_custkey"
_found["child_sum"] = _per_customer(total=(child("orders").sum("o_totalprice"), 2)), f"select c_custkey, round(coalesce(sum(o_totalprice), 0), 2) as total {_LOJ} group by c_custkey"
_found["child_avg"] = _per_customer(mean=(child("orders").where(f("o_totalprice") > 300000).avg("o_totalprice"), 4)), f"select c_custkey, round(coalesce(avg(o_totalprice), 0), 4) as mean {_LOJ} and o_totalprice > 300000 group by c_custkey"
_found["child_min_max"] = _per_customer(least=(child("orders").min("o_totalprice"), 0), most=(child("orders").max("o_totalprice"), 0)), f"select c_custkey, min(o_totalprice) as least, max(o_totalprice) as most {_LOJ} group by c_custkey"
_found["child_filtered_sum"] = _per_customer(total=(child("orders").where(f("o_orderstatus") == "F").sum("o_totalprice"), 2)), f"select c_custkey, round(coalesce(sum(o_totalprice), 0), 2) as total {_LOJ} and o_orderstatus = 'F' group by c_custkey"
_found["child_multi_agg"] = _per_customer(n=(child("orders").count(), 0), late=(child("orders").where(f("o_orderstatus") == "O").count(), 0), total=(child("orders").sum("o_totalprice"), 2)), f"select c_custkey, count(o_orderkey) as n, count(o_orderkey) filter (o_orderstatus = 'O') as late, round(coalesce(sum(o_totalprice), 0), 2) as total {_LOJ} group by c_custkey"


@_query(f"select c_custkey, c_name, count(o_orderkey) as n, round(coalesce(sum(o_totalprice), 0), 2) as total {_LOJ} group by all")
def child_agg_object(spark, sf_dir):
    nested = documents(spark, sf_dir, "customer").select("c_custkey", "c_name", summary={"n": child("orders").count(), "total": child("orders").sum("o_totalprice")}).df()
    return nested.select("c_custkey", "c_name", F.col("summary.n").alias("n"), F.round("summary.total", 2).alias("total"))


@_query("select o_orderkey, p_name from orders join lineitem on o_orderkey = l_orderkey left join part on l_partkey = p_partkey where l_quantity > 45")
def child_ref(spark, sf_dir):
    nested = documents(spark, sf_dir, "orders").select("o_orderkey", kids=child("lines").where(f("l_quantity") > 45).select("l_partkey", name="part.p_name")).df()
    return nested.select("o_orderkey", F.explode("kids").alias("k")).select("o_orderkey", F.col("k.name").alias("p_name"))


@_query("select l_orderkey as o_orderkey, p_partkey, p_name from lineitem join part on l_partkey = p_partkey")
def array_of_reference_include(spark, sf_dir):
    nested = documents(spark, sf_dir, "basket").include("parts").df()
    return nested.select("o_orderkey", F.explode("parts").alias("p")).select("o_orderkey", "p.p_partkey", "p.p_name")


@_query("select l_orderkey as o_orderkey, l_partkey as part_id, p_name from lineitem left join part on l_partkey = p_partkey")
def embedded_array_reference_include(spark, sf_dir):
    nested = documents(spark, sf_dir, "shelf").include("boxes.items.part").df()
    items = nested.select("o_orderkey", F.explode("boxes").alias("b")).select("o_orderkey", F.explode("b.items").alias("i"))
    return items.select("o_orderkey", "i.part_id", F.col("i.part.p_name").alias("p_name"))


@_query("select c_custkey, o_orderkey, l_partkey as part_id, p_name from customer join orders on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey left join part on l_partkey = p_partkey")
def child_embedded_array_reference(spark, sf_dir):
    nested = documents(spark, sf_dir, "buyer").include(child("baskets").include("items.part")).df()
    items = nested.select("c_custkey", F.explode("baskets").alias("b")).select("c_custkey", "b.o_orderkey", F.explode("b.items").alias("i"))
    return items.select("c_custkey", "o_orderkey", "i.part_id", F.col("i.part.p_name").alias("p_name"))


@_query("select o_orderkey, o_totalprice from orders where o_custkey = 7")
def children_of_one(spark, sf_dir):
    return ParquetStore(spark, sf_dir, MODEL).children("customer", "orders", 7).select("o_orderkey", "o_totalprice")


@_query("select c_custkey, o_orderkey from customer left join (select * from orders where o_orderkey = 77) on o_custkey = c_custkey")
def include_child_by_id(spark, sf_dir):
    nested = documents(spark, sf_dir, "customer").include(child("orders").where(f("o_orderkey") == 77)).df()
    return nested.select("c_custkey", F.explode_outer("orders").alias("o")).select("c_custkey", "o.o_orderkey")


@_query("select c_custkey, o_orderkey from (select o_custkey as c_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice, o_orderkey) as rn from orders) where rn > 4")
def include_skip(spark, sf_dir):
    nested = documents(spark, sf_dir, "customer").include(child("orders").order_by("o_totalprice").skip(4)).df()
    return nested.select("c_custkey", F.explode("orders").alias("o")).select("c_custkey", "o.o_orderkey")


@_query("select n_nationkey as k, c_custkey, o_orderkey, cast(count(l_orderkey) as int) as n from nation join customer on c_nationkey = n_nationkey join orders on o_custkey = c_custkey left join lineitem on l_orderkey = o_orderkey group by all")
def include_three_levels(spark, sf_dir):
    model = Model(
        Collection("nation", "n_nationkey", children=(SubCollection("customers", "customer", "c_nationkey"),)),
        Collection("customer", "c_custkey", children=(SubCollection("orders", "orders", "o_custkey"),)),
        Collection("orders", "o_orderkey", children=(SubCollection("lines", "lineitem", "l_orderkey"),)),
        Collection("lineitem", None),
    )
    nested = query(model, frames(spark, sf_dir), "nation").include(child("customers").include(child("orders").include(child("lines")))).df()
    below = nested.select(F.col("n_nationkey").alias("k"), F.explode("customers").alias("c")).select("k", "c.c_custkey", F.explode("c.orders").alias("o"))
    return below.select("k", "c_custkey", "o.o_orderkey", F.size("o.lines").alias("n"))


@_query("select c_custkey, o_orderkey, cast(rn as int) as rn from (select o_custkey as c_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderstatus desc, o_totalprice, o_orderkey) - 1 as rn from orders)")
def include_children_ordered(spark, sf_dir):
    nested = documents(spark, sf_dir, "customer").include(child("orders").order_by("o_orderstatus", desc=True).then_by("o_totalprice")).df()
    return nested.select("c_custkey", F.posexplode("orders").alias("rn", "o")).select("c_custkey", "o.o_orderkey", "rn")


# arrays, maps and points by kind
def _elements(path: str, *columns: str) -> Callable:
    return lambda spark, sf_dir: documents(spark, sf_dir, "order_lists").select("o_orderkey", path).df().select("o_orderkey", F.explode(path).alias("e")).selectExpr("o_orderkey", *columns)


_L = "from lineitem"
_found["select_int_array"] = _elements("quantities", "e as quantity"), f"select l_orderkey as o_orderkey, cast(l_quantity as int) as quantity {_L}"
_found["select_double_array"] = _elements("discounts", "e as discount"), f"select l_orderkey as o_orderkey, l_discount as discount {_L}"
_found["select_enum_array"] = _elements("flags", "e as flag"), f"select l_orderkey as o_orderkey, l_returnflag as flag {_L}"
_found["select_geo_array"] = _elements("spots", "e.*"), f"select l_orderkey as o_orderkey, l_discount as latitude, l_tax as longitude {_L}"
_found["select_struct_array"] = _elements("lots", "e.*"), f"select l_orderkey as o_orderkey, l_partkey as part_id, l_linenumber as line {_L}"
_doc("array_contains_int", "order_lists", lambda q: q.where(f("quantities").contains(7)).select("o_orderkey"), f"select distinct l_orderkey as o_orderkey {_L} where cast(l_quantity as int) = 7")
_doc("array_contains_any_double", "order_lists", lambda q: q.where(f("discounts").contains_any([0.05, 0.07])).select("o_orderkey"), f"select distinct l_orderkey as o_orderkey {_L} where l_discount in (0.05, 0.07)")
_doc("array_contains_enum", "order_lists", lambda q: q.where(f("flags").contains(2)).select("o_orderkey"), f"select distinct l_orderkey as o_orderkey {_L} where l_returnflag = 'R'")
_doc("select_point", "place", lambda q: q.where(f("spot.latitude") > 2).select("s_suppkey", "spot.latitude", "spot.longitude", inner="address.spot.latitude"), "select s_suppkey, s_acctbal / 1000 as latitude, cast(s_nationkey as double) as longitude, s_acctbal as \"inner\" from supplier where s_acctbal / 1000 > 2")


@_query("select s_suppkey, s_nationkey as beds, 1 as fields from supplier")
def select_map_of_structs(spark, sf_dir):
    rooms = documents(spark, sf_dir, "place").select("s_suppkey", "rooms").df()
    return rooms.select("s_suppkey", F.col("rooms.first.beds").alias("beds"), F.lit(len(rooms.schema["rooms"].dataType.valueType.fields)).alias("fields"))


@_query("select event_id, 'k:' || json_extract_string(props, '$.k') as props from events")
def select_map(spark, sf_dir):
    rows = documents(spark, sf_dir, "event").select("event_id", "props").df()
    return rows.select("event_id", F.array_join(F.transform(F.map_entries("props"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",").alias("props"))


# writes: the state after
@_query("select c_custkey, case when c_acctbal > 0 then c_acctbal end as balance, case when c_custkey % 3 = 0 then 'SET' when c_acctbal > 0 then c_mktsegment end as segment, case when c_acctbal > 0 and c_custkey % 3 > 0 then c_nationkey end as nation from customer")
def update_nested_null(spark, sf_dir):
    base = frames(spark, sf_dir)("thin_profile")
    changes = base.filter("c_custkey % 3 = 0").select("c_custkey", F.lit("SET").alias("account__group__segment"))
    after = W.update(base, changes, "c_custkey", ["account.group.segment"], clear=["account.group.nation"])
    return after.select("c_custkey", "account.balance", "account.group.segment", "account.group.nation")


@_query("select p_partkey, case when p_size = 7 then 'one|two' else array_to_string(string_split(p_name, ' '), '|') end as tags from part")
def update_array_replace(spark, sf_dir):
    base = frames(spark, sf_dir)("part_tagged")
    changes = base.filter("p_size = 7").select("p_partkey", F.array(F.lit("one"), F.lit("two")).alias("tags"))
    return W.update(base, changes, "p_partkey", ["tags"]).select("p_partkey", F.array_join("tags", "|").alias("tags"))


@_query("select o_orderkey, case when o_orderstatus = 'P' then 'F' else o_orderstatus end as o_orderstatus, case when o_orderstatus = 'P' then null else o_orderpriority end as o_orderpriority, o_totalprice from orders")
def update_partial(spark, sf_dir):
    base = frames(spark, sf_dir)("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    changes = base.filter("o_orderstatus = 'P'").select("o_orderkey", F.lit("F").alias("o_orderstatus"))
    return W.update(base, changes, "o_orderkey", ["o_orderstatus"], clear=["o_orderpriority"])


@_query("select c_custkey, c_acctbal as balance, case when c_acctbal < 0 then 'DEBTOR' else c_mktsegment end as segment from customer")
def update_nested_field(spark, sf_dir):
    base = frames(spark, sf_dir)("customer_profile")
    changes = base.filter("account.balance < 0").select("c_custkey", F.lit("DEBTOR").alias("account__segment"))
    return W.update(base, changes, "c_custkey", ["account.segment"]).select("c_custkey", F.col("account.balance").alias("balance"), F.col("account.segment").alias("segment"))


@_query("select p_partkey, array_to_string(list_filter(string_split(p_name, ' '), lambda x: x <> 'blue') || case when list_contains(string_split(p_name, ' '), 'new') then [] else ['new'] end, '|') as tags from part")
def update_array_diff(spark, sf_dir):
    base = frames(spark, sf_dir)("part_tagged")
    return base.select("p_partkey", F.array_join(W.array_changed(F.col("tags"), F.array(F.lit("blue")), F.array(F.lit("new"))), "|").alias("tags"))


@_query("select event_id, 1 as n, 5 as seen, false as has_k, 1 as size from events")
def update_map_diff(spark, sf_dir):
    base = frames(spark, sf_dir)("events_mapped")
    after = W.map_changed(F.col("props"), F.array(F.lit("k")), F.create_map(F.lit("seen"), F.lit(5)))
    return base.select("event_id", F.size(F.map_filter(after, lambda k, _: k == "seen")).alias("n"), F.element_at(after, "seen").alias("seen"), F.map_contains_key(after, "k").alias("has_k"), F.size(after).alias("size"))


@_query("select c_custkey, case when c_nationkey = 3 then null when c_nationkey = 4 then 5 else c_nationkey end as c_nationkey from customer")
def update_reference(spark, sf_dir):
    base = frames(spark, sf_dir)("customer").select("c_custkey", "c_nationkey")
    moved = base.filter("c_nationkey in (3, 4)").select("c_custkey", F.when(F.col("c_nationkey") == 4, F.lit(5)).alias("c_nationkey"))
    return W.set_reference(base, moved, "c_custkey", "c_nationkey")


@_query("select s_suppkey, s_name, false as created from supplier union all select s_suppkey + 1000000, s_name, true from supplier where s_suppkey <= 10")
def insert_documents(spark, sf_dir):
    base = frames(spark, sf_dir)("supplier").select("s_suppkey", "s_name")
    new = base.filter("s_suppkey <= 10").withColumn("s_suppkey", F.col("s_suppkey") + 1000000)
    return W.insert(base, new, "s_suppkey", F.lit("2024-01-01").cast("timestamp")).select("s_suppkey", "s_name", F.col(W.CREATED).isNotNull().alias("created"))


@_query("select 'customer' as collection, count(*) as n, cast(sum(c_custkey) as bigint) as keys from customer where c_nationkey <> 3 union all select 'orders', count(*), cast(sum(o_orderkey) as bigint) from orders where o_custkey not in (select c_custkey from customer where c_nationkey = 3) union all select 'lineitem', count(*), cast(sum(l_orderkey) as bigint) from lineitem where l_orderkey not in (select o_orderkey from orders join customer on o_custkey = c_custkey where c_nationkey = 3)")
def delete_cascade(spark, sf_dir):
    get = frames(spark, sf_dir)
    after = W.delete_cascade(MODEL, get, "customer", get("customer").filter("c_nationkey = 3").select("c_custkey"))
    counts = [after[n].agg(F.count("*").alias("n"), F.sum(key).alias("keys")).select(F.lit(n).alias("collection"), "n", "keys") for n, key in (("customer", "c_custkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey"))]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@_query("select s_suppkey, case when s_suppkey > 1000000 then 'added' when s_nationkey = 2 then 'removed' else 'modified' end as change, case when s_suppkey <= 1000000 and s_nationkey <> 2 then 's_acctbal' end as columns from (select s_suppkey, s_nationkey, s_acctbal from supplier union all select s_suppkey + 1000000, 0, 0 from supplier where s_nationkey = 1) where s_suppkey > 1000000 or s_nationkey = 2 or (s_nationkey <> 2 and s_acctbal < 0)")
def detect_changes(spark, sf_dir):
    before = frames(spark, sf_dir)("supplier")
    after = before.filter("s_nationkey <> 2").withColumn("s_acctbal", F.greatest("s_acctbal", F.lit(0.0)))
    after = after.unionByName(before.filter("s_nationkey = 1").withColumn("s_suppkey", F.col("s_suppkey") + 1000000))
    return W.changes(before, after, "s_suppkey").select("s_suppkey", "change", F.array_join("columns", ",").alias("columns"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: own for name, (own, _) in _found.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _found.items()}
