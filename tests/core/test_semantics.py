import datetime
import enum
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from folio.errors import AmbiguousResult, EmptyResult, ModelError, UnsupportedQuery
from folio.functions.predicates import field, if_set
from folio.model import ArrayOf, Collection, GeoPoint, MapOf, Model, Reference, SubCollection
from folio.operators import writes as W
from folio.operators.query import cast, child, query
from folio.sources.store import ParquetStore

f = field


class Colour(enum.Enum):
    RED = 1
    BLUE = 2


@pytest.fixture(scope="module")
def world(spark):
    tables = {
        "country": spark.createDataFrame([(1, "AR"), (2, "BR")], "id int, name string"),
        "author": spark.createDataFrame([(1, "Ann", 1), (2, "Bob", None)], "id int, name string, country int"),
        "book": spark.createDataFrame(
            [("a", "One", 10.0, 1, "RED", True, ["x", "y"], datetime.datetime(2020, 1, 1), [1, 9, 2], {"k": 1}), ("b", "Two", None, None, "BLUE", False, [], datetime.datetime(2021, 1, 1), [], None), ("c", None, 30.0, 7, None, None, None, None, None, {"z": 2})],
            "id string, title string, price double, author int, colour string, live boolean, tags array<string>, at timestamp_ntz, friends array<int>, extra map<string,int>",
        ),
        "copy": spark.createDataFrame([(1, "a", 5, 1), (2, "a", 3, 2), (3, "a", 3, None), (4, "c", None, 1)], "n int, book string, pages int, owner int"),
        "shelf": spark.createDataFrame([("s", [{"label": "l", "items": [{"author_id": 1}, {"author_id": 9}]}, {"label": "m", "items": None}])], "id string, boxes array<struct<label:string,items:array<struct<author_id:int>>>>"),
    }
    model = Model(
        Collection("country", "id"),
        Collection("author", "id", references=(Reference("home", "country", "country"),)),
        Collection("copy", "n", references=(Reference("owned", "author", "owner"),)),
        Collection("book", "id", references=(Reference("writer", "author", "author"),), children=(SubCollection("copies", "copy", "book"),), arrays=(ArrayOf("friends", "reference", "author"), ArrayOf("tags")), maps=(MapOf("extra"),), enums={"colour": ("", "RED", "BLUE")}, persist_null=frozenset({"title"})),
        Collection("live_book", "id", table="book", default_filter=lambda: f("live") == True),  # noqa: E712
        Collection("shelf", "id", arrays=(ArrayOf("boxes.items", "reference", "author", fk="author_id"),)),
    )
    return lambda name: query(model, lambda t: tables[t], name)


def ids(q):
    return [r.id for r in q.df().orderBy("id").collect()]


def test_filters_and_nulls(world):
    book = world("book")
    assert ids(book.where(f("price") != 10.0)) == ["c"]
    assert ids(book.where(~f("live"))) == ["b"] and ids(book.where(f("live"))) == ["a"]
    assert ids(book.where(~f("live") | (f("price") == 30.0))) == ["b", "c"]
    assert ids(book.where(f("colour") == Colour.RED)) == ["a"] == ids(book.where(f("colour") == 1))
    assert ids(book.where(f("title").is_null())) == ["c"] and ids(book.where(f("title").is_not_null())) == ["a", "b"]
    assert ids(book.where(f("tags").contains("x"))) == ["a"] == ids(book.where(f("tags").contains_any(["q", "y"])))
    assert ids(book.where(f("at") >= datetime.datetime(2021, 1, 1, tzinfo=datetime.UTC))) == ["b"]
    assert ids(book.where(f("title").starts_with("T"), if_set(None, lambda v: f("price") == v))) == ["b"]
    assert ids(book.where(5 < f("price"))) == ["a", "c"]
    assert ids(book.where(f("writer.id") == 1)) == ["a"]
    assert ids(book.where(f("price").not_in([10.0]))) == ["c"] and ids(book.where(f("price").is_in([]))) == []
    assert ids(book.where(f("extra.k") == 1)) == ["a"]
    assert ids(world("live_book")) == ["a"] and ids(world("live_book").ignore_filters()) == ["a", "b", "c"]
    key = uuid.UUID(int=1)
    assert ids(book.where((f("id") == key) | (f("price") == 10.0))) == ["a"]


@pytest.mark.parametrize(
    "build",
    [
        lambda q: q.where(f("price").is_null()),
        lambda q: q.where(~f("tags").contains("x")),
        lambda q: q.where(~f("tags").contains_any(["x"])),
        lambda q: q.where(f("tags").contains_any([])),
        lambda q: q.where(f("title").ends_with("e")),
        lambda q: q.where(f("title").like("e")),
        lambda q: q.where(f("writer.name") == "Ann"),
        lambda q: q.where(f("id").is_in(["a"])),
        lambda q: q.where((f("id") == "a") & (f("id") == "b")),
        lambda q: q.where((f("id") == "a") | (f("id") == "b")),
        lambda q: q.where(f("title") < None),
        lambda q: q.where(f("nothing") == 1),
        lambda q: q.select(F.col("price") + 1),
        lambda q: q.select(twice=lambda r: r),
        lambda q: q.select(k=child("copies").skip(1)),
        lambda q: q.select(k=child("nothing")),
        lambda q: q.include("nothing"),
        lambda q: q.then_by("price"),
        lambda q: q.take_last(1),
        lambda q: q.distinct(),
        lambda q: q.group_by("price"),
        lambda q: q.join(q),
        lambda q: q.union(q),
        lambda q: q.element_at(1),
        lambda q: q.select(k=child("copies").distinct()),
        lambda q: q.order_by("price").start_after(1.0),
        lambda q: q.sum(F.col("price")),
    ],
)
def test_rejected(world, build):
    with pytest.raises(UnsupportedQuery):
        build(world("book")).df()


def test_relaxed(world):
    assert ids(world("book").relaxed().where(f("writer.name") == "Ann")) == ["a"]
    assert ids(world("book").relaxed().where(f("price").is_null())) == ["b"]
    assert ids(world("book").relaxed().where(~f("tags").contains("x"))) == ["b"]


def test_order_and_limits(world):
    copies = world("copy")
    def ns(q):
        return [r.n for r in q.collect()]
    assert ns(copies.order_by("pages")) == [2, 3, 1]  # rows without the field are left out
    assert ns(copies.order_by("pages", desc=True).take(2)) == [1, 2]
    assert ns(copies.order_by("pages").skip(1).take(1)) == [3]
    assert ns(copies.order_by("pages").take_last(2)) == [3, 1]
    assert ns(copies.order_by("pages").start_after(3, 2)) == [3, 1]
    assert ns(copies.order_by("pages").then_by("n", desc=True)) == [3, 2, 1]
    assert ns(copies.order_by("n").take(3).skip(1)) == [2, 3]
    assert copies.find(9).one() is None and copies.find(2).one().n == 2
    assert copies.first(f("pages") == 3).one().n in (2, 3)
    with pytest.raises(EmptyResult):
        copies.first(f("pages") == 99).one()
    assert copies.first(f("pages") == 99, default=True).one() is None
    with pytest.raises(AmbiguousResult):
        copies.single(f("pages") == 3).one()


def test_scalars(world):
    copies = world("copy")
    none = copies.where(f("pages") > 99)
    assert copies.count().scalar() == 4 and copies.any().scalar() and not none.any().scalar()
    assert none.count().scalar() == 0 and none.sum("pages").scalar() == 0
    for q in (none.avg("pages"), none.min("pages"), none.max("pages")):
        with pytest.raises(EmptyResult):
            q.scalar()
        assert q.scalar(nullable=True) is None
    assert copies.order_by("pages", desc=True).take(1).min("pages").scalar() == 5
    assert copies.order_by("n").take(2).sum("pages").scalar() == 8


def test_projections(world):
    book = world("book")
    assert sorted(r.title for r in book.select("title").collect()) == ["One", "Two"]  # a single field drops nulls
    rows = {r.id: r for r in book.select("id", "writer", who="writer.name", land="writer.home.name", kids=child("copies").order_by("pages", desc=True).take(2).select("n"), n=child("copies").count(), pages=child("copies").sum("pages"), mean=child("copies").where(f("pages") > 99).avg("pages"), most=child("copies").max("pages"), some=child("copies").any()).collect()}
    assert rows["a"].who == "Ann" and rows["a"].land == "AR" and rows["a"].writer.name == "Ann"
    assert rows["b"].writer is None and rows["c"].writer is None and rows["c"].who is None  # null and dangling
    assert rows["a"].kids == [1, 2] and rows["b"].kids == [] and rows["c"].kids == []
    assert [rows[i].n for i in "abc"] == [3, 0, 1] and [rows[i].pages for i in "abc"] == [11, 0, 0]
    assert [rows[i].mean for i in "abc"] == [0.0, 0.0, 0.0] and rows["b"].most is None and [rows[i].some for i in "abc"] == [True, False, True]
    named = {r.id: r.kids for r in book.select("id", kids=child("copies").order_by("n").select("n", by="owned.name")).collect()}
    assert [(k.n, k.by) for k in named["a"]] == [(1, "Ann"), (2, "Bob"), (3, None)]
    inside = {r.id: r.sums for r in book.select("id", sums={"n": child("copies").count(), "deep": {"t": "title"}}).collect()}
    assert inside["a"].n == 3 and inside["a"].deep.t == "One"
    assert [r.id for r in book.order_by("price", desc=True).select("id", who="writer.name").collect()] == ["c", "a"]


def test_includes(world):
    rows = {r.id: r for r in world("book").include("writer", child("copies").where(f("pages") > 2).order_by("pages").skip(1).include("owned"), "friends").collect()}
    assert rows["a"].writer.name == "Ann" and rows["b"].writer is None
    assert [(c.n, c.owned and c.owned.name) for c in rows["a"].copies] == [(3, None), (1, "Ann")]
    assert rows["b"].copies == []
    assert [x.name for x in rows["a"].friends] == ["Ann", "Bob"] and rows["b"].friends == []  # dangling ones drop, order stays
    (shelf,) = world("shelf").include("boxes.items.author").collect()
    assert [i.author and i.author.name for i in shelf.boxes[0]["items"]] == ["Ann", None] and shelf.boxes[1].label == "m"


def test_describe(world):
    said = world("book").where((f("price") > 1) & ~f("live")).order_by("price", desc=True).take(3).include("writer").describe()
    assert said == "book | where (price > 1 and not live) | order by price desc | take 3 | include writer"


def test_cast_and_log(world):
    assert {r.id: r.p for r in world("book").select("id", p=cast("price", "string")).collect()}["a"] == "10.0"
    q = world("book").where(f("live"))
    assert q.log("none") == "" and q.log("count").endswith("| 1 rows") and q.log("ids").endswith("id: ['a']") and "Physical Plan" in q.log()


def test_model_checks():
    for bad in (
        lambda: Model(Collection("a", "x,y")),
        lambda: Model(Collection("a", "x"), Collection("a", "x")),
        lambda: Model(Collection("a", "x", references=(Reference("r", "b", "f"),))),
        lambda: Model(Collection("a", "x", children=(SubCollection("r", "b", "f"),))),
        lambda: Model(Collection("a", "x", children=(SubCollection("r", "b", "f"),)), Collection("b", "x", children=(SubCollection("r", "a", "f"),))),
        lambda: Model(Collection("a", "x", arrays=(ArrayOf("p", "odd"),))),
        lambda: Model(Collection("a", "x", arrays=(ArrayOf("p", "reference", "b"),))),
        lambda: Model(Collection("a", "x"))["b"],
    ):
        with pytest.raises(ModelError):
            bad()


def test_writes(spark):
    base = spark.createDataFrame([(1, ("a", 1), ["x", "y"], {"p": 1, "q": 2}, 5), (2, ("b", 2), ["z"], {"p": 1}, 6)], "id int, s struct<n:string,v:int>, tags array<string>, m map<string,int>, ref int")
    changes = spark.createDataFrame([(1, "new", None), (9, "no", 3)], "id int, s__n string, ref int")
    got = {r.id: r for r in W.update(base, changes, "id", ["s.n", "ref"], clear=["s.v"]).collect()}
    assert got[1].s == ("new", None) and got[1].ref is None and got[2].s == ("b", 2) and got[2].ref == 6 and len(got) == 2
    diff = base.select("id", W.array_changed(F.col("tags"), F.array(F.lit("z")), F.array()).alias("t"), W.array_changed(F.col("tags"), F.array(F.lit("x")), F.array(F.lit("y"), F.lit("w"))).alias("u"), W.map_changed(F.col("m"), F.array(F.lit("p")), F.create_map(F.lit("q"), F.lit(9))).alias("m"))
    rows = {r.id: r for r in diff.collect()}
    assert rows[1].t == ["x", "y"] and rows[2].t is None and rows[1].u == ["y", "w"] and rows[1].m == {"q": 9}
    added = W.insert(spark.createDataFrame([("k", [1])], "id string, xs array<int>"), spark.createDataFrame([(None, [1, None]), ("own", [])], "id string, xs array<int>"), "id", F.current_timestamp()).collect()
    made = next(r for r in added if r.id not in ("k", "own"))
    assert len(made.id) == 20 and made.xs == [1] and made[W.CREATED] is not None and next(r for r in added if r.id == "k")[W.CREATED] is None
    after = base.filter("id = 1").withColumn("ref", F.lit(7)).unionByName(base.filter("id = 1").withColumn("id", F.lit(3)))
    assert {(r.id, r.change, tuple(r.columns or ())) for r in W.changes(base, after, "id").collect()} == {(1, "modified", ("ref",)), (2, "removed", ()), (3, "added", ())}
    model = Model(Collection("p", "id", children=(SubCollection("c", "c", "p"),)), Collection("c", "id", children=(SubCollection("g", "g", "c"),)), Collection("g", None))
    assert W.write_order(model) == ["p", "c", "g"]
    tables = {"p": spark.createDataFrame([(1,), (2,)], "id int"), "c": spark.createDataFrame([(10, 1), (20, 2)], "id int, p int"), "g": spark.createDataFrame([(10,), (20,), (None,)], "c int")}
    left = W.delete_cascade(model, tables.__getitem__, "p", spark.createDataFrame([(1,)], "id int"))
    assert [r.id for r in left["p"].collect()] == [2] and [r.id for r in left["c"].collect()] == [20] and left["g"].count() == 2


def test_store_and_stream(spark, tmp_path):
    from folio.streaming.changes import apply_updates

    spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string").write.parquet(f"{tmp_path}/t.parquet")
    spark.createDataFrame([(7, 1)], "n int, t int").write.parquet(f"{tmp_path}/u.parquet")
    store = ParquetStore(spark, str(tmp_path), Model(Collection("t", "id", children=(SubCollection("us", "u", "t"),)), Collection("u", "n")))
    assert store.can_connect() and store.get("t", 2).name == "b" and store.get("t", 5) is None
    assert store.exists("t", 1) and not store.exists("t", 3) and store.children("t", "us", 1).count() == 1
    spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "id int, name string, v int").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id int, name string, v int").parquet(f"{tmp_path}/in")
    apply_updates(store, "t", stream, ["name"], "v").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    assert {(r.id, r.name) for r in store.frame("t").collect()} == {(1, "new"), (2, "b")}


def test_plans(spark):
    from folio.tables import documents

    def plan(q):
        return q.df()._jdf.queryExecution().executedPlan().toString()
    top = plan(documents(spark, "/root/testdata/sf0.001", "orders").where(f("o_orderstatus") == "F").order_by("o_totalprice").take(5).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), " in top and "TakeOrderedAndProject" in top and "o_orderpriority" not in top.split("ReadSchema")[1]
    kids = plan(documents(spark, "/root/testdata/sf0.001", "customer").select("c_custkey", k=child("orders").order_by("o_totalprice").take(2).select("o_orderkey")))
    assert "WindowGroupLimit" in kids
    assert "Join" not in plan(documents(spark, "/root/testdata/sf0.001", "customer").where(f("nation.n_nationkey") == 3))


def test_nested_updates_and_repeated_changes(spark):
    base = spark.createDataFrame([(1, None), (2, ("b", ("u", 2)))], "id int, s struct<n:string,in:struct<p:string,q:int>>")
    changes = spark.createDataFrame([(1, "new"), (2, "two"), (None, "none")], "id int, s__in__p string")
    got = {r.id: r.s for r in W.update(base, changes, "id", ["s.in.p"]).collect()}
    assert got[1] == (None, ("new", None)) and got[2] == ("b", ("two", 2))
    cleared = {r.id: r.s for r in W.update(base, changes, "id", [], clear=["s.in.q"]).collect()}
    assert cleared[1] is None and cleared[2] == ("b", ("u", None))
    with pytest.raises(Exception, match="two changes of the key"):
        W.update(base, changes.union(changes), "id", ["s.in.p"]).collect()
    with pytest.raises(ModelError):
        W.update(base, changes.withColumnRenamed("s__in__p", "s__x"), "id", ["s.x"])


def test_commit_is_all_or_nothing(spark, tmp_path):
    said = []
    for name in ("t", "u"):
        spark.createDataFrame([(1, name)], "id int, name string").write.parquet(f"{tmp_path}/{name}.parquet")
    store = ParquetStore(spark, str(tmp_path), Model(Collection("t", "id"), Collection("u", "id")), said.append)
    new = spark.createDataFrame([(2, "new")], "id int, name string")
    store.commit({"t": new, "u": new})
    assert [(r.id, r.name) for n in ("t", "u") for r in store.frame(n).collect()] == [(2, "new")] * 2
    bad = new.withColumn("name", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception, match="broken"):
        store.commit({"t": new.withColumn("id", F.lit(3)), "u": bad})
    assert [r.id for n in ("t", "u") for r in store.frame(n).collect()] == [2, 2]
    assert said == ["commit t, u", "rollback t, u"]
    import os
    assert sorted(n for n in os.listdir(tmp_path) if not n.endswith(".crc")) == ["t.parquet", "u.parquet"]


def test_failed_swap_puts_the_old_state_back(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "old")], "id int, name string").write.parquet(f"{tmp_path}/t.parquet")
    store = ParquetStore(spark, str(tmp_path), Model(Collection("t", "id")))

    class Broken:
        """A file system whose second rename fails."""

        def __init__(self, own):
            self.own, self.turn = own, 0

        def rename(self, a, b):
            self.turn += 1
            return False if self.turn == 2 else self.own.rename(a, b)

        def __getattr__(self, name):
            return getattr(self.own, name)

    monkeypatch.setattr(store, "file_system", lambda f=store.file_system: Broken(f()))
    with pytest.raises(OSError, match="could not be renamed"):
        store.replace("t", spark.createDataFrame([(2, "new")], "id int, name string"))
    assert [r.name for r in store.frame("t").collect()] == ["old"]


def test_late_updates_of_a_stream(spark, tmp_path):
    from folio.streaming.changes import apply_updates

    spark.createDataFrame([(1, "a", 5), (2, "b", 1)], "id int, name string, v int").write.parquet(f"{tmp_path}/t.parquet")
    store = ParquetStore(spark, str(tmp_path), Model(Collection("t", "id")))
    spark.createDataFrame([(1, "late", 4), (2, "new", 2), (9, "unknown", 1)], "id int, name string, v int").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id int, name string, v int").parquet(f"{tmp_path}/in")
    for run in ("x", "y"):  # the second run sees the same updates again
        apply_updates(store, "t", stream, ["name"], "v").option("checkpointLocation", f"{tmp_path}/{run}").trigger(availableNow=True).start().awaitTermination()
        assert {(r.id, r.name, r.v) for r in store.frame("t").collect()} == {(1, "a", 5), (2, "new", 2)}


def test_streams_rewrite_the_folders_they_touch(spark, tmp_path):
    import os

    from folio.streaming.changes import apply_updates

    spark.range(200).selectExpr("id", "'old' as name", "1 as v").write.parquet(f"{tmp_path}/t.parquet")
    said = []
    store = ParquetStore(spark, str(tmp_path), Model(Collection("t", "id")), said.append)
    assert store.parts_of("t", spark.range(3)) is None
    store.partition("t", 8)
    assert store.frame("t").columns == ["id", "name", "v"] and store.frame("t").count() == 200 and store.get("t", 7).name == "old"

    def files():
        return {d: sorted(os.listdir(f"{tmp_path}/t.parquet/{d}")) for d in os.listdir(f"{tmp_path}/t.parquet") if "=" in d}
    before = files()
    assert len(before) == 8
    # the stream's key has another type than the stored one
    spark.createDataFrame([(3, "new", 2), (4, "late", 0), (3, "first", 1), (999, "unknown", 5), (None, "none", 5)], "id int, name string, v int").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id int, name string, v int").parquet(f"{tmp_path}/in")
    touched = store.parts_of("t", spark.createDataFrame([(3,), (4,), (999,)], "id int"))
    assert 0 < len(touched) < 8
    for run in ("x", "y"):
        apply_updates(store, "t", stream, ["name"], "v").option("checkpointLocation", f"{tmp_path}/{run}").trigger(availableNow=True).start().awaitTermination()
        rows = {r.id: (r.name, r.v) for r in store.frame("t").collect()}
        assert len(rows) == 200 and rows.pop(3) == ("new", 2) and set(rows.values()) == {("old", 1)}
        assert {int(d.split("=")[1]) for d, x in files().items() if x != before[d]} == set(touched)
    assert said == ["commit t", "commit t"]  # the second run changed nothing
    scan = store.frame("t", touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "__part_of_8" in scan.split("PartitionFilters")[1].split("]")[0]

    store.append("t", spark.createDataFrame([(500, "added", 1)], "id long, name string, v int"))
    assert store.get("t", 500).name == "added" and len(files()) == 8
    # a change that leaves a folder without rows, and one that fails
    with pytest.raises(Exception, match="broken"):
        store.replace("t", store.frame("t", touched).withColumn("name", F.raise_error(F.lit("broken")).cast("string")), touched)
    assert store.frame("t").count() == 201
    store.replace("t", store.frame("t", touched).filter("id < 0"), touched)
    assert len(files()) == 8 - len(touched) and not {3, 4} & {r.id for r in store.frame("t").collect()}
    assert all(not n.startswith(".t") or n.endswith(".crc") for n in os.listdir(tmp_path))
    store.replace("t", store.frame("t").limit(0))
    assert store.frame("t").columns == ["id", "name", "v"] and store.frame("t").isEmpty()


def test_shapes(spark):
    df = spark.createDataFrame([(1, 1.5, 2, [((3.0, 4.0), "s")], {"k": ("v", "s")}), (2, None, 2, None, None)], "id int, lat double, lon int, spots array<struct<at:struct<latitude:double,longitude:double>,secret:string>>, m map<string,struct<a:string,secret:string>>")
    model = Model(Collection("c", "id", arrays=(ArrayOf("spots", "embedded", ignore=("secret",)),), maps=(MapOf("m", ignore=("secret",)),), points=(GeoPoint("spot", "lat", "lon"), GeoPoint("spots.at"))))
    rows = {r.id: r for r in query(model, lambda _: df, "c").collect()}
    assert rows[1].spot == (1.5, 2.0) and rows[2].spot is None
    assert rows[1].spots == [((3.0, 4.0),)] and rows[1].m == {"k": ("v",)} and rows[2].spots is None and rows[2].m is None
    with pytest.raises(ModelError):
        query(Model(Collection("c", "id", points=(GeoPoint("spot", "x", "y"),))), lambda _: df, "c").df()


def test_rows_retries_and_negations(world):
    book = world("book")
    assert sorted(r.id for r in book.rows()) == ["a", "b", "c"]
    assert len(book.collect(attempts=2)) == 3
    turns = []
    def failing():
        turns.append(1)
        raise PySparkException("gone")
    broken = book.where(f("price") > 0)
    object.__setattr__(broken, "df", failing)
    with pytest.raises(PySparkException):
        broken.collect(attempts=3, wait=0.0)
    assert len(turns) == 3
    with pytest.raises(UnsupportedQuery):
        book.where(~((f("price") > 1) & f("tags").contains("x"))).df()
    for name in ("contains", "default_if_empty"):
        with pytest.raises(UnsupportedQuery):
            getattr(book, name)()


def test_children_without_a_window(spark):
    from folio.tables import documents

    def plan(q):
        return q.df()._jdf.queryExecution().executedPlan().toString()
    q = documents(spark, "/root/testdata/sf0.001", "customer")
    assert "Window" not in plan(q.include(child("orders"))) and "Window" not in plan(q.include(child("orders").order_by("o_totalprice", desc=True).include(child("lines"))))
    assert "Limit" in plan(documents(spark, "/root/testdata/sf0.001", "orders").any())
