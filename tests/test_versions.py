"""Several writers, layers, retention, lookups, schemas and batches of the warehouse, on a source with two tables."""

import threading

import pytest
from pyspark.sql import functions as F
from test_warehouse import lines, rows

from skeinworks.functions.files import Files
from skeinworks.plans import versions
from skeinworks.plans.schemas import TABLES
from skeinworks.plans.versions import Change, Conflict, SchemaChange, Version, evolved
from skeinworks.plans.warehouse import Warehouse
from skeinworks.streaming import incremental


def record(i, name="n", **more):
    return {"id": str(i), "name": name, "name_history": [{"name": f"{name}-{k}"} for k in range(2)], **more}


def names(warehouse):
    return rows(warehouse.table("promotions"), "id", "name"), rows(warehouse.table("promotion_name_history"), "promotion_id", "seq", "name")


def test_put_if_absent_has_one_winner(spark, tmp_path):
    files, won = Files(spark, f"{tmp_path}/f"), []
    files.replace("x", "old")
    threads = [threading.Thread(target=lambda i=i: won.append(i) if files.put_if_absent("one", str(i)) else None) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and files.read("one") == str(won[0]) and files.read("none") is None and set(files.names()) >= {"one", "x"}
    part = files._written("other", "text")
    assert files._renamed(part, "other") and not files._renamed(files._written("other", "again"), "other") and files.read("other") == "text"
    assert not [n for n in files.names() if n.startswith(".other") and "again" not in (files.read(n) or "again")]


def test_writers_at_once_lose_nothing(spark, tmp_path, monkeypatch):
    """Another load is put between reading and putting a version, once where it is laid on top and once where buckets are written anew."""
    for most in (8, 0):
        monkeypatch.setattr(Warehouse, "MOST_LAYERS", most)
        one, two = (Warehouse(spark, f"{tmp_path}/w{most}", buckets=2) for _ in range(2))
        one.load("promotions", lines(tmp_path / "a.jsonl", *(record(i, "first") for i in range(6))))
        own, tries = one._replaced, []

        def slow(change, base, *more, own=own, tries=tries, two=two, most=most):
            out = own(change, base, *more)
            if not tries:
                two.load("promotions", lines(tmp_path / f"b{most}.jsonl", record(1, "second"), record(7, "second")))
            tries.append(base.number)
            return out

        one._replaced = slow
        assert one.load("promotions", lines(tmp_path / f"c{most}.jsonl", record(2, "third"), record(8, "third"))) == 2
        told = {i: "first" for i in "03451"} | {"1": "second", "7": "second", "2": "third", "8": "third"}
        got = names(two)
        assert dict(got[0]) == told and got[1] == sorted((i, k, f"{n}-{k}") for i, n in told.items() for k in range(2))
        assert len(tries) == (1 if most else 2)  # buckets written anew had changed, so that writer worked again
        assert one.versions.newest().number == 3


def test_a_crosswalk_is_made_of_one_version(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/w", buckets=2)
    seen = []

    def work(base):
        seen.append(base.number)
        if len(seen) == 1:
            warehouse.load("promotions", lines(tmp_path / "p.jsonl", record(1)))
        return Change(read={"promotions"}, result=base.number)

    assert warehouse._commit(work).result == 1 and seen == [0, 1]
    stuck = versions.Versions.RETRIES
    with pytest.raises(Conflict):
        warehouse._commit(lambda base: warehouse._commit(lambda b: Change(whole={"promotions": {0: [{"folder": str(b.number), "ids": None, "bytes": 0}]}})) and Change(read={"promotions"}))
    assert warehouse.versions.newest().number == 2 + stuck


def test_an_unfinished_writer_leaves_nothing(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, f"{tmp_path}/w", buckets=2)
    warehouse.load("promotions", lines(tmp_path / "a.jsonl", record(1)))
    before = names(warehouse)
    monkeypatch.setattr(Files, "put_if_absent", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        warehouse.load("promotions", lines(tmp_path / "b.jsonl", record(1, "other"), record(2)))
    monkeypatch.undo()
    held = len(warehouse.files.names("data"))
    assert names(warehouse) == before and warehouse.versions.newest().number == 1
    assert len(warehouse.vacuum(0, now=2e9)) == 3 and len(warehouse.files.names("data")) == held - 3 and names(warehouse) == before


def test_a_load_writes_in_proportion_to_its_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Warehouse, "MOST_LAYERS", 2)
    warehouse, plain = Warehouse(spark, f"{tmp_path}/w", buckets=1), {}
    many = [record(i, f"long name number {i}") for i in range(3000)]
    warehouse.load("promotions", lines(tmp_path / "all.jsonl", *many))
    plain |= {r["id"]: r["name"] for r in many}
    sizes = []
    for k in range(4):
        new = [record(k, f"changed {k}"), record(5000 + k, "new")]
        before = {n: s for n, s in warehouse.files.sizes("data").items()}
        warehouse.load("promotions", lines(tmp_path / f"n{k}.jsonl", *new))
        plain |= {r["id"]: r["name"] for r in new}
        sizes.append(sum(s for n, s in warehouse.files.sizes("data").items() if n not in before))
        assert dict(rows(warehouse.table("promotions"), "id", "name")) == plain
        assert rows(warehouse.table("promotion_name_history"), "promotion_id", "seq", "name") == sorted((i, s, f"{n}-{s}") for i, n in plain.items() for s in range(2))
    depth = [len(x) for x in warehouse._folders()["promotions"].values()]
    assert depth == [1 + 1] and max(sizes[0], sizes[1], sizes[3]) * 4 < sizes[2]  # the third load found the layers grown, and wrote the bucket anew
    warehouse.clear("promotions", spark.createDataFrame([("5000",), ("2",)], "id string"))
    assert not warehouse.table("promotion_name_history").where("promotion_id in ('5000', '2')").count() and warehouse.table("promotions").count() == 3004
    warehouse.load("promotions", lines(tmp_path / "back.jsonl", record(2, "back")))
    assert rows(warehouse.table("promotion_name_history").where("promotion_id = '2'"), "name") == [("back-0",), ("back-1",)]


def test_retention(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/w", buckets=1)
    for k in range(3):
        warehouse.replace({"promotions": spark.createDataFrame([(str(k), "n")], "id string, name string").select("id", "name", *(F.lit(None).cast("string").alias(c) for c in ("profile_url", "location")), *(F.lit(None).cast(t).alias(c) for c, t in (("active_year_start", "int"), ("active_year_end", "int"), ("rating", "double"), ("votes", "int"))))})
    old = warehouse.versions.read(2)
    assert warehouse.vacuum(3600) == [] and rows(warehouse.table("promotions", old), "id") == [("1",)]  # inside the bound
    gone = warehouse.vacuum(0, now=2e9)
    assert sorted(n.partition("/")[0] for n in gone) == ["data", "data", "versions", "versions"] and warehouse.versions.numbers() == [3]
    assert rows(warehouse.table("promotions"), "id") == [("2",)] and warehouse.vacuum(0, now=2e9) == []
    warehouse.files.delete("versions/_newest")  # only a hint
    assert warehouse.versions.newest().number == 3


def test_lookups_open_the_files_of_their_bucket(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/w", buckets=8)
    day = {"birthday": "03.04.1981"}
    warehouse.load("wrestlers", lines(tmp_path / "w.jsonl", *({"id": str(i), "name": f"Person {i}"} | day for i in range(40))))
    warehouse.load("b_wrestlers", lines(tmp_path / "b.jsonl", *({"id": f"p{i}", "name": f"Person {i}", "birthday": "April 3, 1981"} for i in range(40))))
    warehouse.load("titles", lines(tmp_path / "t.jsonl", {"id": "9", "name": "Pier Title", "promotion": "1"}))
    reigns = [{"reign_number": 2, "champions": [{"id": "p7", "name": "Person 7"}]}, {"reign_number": 1, "champions": [{"id": "p8", "name": "Person 8"}]}, {"reign_number": 0, "champions": [{"id": "p7", "name": "Person 7"}]}]
    warehouse.load("b_titles", lines(tmp_path / "bt.jsonl", {"id": "wwe/pier", "name": "Pier Title", "reigns": reigns}, *({"id": f"wwe/x{i}", "name": f"X{i}", "reigns": reigns} for i in range(20))))
    assert warehouse.link() == {"wrestler_crosswalk": 40, "title_crosswalk": 1}
    found = warehouse.person("7")
    assert rows(found, "a_id", "b_id", "name", "match_method") == [("7", "p7", "Person 7", "name_and_birthday")]
    assert len(warehouse.of_record("b_wrestlers", "p7").inputFiles()) == 1 < len(warehouse.table("b_wrestlers").inputFiles())
    got = warehouse.reigns("7", "9")
    assert [(r.seq, r.reign_number) for r in got.collect()] == [(0, 2), (2, 0)] and len(got.inputFiles()) <= 4
    assert warehouse.person("none").count() == warehouse.reigns("7", "none").count() == warehouse.reigns("none", "9").count() == 0


def test_schemas_may_grow_and_widen(spark, tmp_path):
    path = lines(tmp_path / "p.jsonl", record(1, votes=7))
    Warehouse(spark, f"{tmp_path}/w", buckets=1).load("promotions", path)
    wider = TABLES["promotions"].ddl.replace("votes int", "votes long") + ", seen string"
    later = Warehouse(spark, f"{tmp_path}/w", buckets=1, ddls={"promotions": wider})
    assert rows(later.table("promotions"), "id", "votes", "seen") == [("1", 7, None)] and dict(later.table("promotions").dtypes)["votes"] == "bigint"
    later.load("promotions", lines(tmp_path / "q.jsonl", record(2, votes=8)))
    assert rows(later.table("promotions"), "id", "votes") == [("1", 7), ("2", 8)] and len(later.versions.newest().schemas["promotions"]) == 2
    for ddl in (wider.replace("votes", "ballots"), wider.replace("votes long", "votes int"), wider.replace("name string", "name int")):
        with pytest.raises(SchemaChange):
            Warehouse(spark, f"{tmp_path}/w", buckets=1, ddls={"promotions": ddl}).load("promotions", path)
    assert rows(later.table("promotions"), "id", "votes") == [("1", 7), ("2", 8)]
    assert evolved(["a int"], "a long, b string", "t") == ["a int", "a long, b string"] and evolved(["a int"], "a double", "t")[1:] == ["a double"]


def test_a_batch_is_loaded_once_and_published_once(spark, tmp_path):
    warehouse, target = (Warehouse(spark, f"{tmp_path}/{n}", buckets=1) for n in "wt")
    folder = tmp_path / "in"
    folder.mkdir()
    lines(folder / "a.jsonl", record(1, "a"))
    lines(folder / "b.jsonl", record(2, "b"))

    def run():
        incremental.stream_loads(spark, warehouse, "promotions", str(folder), f"{tmp_path}/ck").awaitTermination(120)

    run()
    assert warehouse.versions.newest().number == 1 and rows(warehouse.table("promotions"), "id") == [("1",), ("2",)]  # two files, one load
    killed = f"{tmp_path}/ck/commits/0"  # as if the driver had ended between the load and the stream's own note of it
    Files(spark, f"{tmp_path}/ck/commits").delete("0")
    run()
    assert warehouse.versions.newest().number == 1 and len(warehouse.pending()[0]) == 1, killed
    assert warehouse.publish(target)["promotions"] == 2 and warehouse.publish(target) == {} and names(target) == names(warehouse)
    assert warehouse.load("promotions", str(folder / "a.jsonl"), ("x", 3)) == 1 and warehouse.load("promotions", str(folder / "a.jsonl"), ("x", 2)) == 0
    assert rows(warehouse.pending()[1]["promotions"], "id") == [("1",)]


def test_versions_are_told_whole():
    v = Version(3, {"t": {0: [{"folder": "f", "ids": None, "bytes": 1, "schema": 0}]}}, {"w": 2}, [["s", "f"]], {"t": ["a int"]})
    assert Version.parsed(v.told()) == v
