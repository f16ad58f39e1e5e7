"""Publication over JDBC into an embedded database."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from test_warehouse import lines, rows

from skeinworks.plans.database import Database, scope
from skeinworks.plans.warehouse import Warehouse

BOUT = {"match_index": 1, "result": "unknown", "sides": [{"wrestlers": [{"id": "1", "name": "A"}]}], "notes": ["n"]}
TABLES = ["events", "event_commentators", "matches", "match_notes", "match_sides", "match_side_participants"]


@pytest.fixture
def database(spark, tmp_path):
    return Database(spark, f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})


def staging(database):
    return database.spark.read.jdbc(database.url, "SYS.SYSTABLES", properties=database.properties).where("lower(TABLENAME) like 'staging%'").count()


def test_publication(spark, tmp_path, database):
    w = Warehouse(spark, f"{tmp_path}/w", buckets=1)
    w.load("matches", lines(tmp_path / "m.jsonl", *({"id": f"e{i}", "name": f"E{i}", "event_rating": 1.5, "matches": [BOUT]} for i in range(3))))
    assert database.publish(w, TABLES) == {n: {"event_commentators": 0}.get(n, 3) for n in TABLES} and staging(database) == 0
    assert rows(database.table("events"), "id", "event_rating") == [(f"e{i}", 1.5) for i in range(3)]
    database.execute(["ALTER TABLE events ADD COLUMN local_note VARCHAR(20)", "UPDATE events SET local_note = 'kept' WHERE \"id\" = 'e0'"])
    w.published(w.pending()[0])
    w.load("matches", lines(tmp_path / "n.jsonl", {"id": "e1", "name": "changed", "matches": [BOUT | {"notes": ["x", "y"]}, BOUT | {"match_index": 2}]}))
    moved = database.publish_pending(w)
    assert moved["matches"] == 2 and moved["match_notes"] == 3 and moved["events"] == 1 and database.publish_pending(w) == {} and staging(database) == 0
    for name in TABLES:
        assert sorted(map(str, database.table(name).collect())) == sorted(map(str, w.table(name).collect())), name
    told = {r.id: r.LOCAL_NOTE for r in spark.read.jdbc(database.url, "events", properties=database.properties).collect()}
    assert told == {"e0": "kept", "e1": None, "e2": None}  # rows of unchanged records weren't touched
    assert scope("match_notes", "t").count("SELECT") == 2

    # A task that fails, and a swap that fails, leave the targets as they were.
    before = {n: sorted(map(str, database.table(n).collect())) for n in TABLES}
    bad = {"events": w.table("events").withColumn("id", F.when(F.col("id") == "e2", F.repeat(F.lit("z"), 300)).otherwise(F.col("id")))}
    with pytest.raises((PySparkException, Py4JJavaError)):
        database._publish(bad, {}, {})
    database.execute(['ALTER TABLE match_notes DROP COLUMN "note"'])
    with pytest.raises(Py4JJavaError):
        database.publish(w, TABLES)
    assert staging(database) == 0 and all(sorted(map(str, database.table(n).collect())) == before[n] for n in TABLES if n != "match_notes") and database.table("match_notes").count() == len(before["match_notes"])
