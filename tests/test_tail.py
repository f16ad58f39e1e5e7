"""Growing files: what is read after appends, half lines, shrinking and rewriting; loads and streams of tails."""

import json

import pytest
from test_warehouse import lines, rows

from skeinworks.plans.warehouse import Warehouse
from skeinworks.sources import tail
from skeinworks.streaming import incremental


def read(path, start=None, **more):
    """Lines since an offset with the offset that they lead to, and the bytes of the ranges."""
    g = tail.Growing(str(path), **more)
    end = g.latest()
    parts = g.parts(start or tail.NOTHING, end)
    found = [v for p in parts for b in g.lines(p) for v in b.column(0).to_pylist()]
    return found, end, sum(p.b - p.a for p in parts)


def test_an_append_of_n_bytes_reads_n_bytes(tmp_path):
    f = tmp_path / "a.jsonl"
    f.write_text("".join(f"line {i}\n" for i in range(20_000)))
    first, at, n = read(f)
    assert len(first) == 20_000 and n == f.stat().st_size and read(f, at) == ([], at, 0)
    more = "näw\r\nlast"
    f.write_bytes(f.read_bytes() + more.encode())
    found, later, n = read(f, at)
    assert found == ["näw"] and n == len("näw\r\n".encode())  # a line that isn't whole waits
    f.write_bytes(f.read_bytes() + b" one\n")
    assert read(f, later)[0] == ["last one"]


def test_a_file_that_is_another_one_is_read_again(tmp_path):
    f = tmp_path / "a.jsonl"
    f.write_text("".join(f"line {i}\n" for i in range(5000)))
    _, at, _ = read(f)
    middle = f.read_text().replace("line 2500\n", "LINE 2500\n")
    for text, restart in (("short\n", True), (f.read_text().replace("line 0\n", "LINE 0\n"), True), (f.read_text()[:-5] + "4999\n" + "more\n", False), (f.read_text().replace("4999\n", "4998\n") + "more\n", True), (middle + "more\n", False)):
        f.write_text(text)
        assert len(read(f, at)[0]) == (len(text.splitlines()) if restart else 1)
    f.write_text(middle.replace("LINE", "line"))
    _, at, _ = read(f, check="whole")
    f.write_text(middle)
    assert len(read(f, at, check="whole")[0]) == 5000
    f.write_text("")
    assert read(f, at)[0] == [] and read(tmp_path / "none")[0] == []


@pytest.mark.parametrize("split", [1, 7, 8, 64, 10_000])
def test_ranges_meet_at_lines(tmp_path, split):
    (tmp_path / "in").mkdir()
    want = []
    for name in "ab":
        held = [f"{name}{'x' * (i % 23)}" for i in range(200)] + ["", "é" * 9]
        (tmp_path / "in" / name).write_text("".join(f"{x}\n" for x in held) + "half")
        want += held
    (tmp_path / "in" / "_part").write_text("no\n")
    assert read(tmp_path / "in", split=split)[0] == want


def test_tails_are_loaded_once(spark, tmp_path):
    w = Warehouse(spark, f"{tmp_path}/w", buckets=1)
    path = tmp_path / "p.jsonl"

    def add(*records, half=""):
        with path.open("a") as f:
            f.write("".join(json.dumps(r) + "\n" for r in records) + half)

    add({"id": "1", "name": "old"}, {"id": "1", "name": "new"}, {"id": "2", "name": "b"}, half='{"id": "3", ')
    assert w.load_tail("promotions", str(path)) == 2 and w.load_tail("promotions", str(path)) == 0
    with path.open("a") as f:
        f.write('"name": "c"}\n')
    add({"id": "2", "name": "later"})
    start = w.versions.newest().offsets
    assert w.load_tail("promotions", str(path)) == 2
    assert rows(w.table("promotions"), "id", "name") == [("1", "new"), ("2", "later"), ("3", "c")]
    (writer, was), now = next(iter(start.items())), w.versions.newest().offsets
    again, end = tail.tail(spark, str(path), was)
    assert again.count() == 2 and now[writer] == end and w.load_lines("promotions", again, offset=(writer, was, end)) == 0  # another driver had the same part
    path.write_text('{"id": "2", "name": "rewritten"}\n')
    assert incremental.nightly_tails(w, {"promotions": str(path), "titles": f"{tmp_path}/none"}) == {"promotions": 1} and incremental.nightly_tails(w, {"promotions": str(path)}) == {}
    assert rows(w.table("promotions"), "id", "name")[1] == ("2", "rewritten")


def test_a_stream_reads_appended_lines_once(spark, tmp_path):
    w, folder = Warehouse(spark, f"{tmp_path}/w", buckets=1), tmp_path / "in"
    folder.mkdir()
    lines(folder / "a.jsonl", {"id": "1", "name": "a"})
    for k, more in enumerate((None, {"id": "2", "name": "b"})):
        if more:
            with (folder / "a.jsonl").open("a") as f:
                f.write(json.dumps(more) + "\n")
        q = incremental.stream_tail(spark, w, "promotions", str(folder), f"{tmp_path}/ck")
        q.awaitTermination(120)
        assert q.exception() is None and w.versions.newest().number == k + 1
    assert rows(w.table("promotions"), "id") == [("1",), ("2",)]
    assert sorted(r.id for r in w.pending()[1]["promotions"].collect()) == ["1", "2"]
