"""Steps whose work must grow with the rows and be dealt to all tasks, however small the rows' file is."""

import random
import tracemalloc
from pathlib import Path

import pyarrow as pa
import pytest

from skeinworks.functions import dom
from skeinworks.plans import queries as plans
from skeinworks.sources import pages

DATA = Path("/root/testdata/sf0.001")


def shape(node):
    return node.tag, node.attrs, [c if isinstance(c, str) else shape(c) for c in node.children]


def tolerant(html):
    builder = dom._Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def test_plain_markup_gives_the_tolerant_tree():
    draw = random.Random(5)
    bits = ["<div>", "</div>", "<p>", "<li>", "<ul>", "</ul>", "<td>", "<tr>", "<table class=T>", "</table>", "text ", "&amp;", "&lt", "a < b", "<br/>", '<a href="x&amp;y">', "</a>", "<a href=/x/>", "<img alt='1>2'>", "<!-- c -->", "<!-->", "<!doctype html>", "<script>a<b</script>", "<script>", "<x/>", '<a b"c>', "</ p>", "<?p?>", "<b x=1 X=2>", "</SCRIPT>"]
    plain = 0
    for _ in range(3000):
        html = "".join(draw.choices(draw.sample(bits, 8), k=draw.randint(1, 15)))
        assert shape(dom.tree(html)) == shape(tolerant(html)), html
        plain += dom._plain(html) is not None
    assert 300 < plain < 3000


def test_short_documents_give_the_tree_of_long_ones(monkeypatch):
    draw = random.Random(6)
    bits = ["<div>", "</div>", "<li>", "</ul>", "<td>", "text ", "&amp;", "&amp;lt;", "&lt", "a < b", "<br/>", '<a href="x&amp;y&amp;">', '<a HREF="x&lt;y">', '<p class="a  b">', "</a>", "<img alt='1<2'>", "<!-- c -->", "<script>a<b</script>", ">", "<"]
    found = ["".join(draw.choices(draw.sample(bits, 8), k=draw.randint(1, 15))) for _ in range(2000)]
    short = [shape(dom.tree(html)) for html in found]
    assert sum(dom._short(html) is not None for html in found) > 200
    monkeypatch.setattr(dom, "SHORT", 0)
    assert short == [shape(dom.tree(html)) for html in found] == [shape(tolerant(html)) for html in found]


def test_selection_by_index():
    t = dom.tree("<ul class=a>" + "<li class='x y'><p class=x>1</p><b>2</b></li>" * 20 + "<li><i class=z>3</i></ul>")
    assert len(t.select("li.x p.x")) == len(t.select("ul > .x")) == 20 and len(t.select(".x")) == 40 and t.select(".a > .z") == t.select("i.z b") == []
    item = t.select("li")[7]
    assert [n.tag for n in item.select(".x")] == ["li", "p"] and item.text(".x") == "12" and [n.tag for n in item.select(".a b")] == ["b"] and item.first("i") is None
    assert t.first(".a i.z").joined() == "3" and [n.tag for n in t.select("[class]")][:3] == ["ul", "li", "p"]


@pytest.mark.skipif(not DATA.exists(), reason="no driver tables here")
@pytest.mark.parametrize("name", ["b_person_pages", "person_profiles", "selected_text", "b_title_wins", "boxes", "addresses", "failed_pages", "card_results", "card_sides", "card_info", "card_positional_ids", "reign_champions", "b_title_pages", "to_visit"])
def test_pages_of_a_small_file_are_dealt(spark, name):
    assert plans.queries()[name](spark, str(DATA)).rdd.getNumPartitions() >= 4


def test_a_worker_holds_one_long_page_at_a_time():
    said = pages.Extractor("said", "said string", lambda page, url: [{"said": page.joined()}] if url != "u7" else [{"said": ""}, {"n": int("x")}])
    batch = pa.record_batch({"url": [f"u{k}" for k in range(100)], "html": [str(k % 10) * 300_000 for k in range(100)]})
    rows, most = [], 0
    tracemalloc.start()
    for out in pages._parsed(said)(iter([batch])):
        most = max(most, out.nbytes)
        rows += [(r["url"], r["seq"], r["record"] and r["record"][10:12], (r["error"] or "")[:10]) for r in out.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == [(f"u{k}", 0, str(k % 10) * 2, "") if k != 7 else ("u7", None, None, "ValueError") for k in range(100)]
    assert most < 6_000_000 and peak < 20_000_000 < batch.nbytes


@pytest.mark.skipif(not DATA.exists(), reason="no driver tables here")
def test_listed_pages_are_parsed_once(spark):
    plan = plans.queries()["to_visit"](spark, str(DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_parts_are_found_in_one_walk():
    t = dom.tree("<div class=a><p class=b>0</p><div class='b c'>1</div><div class=b>2</div></div><div class=d>3</div>")
    inside = t.first("div.a").firsts("div", frozenset("abcd"))
    assert {c: n.joined() for c, n in inside.items()} == {"a": "012", "b": "1", "c": "1"}
