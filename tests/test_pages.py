import json

from tallyforge.sources.pages import PARSERS, Literal, decode, html_tables, page_state, parse_pages


def test_tables_and_spans():
    t = html_tables('<h3>Novice  Final</h3><table><tr><th>Bib</th><th colspan="2">J</th></tr><tr><td data-w="7">1<br>2</td><td>a &amp; b</td><td></td></tr></table>')[0]
    assert t["heading"] == "Novice Final" and [c["text"] for c in t["rows"][0]] == ["Bib", "J", "J"]
    assert t["rows"][1][0] == {"text": "1 2", "header": False, "attrs": {"data-w": "7"}} and t["rows"][1][1]["text"] == "a & b"


def test_literals():
    assert Literal("{a: 'x\\'y', \"b\": [1, -2.5, true, null,], c: !0,}").value() == {"a": "x'y", "b": [1, -2.5, True, None], "c": False or True}
    assert page_state('window.__S__=(function(a,b){return {x:a,y:[b,{z:a}]}}("q",5));') == {"x": "q", "y": [5, {"z": "q"}]}


def test_bad_pages_become_rows(spark):
    pages = [("p1", "awards_json", "{"), ("p2", "awards_json", None), ("p3", "nothing", "x"), ("p4", "awards_json", json.dumps({"awards": [{"place": 1}]})), ("p5", "sitemap", "<a>"), ("p6", "calendar", "<table>")]
    df = spark.createDataFrame(pages, "page_id string, kind string, body string")
    seen = parse_pages(df)
    assert sorted((r.page_id, r.kind) for r in seen.collect()) == [("p1", "error"), ("p3", "error"), ("p4", "awards_json"), ("p5", "error")]
    assert [r.place for r in decode(seen, "awards_json").collect()] == [1]
    assert parse_pages(df.limit(0)).count() == 0
    assert all(callable(p) for p in PARSERS.values())


def test_registry_miss():
    assert list(PARSERS["registry_lookup"](json.dumps({"outcome": "miss", "requested": 9}))) == [{"outcome": "miss", "wsdc_id": 9, "placements": []}]
