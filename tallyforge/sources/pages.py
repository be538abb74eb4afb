"""Captured pages as tables: every page kind has a parser that turns a body into typed records.

A parser is a plain function from a body to an iterable of records; `parse_pages` runs the one registered for a page's kind
over Arrow batches and gives one observation per record, whose payload `decode` reads back with the kind's schema. A body a
parser cannot read gives one observation of kind `error`, so that no page is lost silently.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARSERS: dict[str, Callable[[str], Iterable[dict]]] = {}
SCHEMAS: dict[str, str] = {}


def page_kind(name: str, schema: str):
    """Register a parser under a page kind, with the schema of its records."""
    def add(f):
        PARSERS[name], SCHEMAS[name] = f, schema
        return f

    return add


class _Tables(HTMLParser):
    """Tables of a page: the heading before each, and rows of cells with their text and data attributes."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[dict] = []
        self.heading, self.into = "", None

    def handle_starttag(self, tag, attrs):
        if tag in ("h1", "h2", "h3", "h4", "caption"):
            self.heading, self.into = "", "heading"
        elif tag == "table":
            self.tables.append({"heading": " ".join(self.heading.split()), "rows": []})
        elif tag == "tr" and self.tables:
            self.tables[-1]["rows"].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1]["rows"]:
            kept = {k: v or "" for k, v in attrs if k.startswith("data-") or k in ("class", "colspan")}
            self.tables[-1]["rows"][-1].append({"text": "", "header": tag == "th", "attrs": kept})
            self.into = "cell"
        elif tag == "br" and self.into == "cell":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag in ("td", "th", "h1", "h2", "h3", "h4", "caption"):
            self.into = None

    def handle_data(self, data):
        if self.into == "heading":
            self.heading += data
        elif self.into == "cell":
            self.tables[-1]["rows"][-1][-1]["text"] += data


def html_tables(body: str) -> list[dict]:
    """Every table of an HTML page. Header cells that span columns are repeated, as each column has its own meaning."""
    reader = _Tables()
    reader.feed(body)
    for t in reader.tables:
        for row in t["rows"]:
            wide = []
            for cell in row:
                cell["text"] = " ".join(cell["text"].split())
                span = cell["attrs"].pop("colspan", "1")
                wide += [cell] * max(1, int(span) if span.isdigit() else 1)
            row[:] = wide
    return reader.tables


def _rows(body: str) -> Iterable[tuple[str, dict[str, dict], int]]:
    """(heading, cells by header, row number) of a page's table rows below a header row."""
    for t in html_tables(body):
        headers: list[str] = []
        for n, row in enumerate(t["rows"]):
            if row and all(c["header"] for c in row):
                seen: dict[str, int] = {}
                headers = []
                for c in row:
                    seen[c["text"]] = seen.get(c["text"], 0) + 1
                    headers.append(c["text"] if seen[c["text"]] == 1 else f"{c['text']} {seen[c['text']]}")
            elif row:
                yield t["heading"], dict(zip(headers, row)), n


@page_kind("round_sheet", "contest_name_raw string, round_name_raw string, row int, cells array<struct<header:string,text:string,attrs:map<string,string>>>")
def round_sheet(body: str):
    """Score-sheet tables: the heading's last word names the round, the rest the contest."""
    for heading, cells, n in _rows(body):
        contest, _, round_name = heading.rpartition(" ")
        yield {"contest_name_raw": contest, "round_name_raw": round_name, "row": n, "cells": [{"header": h, "text": c["text"], "attrs": c["attrs"]} for h, c in cells.items()]}


@page_kind("calendar", "name_raw string, date_raw string, location_raw string, country_code_raw string, website string")
def calendar(body: str):
    """Rows of an HTML calendar."""
    for _, c, _ in _rows(body):
        text = lambda k: c[k]["text"] if k in c else None  # noqa: B023, E731
        yield {"name_raw": text("Event"), "date_raw": text("Date"), "location_raw": text("Location"), "country_code_raw": c.get("Location", {}).get("attrs", {}).get("data-country"), "website": text("Website")}


@page_kind("event_index", "source_ref string, name_raw string")
def event_index(body: str):
    """Links of a listing page."""
    for m in re.finditer(r'<a\b[^>]*\bhref="([^"]*)"[^>]*>(.*?)</a>', body, re.S | re.I):
        yield {"source_ref": m.group(1), "name_raw": " ".join(re.sub(r"<[^>]+>", " ", m.group(2)).split())}


@page_kind("directory", "name string, modified string, size long")
def directory(body: str):
    """A web server's directory listing."""
    for m in re.finditer(r'<a href="([^"?/][^"]*)">[^<]*</a>\s+(\d{4}-\d{2}-\d{2} \d{2}:\d{2})\s+(\d+|-)', body):
        yield {"name": m.group(1), "modified": m.group(2), "size": None if m.group(3) == "-" else int(m.group(3))}


@page_kind("sitemap", "loc string, lastmod string")
def sitemap(body: str):
    """Addresses of an XML sitemap."""
    for url in ElementTree.fromstring(body.encode("utf-8")).iter("{http://www.sitemaps.org/schemas/sitemap/0.9}url"):
        get = lambda k: next((e.text for e in url if e.tag.endswith("}" + k)), None)  # noqa: B023, E731
        yield {"loc": get("loc"), "lastmod": get("lastmod")}


@page_kind("registry_lookup", "outcome string, wsdc_id int, first_name string, last_name string, placements array<struct<role_raw:string,division_raw:string,event_id_raw:string,event_month_raw:string,result_raw:string,points:int>>")
def registry_lookup(body: str):
    """A registry's answer for one dancer; a verified miss is an answer too."""
    o = json.loads(body)
    if o.get("outcome") == "miss":
        yield {"outcome": "miss", "wsdc_id": o.get("requested"), "placements": []}
        return
    d = o["dancer"]
    rows = [{"role_raw": role, "division_raw": p.get("division"), "event_id_raw": p.get("event"), "event_month_raw": p.get("month"), "result_raw": p.get("result"), "points": p.get("points")} for role, ps in (o.get("placements") or {}).items() for p in ps or []]
    yield {"outcome": "found", "wsdc_id": d["id"], "first_name": d.get("first"), "last_name": d.get("last"), "placements": rows}


@page_kind("rounds_json", "contest string, round string, bib string, mark int, judge int")
def rounds_json(body: str):
    """Rounds of an event in one JSON tree."""
    for contest, rounds in sorted(json.loads(body).get("contests", {}).items()):
        for name, sheet in sorted(rounds.items()):
            for row in sheet.get("rows", []):
                for judge, mark in enumerate(row.get("marks") or [], 1):
                    yield {"contest": contest, "round": name, "bib": row.get("bib"), "mark": mark, "judge": judge}


@page_kind("awards_json", "place int, leader string, follower string")
def awards_json(body: str):
    """Award lists in JSON."""
    for a in json.loads(body).get("awards", []):
        yield {"place": a.get("place"), "leader": a.get("leader"), "follower": a.get("follower")}


@page_kind("capture_index", "timestamp string, original string, statuscode string, digest string")
def capture_index(body: str):
    """A web archive's index of captures: a header row, then rows."""
    rows = json.loads(body)
    for r in rows[1:]:
        yield {k: v for k, v in zip(rows[0], r) if k in ("timestamp", "original", "statuscode", "digest")}


class Literal:
    """A reader of JavaScript literals: objects with bare keys, single quotes, trailing commas, and names bound from outside."""

    _TOKEN = re.compile(r"""\s*(?:(?P<str>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<num>-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)|(?P<id>[A-Za-z_$][\w$]*)|(?P<p>[{}\[\]:,()!]))""", re.S)
    _ESCAPE = re.compile(r"\\(u[0-9a-fA-F]{4}|x[0-9a-fA-F]{2}|.)", re.S)
    _WORDS = {"true": True, "false": False, "null": None, "undefined": None, "NaN": None}

    def __init__(self, text: str, at: int = 0, names: dict | None = None):
        self.text, self.at, self.names = text, at, names or {}

    def peek(self) -> str | None:
        m = self._TOKEN.match(self.text, self.at)
        return m.group("p") if m else None

    def take(self) -> re.Match:
        m = self._TOKEN.match(self.text, self.at)
        if not m:
            raise ValueError(f"no literal at {self.at}")
        self.at = m.end()
        return m

    def value(self):
        m = self.take()
        if (s := m.group("str")) is not None:
            def put(e: re.Match) -> str:
                c = e.group(1)
                return chr(int(c[1:], 16)) if len(c) > 1 else {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "\n": ""}.get(c, c)

            return self._ESCAPE.sub(put, s[1:-1])
        if (n := m.group("num")) is not None:
            return float(n) if any(c in n for c in ".eE") else int(n)
        if (i := m.group("id")) is not None:
            if i in self.names:
                return self.names[i]
            if i in self._WORDS:
                return self._WORDS[i]
            raise ValueError(f"unknown name {i}")
        p = m.group("p")
        if p == "!":
            return not self.value()
        if p == "[":
            return self.items("]", self.value)
        if p == "{":
            return dict(self.items("}", self.pair))
        raise ValueError(f"unexpected {p}")

    def pair(self):
        m = self.take()
        key = m.group("id") or m.group("num") or (m.group("str") or "")[1:-1]
        if self.take().group("p") != ":":
            raise ValueError("no colon after a key")
        return key, self.value()

    def items(self, end: str, one: Callable):
        out = []
        while self.peek() != end:
            out.append(one())
            if self.peek() == ",":
                self.take()
            elif self.peek() != end:
                raise ValueError("no comma between items")
        self.take()
        return out


@page_kind("calendar_script", "title string, start string, end string, url string")
def calendar_script(body: str):
    """Events of a calendar that stand as a literal in a script."""
    m = re.search(r"\bevents\s*:\s*(?=\[)", body)
    for e in Literal(body, m.end()).value() if m else []:
        yield {k: e.get(k) for k in ("title", "start", "end", "url")}


@page_kind("map_markers", "name string, lat double, lng double")
def map_markers(body: str):
    """Markers of a map, each a call with a literal."""
    for m in re.finditer(r"\baddMarker\(\s*(?=\{)", body):
        o = Literal(body, m.end()).value()
        yield {"name": o.get("name"), "lat": o.get("lat"), "lng": o.get("lng")}


def page_state(body: str):
    """The state a page carries as a call of a function literal, read without running it."""
    m = re.search(r"window\.__\w+__\s*=\s*\(?function\s*\(([^)]*)\)\s*\{\s*return\s*(?=[{\[])", body)
    if not m:
        raise ValueError("no page state")
    names = [n.strip() for n in m.group(1).split(",") if n.strip()]
    probe = Literal(body, m.end(), dict.fromkeys(names))
    probe.value()
    tail = re.compile(r"\s*;?\s*\}\s*\)?\s*\(").match(body, probe.at)
    if not tail:
        raise ValueError("no arguments")
    reader = Literal(body, tail.end())
    args = reader.items(")", reader.value)
    return Literal(body, m.end(), dict(zip(names, args))).value()


@page_kind("state_page", "event_id string, name string, city string, live boolean")
def state_page(body: str):
    """An event in a server-rendered page state."""
    e = page_state(body)["data"][0]["event"]
    yield {"event_id": e.get("id"), "name": e.get("name"), "city": e.get("city"), "live": e.get("live")}


@page_kind("positioned_text", "line int, columns array<string>")
def positioned_text(body: str):
    """Words with their positions, as a PDF gives them: lines by height, columns by the header's left edges."""
    words = json.loads(body)
    lines: dict[tuple[int, int], list[dict]] = {}
    for w in words:
        lines.setdefault((w["page"], round(w["y"])), []).append(w)
    edges: list[float] = []
    for n, (_, line) in enumerate(sorted(lines.items())):
        line.sort(key=lambda w: w["x"])
        if not edges:
            edges = [w["x"] for w in line]
            continue
        cells = [""] * len(edges)
        for w in line:
            k = max((i for i, e in enumerate(edges) if e <= w["x"] + 1), default=0)
            cells[k] = (cells[k] + " " + w["text"]).strip()
        yield {"line": n, "columns": cells}


@page_kind("text_layout", "name string, dates string")
def text_layout(body: str):
    """Fixed-position columns of a text layout: the header line's words mark where columns start."""
    lines = body.split("\n")
    at = lines[0].find("DATES") if lines else -1
    for line in lines[1:]:
        if at > 0 and line.strip():
            yield {"name": line[:at].strip(), "dates": line[at:].strip()}


def _observe(batches):
    for pdf in batches:
        rows = []
        for page, kind, body in zip(pdf.page_id, pdf.kind, pdf.body):
            try:
                found = [(kind, json.dumps(r, ensure_ascii=False)) for r in PARSERS[kind](body)] if body else []
            except Exception as e:  # a page may hold anything; what went wrong becomes a row
                found = [("error", json.dumps({"kind": kind, "reason": f"{type(e).__name__}: {e}"[:300]}))]
            rows += [(page, k, seq, payload) for seq, (k, payload) in enumerate(found)]
        yield pd.DataFrame(rows, columns=["page_id", "kind", "seq", "payload"])


def parse_pages(pages: DataFrame) -> DataFrame:
    """Observations (observation_id, page_id, kind, seq, payload) of pages (page_id, kind, body).

    Null and empty bodies give none; unreadable ones and unknown kinds give one of kind `error`.
    """
    seen = pages.select("page_id", "kind", "body").mapInPandas(_observe, "page_id string, kind string, seq int, payload string")
    return seen.select(F.substring(F.sha2(F.concat_ws("|", "page_id", "kind", "seq"), 256), 1, 16).alias("observation_id"), "*")


def decode(observations: DataFrame, kind: str) -> DataFrame:
    """The records of one kind with their declared columns."""
    rows = observations.filter(F.col("kind") == kind).select("page_id", "seq", F.from_json("payload", SCHEMAS[kind]).alias("r"))
    return rows.select("page_id", "seq", "r.*")


def account_fields(observations: DataFrame) -> DataFrame:
    """How often each key of the payloads is present, by kind: what a parser gives and what a schema misses."""
    keys = F.explode(F.json_object_keys("payload")).alias("field")
    return observations.select("kind", keys).groupBy("kind", "field").agg(F.count("*").alias("n"))
