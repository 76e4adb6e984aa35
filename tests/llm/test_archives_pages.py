"""op3 on made pages, op5 against brute force, op10 round trips, and the pipeline."""
import base64
import hashlib
import os
import random

import pytest


def page(i, layout, paragraphs=3):
    body = "".join(f"<p>Paragraph {k} of page {i}, with <b>bold</b> &amp; more.\n  Second&nbsp;line" for k in range(paragraphs))
    want = [f"Paragraph {k} of page {i}, with bold & more. Second line" for k in range(paragraphs)]
    if layout == "plain":  # nothing but the wrapper tells what is article
        return (f"<html><head><title>T{i}</title><script>var a='<p>no</p>';</script></head><body><div>Welcome to our site</div><div><a href='/'>Home</a> <a href='/x'>All</a></div>"
                f"<div id=body{i}><h1>Title {i}</h1>{body}</div><div>All rights reserved</div><form>Search <input></form></body></html>"), [f"Title {i}"] + want
    return (f"<HTML><BODY><NAV><ul><li><a href=/>n{i}</a></ul></NAV><!-- <p>x</p> --><div class='ad top'>Buy {i}</div><article><div class='entry-header'><h1>Title {i}</h1></div>{body}"
            f"<aside>side {i}</aside></article><div class='sidebar1'>side</div><section id=comments><p>reader {i}</section><footer>&copy; {i}</footer>"), [f"Title {i}"] + want


def test_pages_with_and_without_marks(spark):
    from riskmart.llm.html_extract import extract_text
    rows, want = [], {}
    for i in range(60):
        layout = "plain" if i % 2 else "marked"
        html, text = page(i, layout, 1 + i % 4)
        rows.append((i, f"https://{layout}.example.org/{i}?a=b", html, "x"))
        want[i] = "\n".join(text)
    copy = page(0, "marked")  # a host of copies of one article keeps it
    for i in range(100, 130):
        rows.append((i, "http://user@copies.example.org:80/", copy[0], "x"))
        want[i] = "\n".join(copy[1])
    for i, html in enumerate([None, "", "   ", "no markup & none", "<p>open <b>tag", "< 3 and > 2 <", "</p></div>", "<p>" + "long " * 50_000, "<script>x", "<!-- x"]):
        rows.append((200 + i, None if i % 2 else "", html, "x"))
    want |= {200: "", 201: "", 202: "", 203: "no markup & none", 204: "open tag", 205: "< 3 and > 2 <", 206: "", 207: ("long " * 50_000).strip(), 208: "", 209: ""}
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string").repartition(5)).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got) and len(got) == len(rows)
    assert extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_tree_matching():
    from riskmart.llm import html_extract as H

    def tree(label, *children):
        return {"l": label, "n": 1, "m": 0, "s": {}, "t": {}, "c": list(children)}

    def brute(a, b):  # plain recursion over all order-preserving matches
        if a["l"] != b["l"]:
            return 0

        def best(x, y):
            if not x or not y:
                return 0
            w = brute(x[0], y[0])
            return max(best(x[1:], y), best(x, y[1:]), w + best(x[1:], y[1:]) if w else 0)
        return 1 + best(a["c"], b["c"])

    rng = random.Random(3)

    def made(depth):
        return tree(rng.choice("abc"), *[made(depth - 1) for _ in range(rng.randint(0, 3) if depth else 0)])

    for _ in range(200):
        a, b = made(3), made(3)
        a["l"] = b["l"] = "r"
        assert H.matching(a, b) == brute(a, b)
        assert H.merge(a, b)["n"] == 2


FAKE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: {}\r\n\r\n"
PAYLOADS = ["", None, FAKE.format(5) + "abcde\r\n\r\n", "x" * 5000 + "\r\n\r\n" + FAKE.format(50) + "é" * 3000, "WARC/1.1\r\nWARC-Type: ", FAKE.format(10**9), "line\nfeeds\r\n", "same", "same"]


@pytest.mark.parametrize("range_bytes", [90, 1000, 8 << 20])
def test_archives_read_back_what_was_written(spark, tmp, range_bytes):
    from riskmart.llm.warc import read_archives, write_archives
    rows = [(i, f"http://x/{i}\r\n% é" if i % 3 else None, PAYLOADS[i % len(PAYLOADS)], "z") for i in range(70)] + [(3, "twice", PAYLOADS[3], "z"), (None, "none", "same", "z"), (None, "alone", "no id", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3)
    write_archives(df, f"file://{tmp}/w")
    got = read_archives(spark, f"file://{tmp}/w", range_bytes).collect()
    first = {}
    for i, _, h, _ in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h, _ in rows:
        raw = (h or "").encode()
        refers = first.get(h or "")
        refers = None if refers in (None, i) else refers
        want.append((str(i), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if refers is None else "revisit", str(refers)))
    assert sorted((r.record_id or "None", r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == sorted(want)


def test_archives_empty_and_cut(spark, tmp):
    from riskmart.llm.warc import read_archives, write_archives
    schema = "page_id long, url string, html string"
    write_archives(spark.createDataFrame([], schema), f"file://{tmp}/none")
    assert read_archives(spark, f"file://{tmp}/none").count() == 0
    write_archives(spark.createDataFrame([(1, "u", "abc"), (2, "u", "defgh")], schema).coalesce(1), f"file://{tmp}/cut")
    part, = [os.path.join(tmp, "cut", f) for f in os.listdir(f"{tmp}/cut") if f.startswith("part")]
    raw = open(part, "rb").read()
    os.makedirs(f"{tmp}/short")
    open(f"{tmp}/short/part.txt", "wb").write(raw[:-3])
    with pytest.raises(ValueError, match="end at byte"):
        read_archives(spark, f"file://{tmp}/short").count()


def test_least_payload_for_revisits(spark, tmp):
    from riskmart.llm.warc import read_archives, write_archives
    df = spark.createDataFrame([(i, "u", "tiny" if i % 2 else "long enough payload") for i in range(6)], "page_id long, url string, html string")
    write_archives(df, f"file://{tmp}/w", least_bytes=10)
    got = {int(r.record_id): r.record_type for r in read_archives(spark, f"file://{tmp}/w").collect()}
    assert got == {0: "response", 1: "response", 2: "revisit", 3: "response", 4: "revisit", 5: "response"}


def test_registered_queries():
    from riskmart.llm.queries import ORACLE_SQL, QUERIES
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)
