"""Revisits against a plain search per record."""

import random

import pytest

from fieldsync.llm import revisits

SCHEMA = "record_id long, kind string, url string, at long, status int, headers map<string,string>, digest string, range int"


def plain(records, canonical):
    out = []
    for r in records:
        if r[1] != "revisit":
            continue
        known = [x for x in records if x[1] == "response" and x[4] == 200 and r[3] is not None and x[3] is not None and canonical[x[2]] == canonical[r[2]] is not None and (x[3], x[0]) < (r[3], r[0])]
        if not known:
            out.append((r[0], "no_response", None))
            continue
        best = max(known, key=lambda x: (x[3], x[0]))
        mine, theirs = ({k.lower(): v for k, v in (x[5] or {}).items()} for x in (r, best))
        agrees = None
        if "etag" in mine and "etag" in theirs:
            agrees = mine["etag"].removeprefix("W/") == theirs["etag"].removeprefix("W/")
        elif "last-modified" in mine and "last-modified" in theirs:
            agrees = mine["last-modified"] == theirs["last-modified"]
        elif r[6] is not None and best[6] is not None:
            agrees = r[6] == best[6]
        out.append((r[0], {None: "no_validator", True: "resolved", False: "differs"}[agrees], best[0] if agrees else None))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_records(spark, seed):
    r = random.Random(seed)
    urls = ["http://A.example/x/", "https://www.a.example/x#top", "a.example:443/x?utm_source=q", "http://a.example/y?b=2&a=1", "http://a.example/y?a=1&b=2&gclid=7", "http://b.example", None]
    canonical = dict(zip(urls, ["a.example/x"] * 3 + ["a.example/y?a=1&b=2"] * 2 + ["b.example", None], strict=True))
    records = []
    for i in range(300):
        kind = r.choice(["response", "revisit", "revisit", "request"])
        headers = {}
        if r.random() < 0.6:
            headers[r.choice(["ETag", "etag"])] = r.choice(["", "W/"]) + f'"{r.randrange(2)}"'
        if r.random() < 0.5:
            headers["Last-Modified"] = str(r.randrange(2))
        records.append((i, kind, r.choice(urls[:3] if r.random() < 0.7 else urls), r.choice([None, *range(60)]), r.choice([200, 200, 404]), headers or None, r.choice([None, "d0", "d1"]), 5))
    made = revisits.resolved(spark.createDataFrame(records, SCHEMA).repartition(6)).collect()
    assert sorted((x.record_id, x.outcome, x.target_id) for x in made) == plain(records, canonical)


def test_merged_headers(spark):
    records = [
        (1, "response", "http://h/p", 1, 200, {"Content-Type": "text/html", "ETag": '"a"', "Date": "1", "Content-Length": "9"}, "d", 0),
        (2, "revisit", "http://h/p", 2, 304, {"etag": 'W/"a"', "DATE": "2", "Content-Length": "0", "Set-Cookie": "x", "Vary": "*"}, None, 0),
    ]
    (made,) = revisits.resolved(spark.createDataFrame(records, SCHEMA)).collect()
    assert (made.outcome, made.target_id, made.digest) == ("resolved", 1, "d")
    assert made.headers == {"content-type": "text/html", "etag": 'W/"a"', "date": "2", "content-length": "9", "vary": "*"}


def test_empty(spark):
    assert revisits.resolved(spark.createDataFrame([], SCHEMA)).collect() == []
