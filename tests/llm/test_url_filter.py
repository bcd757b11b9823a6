"""URL filters against walking through the list for every capture."""

import random

from pyspark.sql import functions as F

from spark_triples.llm import url_filter as u

CAPTURES = "page_id long, url string, day long, domain string, month int"
ENTRIES = "domain string, day long, action string, note string"


def walked(url, day, entries):
    host = (url or "").split("://")[1].split("/")[0].lower() if "://" in (url or "") else ""
    labels = host.split(".")
    for k in range(len(labels) - 1):
        domain = ".".join(labels[k:])
        past = [(d, u._RANK[a], a) for n, d, a in entries if n == domain and day is not None and d <= day]
        if past:
            since, _, action = max(past)
            if action != "remove":
                return action, domain, since
    return "unlisted", None, None


def test_equals_walking_through_the_list(spark):
    rng = random.Random(10)
    names = ["a.b.example.com", "b.example.com", "example.com", "x.org", "www.x.org"]
    entries = [(rng.choice(names), rng.randrange(19_000, 19_300), rng.choice(list(u._RANK))) for _ in range(80)]
    captures = [
        (i, f"http{'s' * (i % 2)}://{rng.choice([*names, 'other.net', 'A.B.Example.com'])}/p?q=http://x.org/", rng.randrange(18_990, 19_400))
        for i in range(400)
    ]
    captures += [(400, None, 19_100), (401, "no url", 19_100), (402, "http://x.org/", None), (None, "http://x.org/", 19_200)]
    captures += [captures[0]] * 3 + [(403, "http://x.org/" + "y" * 100_000, 19_250), (404, "http://localhost/", 19_100)]
    odd = [(None, 19_100, "block"), ("x.org", None, "block"), ("x.org", 19_100, None), ("x.org", 19_100, "odd")]
    found = u.judge(
        spark.createDataFrame([(*c, "z", 1) for c in captures], CAPTURES),
        spark.createDataFrame([(*e, "z") for e in entries + odd], ENTRIES),
    )
    got = sorted(((r["page_id"], r["verdict"], r["domain"], r["since"]) for r in found.collect()), key=repr)
    assert got == sorted(((i, *walked(url, day, entries)) for i, url, day in captures), key=repr)


def test_empty_tables(spark):
    captures = spark.createDataFrame([(1, "http://x.org", 5, "z", 1)], CAPTURES)
    entries = spark.createDataFrame([("x.org", 5, "block", "z")], ENTRIES)
    none = F.lit(False)
    assert u.judge(captures, entries.filter(none)).first()["verdict"] == "unlisted"
    assert u.judge(captures.filter(none), entries).count() == 0
    assert u.judge(captures, entries).first()["verdict"] == "block"


def test_hosts_as_browsers_read_them(spark):
    urls = {
        "https://user@bad.com/": "bad.com",
        "https://a:b@bad.com/x@y": "bad.com",
        "https://a@b@bad.com:8080": "bad.com",
        "https://bad.com./": "bad.com",
        "HTTPS://BAD.com..:443?x": "bad.com",
        " \thttp://bad.com#@good.com": "bad.com",
        "http://bad.com\\@good.com/": "bad.com",
        "http://good.com/?u=a@bad.com": "good.com",
        "http://": "",
        "bad.com": "",
        "": "",
    }
    frame = spark.createDataFrame([(u_,) for u_ in urls], "url string")
    found = {r["url"]: r["host"] for r in frame.select("url", u.host_of(F.col("url")).alias("host")).collect()}
    assert found == urls
    import duckdb

    sql = u.OP10_SQL.split("AS host", 1)[0].rsplit(" AS day,", 1)[1]
    db = duckdb.connect()
    db.register("urls", frame.toPandas())
    assert dict(db.sql(f"SELECT url, {sql} AS host FROM urls").fetchall()) == urls


def test_days_far_off(spark):
    days = [0, 5, 31, 32, 33, 1_700_000_000_000, -(10**15), 2**62]
    captures = [(k, "http://bad.com/", d, "z", 1) for k, d in enumerate(days)]
    entries = [("Bad.com.", -(10**14), "block", "z"), ("bad.com", 31, "allow", "z"), ("bad.com", 33, "remove", "z"), ("bad.com", 10**12, "block", "z")]
    found = u.judge(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES)).collect()
    plain = [(n.lower().rstrip("."), d, a) for n, d, a, _ in entries]
    got = {r["page_id"]: (r["verdict"], r["domain"], r["since"]) for r in found}
    assert got == {k: walked("http://bad.com/", d, plain) for k, d in enumerate(days)}
    odd = spark.createDataFrame([(1, "http://bad.com/", "soon"), (2, "http://bad.com/", "7")], "page_id long, url string, day string")
    found = u.judge(odd, spark.createDataFrame(entries, ENTRIES)).collect()
    assert {r["page_id"]: r["verdict"] for r in found} == {1: "unlisted", 2: "block"}
