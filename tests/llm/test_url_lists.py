"""Operator 8: verdicts against a search of all entries."""

import datetime as dt
import random

from arrears.llm import url_lists

T0 = dt.datetime(2024, 1, 1)


def test_hosts_and_domains(spark):
    urls = ["HTTP://User@Sub.Example.COM:80/p?q#f", "https://a.b", "ftp://one/x", "no url", None, "", "https://x.y.z.example.org"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(url_lists.host_of(url_lists.F.col("u")).alias("h"))
    assert [r.h for r in df.collect()] == ["sub.example.com", "a.b", "one", "", "", "", "x.y.z.example.org"]
    rows = df.select(url_lists.domains_of(df["h"]).alias("d")).collect()
    assert rows[-1].d == ["x.y.z.example.org", "y.z.example.org", "z.example.org", "example.org"]
    assert rows[0].d == ["sub.example.com", "example.com"] and rows[2].d == ["one"]


def test_against_brute_force(spark):
    rng = random.Random(6)
    hosts = ["a.example.com", "b.example.com", "x.a.example.com", "example.com", "other.org", "hot.net"]
    entries = [(rng.choice(hosts + [None]), rng.choice([None] + [T0 + dt.timedelta(hours=rng.randint(0, 200)) for _ in range(9)]),
                rng.choice(["error", "click", "view"])) for _ in range(150)]
    entries += [("hot.net", T0 + dt.timedelta(seconds=i), rng.choice(["error", "view"])) for i in range(300)]
    captures = [(i, rng.choice([f"https://{rng.choice(hosts)}/{i}", None, "bad"]),
                 rng.choice([None, T0 + dt.timedelta(hours=rng.randint(-5, 300))]), "kept?") for i in range(200)]
    captures += [(500 + i, "http://hot.net/", T0 + dt.timedelta(seconds=i), "x") for i in range(300)]
    captures += captures[:5]
    c = spark.createDataFrame(captures, "page_id long, url string, fetched timestamp_ntz, kept string").repartition(3)
    e = spark.createDataFrame(entries, "domain string, since timestamp_ntz, category string")
    judged, names = url_lists.filter_captures(c, e)
    assert names["kept"] == "_kept"
    got = sorted((r.page_id, str(r.listed), str(r.category), r._kept) for r in judged.collect())

    def want(url, at):
        host = url.split("/")[2] if url and "//" in url else ""
        for k in range(max(1, host.count("."))):
            domain = ".".join(host.split(".")[k:])
            under = [(s, cat) for d, s, cat in entries if d == domain and s is not None and at is not None and s <= at]
            if host and under:
                cat = max(under)[1]
                return domain, cat, cat != "error"
        return "None", "None", True

    assert got == sorted((i, *want(u, at)) for i, u, at, _ in captures)


def test_empty(spark):
    c = spark.createDataFrame([], "page_id long, url string, fetched timestamp_ntz")
    e = spark.createDataFrame([], "domain string, since timestamp_ntz, category string")
    assert url_lists.filter_captures(c, e)[0].count() == 0
    one = spark.createDataFrame([(1, "http://a.b/", T0)], "page_id long, url string, fetched timestamp_ntz")
    assert url_lists.filter_captures(one, e)[0].first().kept
