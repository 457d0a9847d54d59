import datetime
import random

from tierwise.llm import url_filter

DAY = datetime.date(2024, 1, 1)


def day(n):
    return DAY + datetime.timedelta(n)


def brute(captures, entries):
    states = {}
    for name, pattern, when, listed in entries:
        if None not in (name, pattern, when, listed):
            host, slash, path = pattern.partition("/")
            key = (name, (host.lower() + slash + path).rstrip("/"))
            states.setdefault(key, {}).setdefault(when, []).append(listed)
    made = []
    for page_id, url, fetched in captures:
        active = []
        for (name, pattern), days in states.items():
            past = [d for d in days if fetched and d <= fetched.date()]
            if url and past and all(days[max(past)]) and under(url, pattern):
                active.append(name)
        made.append((page_id, url, fetched, bool(active), ",".join(sorted(set(active))) or None, len(active)))
    return sorted(made, key=str)


def under(url, pattern):
    scheme, mark, rest = url.partition("://")
    if not mark or not scheme[:1].isalpha():
        return False
    rest = rest.split("#")[0].split("?")[0]
    authority, _, path = rest.partition("/")
    host = authority.rpartition("@")[2].split(":")[0].rstrip(".").lower()
    domain, _, prefix = pattern.partition("/")
    have, want = [s for s in path.split("/") if s], [s for s in prefix.split("/") if s]
    return bool(host) and (host == domain or host.endswith("." + domain)) and have[: len(want)] == want


def found(spark, captures, entries):
    c = spark.createDataFrame([(*x, "x", 5) for x in captures], "page_id long, url string, fetched timestamp_ntz, lists string, stretch int")
    e = spark.createDataFrame([(*x, "y") for x in entries], "list string, pattern string, day date, listed boolean, valid_to string")
    return sorted(map(tuple, url_filter.evaluate(c, e).collect()), key=str)


def test_random_histories(spark):
    rng = random.Random(6)
    hosts = ["a.org", "x.a.org", "y.x.a.org", "b.org", "ba.org", "org"]
    paths = ["", "/", "/p", "/p/q", "/P/q", "/pq?p/q", "/p/q/r#x"]
    entries = [
        (rng.choice("mn"), rng.choice(hosts) + rng.choice(["", "/", "/p", "/p/q"]), day(rng.randint(-100, 400)), rng.random() < 0.6) for _ in range(150)
    ]
    captures = [
        (i, rng.choice(["http://", "https://u:p@", "HTTP://"]) + rng.choice(hosts).upper() + rng.choice(["", ":80", "."]) + rng.choice(paths),
         datetime.datetime.combine(day(rng.randint(-120, 420)), datetime.time(rng.randint(0, 23))))
        for i in range(300)
    ]
    assert found(spark, captures, entries) == brute(captures, entries)


def test_on_the_day(spark):
    entries = [("m", "a.org", day(1), True), ("m", "a.org", day(3), False), ("m", "a.org", day(3), True), ("m", "a.org", day(2), True)]
    times = [datetime.datetime.combine(day(n), t) for n in range(5) for t in (datetime.time(0), datetime.time(23, 59, 59))]
    rows = found(spark, [(i, "http://a.org", t) for i, t in enumerate(times)], entries)
    assert {r[0] for r in rows if r[3]} == {2, 3, 4, 5}


def test_odd_rows(spark):
    entries = [("m", "a.org", day(0), True), (None, "a.org", day(0), True), ("m", None, day(0), True), ("m", "b.org", None, True), ("m", "c.org", day(0), None), ("m", "a.org", day(0), True)]
    now = datetime.datetime.combine(day(9), datetime.time(1))
    captures = [(1, "http://a.org/" + "s/" * 3000, now), (2, None, now), (3, "", now), (4, "http://a.org", None), (None, "http://a.org", now), (5, "a.org", now), (6, "://a.org", now), (7, "http://", now)]
    captures += captures[:1]
    assert found(spark, captures, entries) == brute(captures, entries)
    assert found(spark, captures, []) == brute(captures, [])
    assert found(spark, [], entries) == []


def test_no_python_in_the_plan(spark):
    from tierwise.llm.queries import op2_url_lists

    plan = op2_url_lists(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
