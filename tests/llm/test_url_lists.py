import datetime as dt
import re

from checks.compare import differences, oracle_connection
from holdfast.llm import url_lists
from holdfast.llm.queries import ORACLE, QUERIES

D = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)


def brute_keys(url):
    m = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]*)://(?:[^/?#@]*@)?([^/:?#]*)(?::\d+)?([^?#]*)", url or "")
    if not m or not m[2]:
        return []
    host = re.sub(r"^www\.", "", m[2].lower())
    labels = host.split(".")
    keys = [".".join(labels[i:]) for i in range(max(1, len(labels) - 1))]
    segments = [s for s in m[3].split("/") if s]
    return keys + [host + "/" + "/".join(segments[: i + 1]) for i in range(len(segments))]


def brute(url, when, entries):
    active = []
    for key in set(brute_keys(url)):
        for name in ("allow", "block"):
            past = [e for e in entries if e[0] == name and e[1] == key and e[2] in ("add", "remove") and e[3] is not None and when is not None and e[3] <= when]
            if past and max(past, key=lambda e: (e[3], e[2]))[2] == "add":
                active.append((len(key), name == "allow", key, name))
    best = max(active, default=None)
    return (best and best[2], best and best[3], len(active), bool(best and best[3] == "block"))


def test_matches_brute_force(spark):
    urls = ["https://www.a.example.com/x/y?z=/q", "http://u:p@a.example.com:80/x", "http://B.example.com", "http://lone/x", "ftp://c.org//x//y#f", "nonsense", "", None]
    patterns = ["example.com", "a.example.com", "a.example.com/x", "a.example.com/x/y", "lone", "c.org/x/y", "com", "b.example.com", None]
    entries = []
    for k, p in enumerate(patterns):
        for n, (day, action) in enumerate([(0, "add"), (3, "add"), (5, "remove"), (7, "remove"), (9, "add"), (9, "remove"), (12, "add")]):
            if (k * 7 + n * 5) % 4:
                entries.append(("block" if (k + n // 4) % 3 else "allow", p, action, D(day + k % 3), "c"))
    entries += [(None, "lone", "add", D(0), None), ("block", "lone", "other", D(0), "c"), ("block", "c.org/x/y", "add", None, "c"), entries[0]]
    rows = [(i, u, D(t), "s") for i, (u, t) in enumerate((u, t) for u in urls for t in range(16))] + [(900, urls[0], None, "s"), (0, urls[0], D(0), "s")]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched date, a_url string")
    logged = spark.createDataFrame(entries, "list string, pattern string, action string, dated date, category string")
    got = sorted((r.page_id, r.pattern, r.list, r.n_active, r.blocked) for r in url_lists.judged(captures.drop("a_url"), logged).collect())
    want = sorted((i, *brute(u, t, entries)) for i, u, t, _ in rows)
    assert [tuple(map(str, x)) for x in got] == [tuple(map(str, x)) for x in want]
    assert any(x[4] for x in got) and any(x[2] == "allow" for x in got)
    assert url_lists.judged(captures.drop("a_url").limit(0), logged).count() == 0
    assert url_lists.judged(captures.drop("a_url"), logged.limit(0)).where("blocked or pattern is not null").count() == 0


def test_oracle(spark):
    folder = "/root/testdata/sf0.01"
    name = "op9_url_lists"
    assert not differences(spark, oracle_connection(folder), name, QUERIES[name], ORACLE[name], folder)
    assert 0 < QUERIES[name](spark, folder).where("blocked").count() < 250


def test_plan_is_native(spark):
    plan = QUERIES["op9_url_lists"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)
