"""From fetching to the tools, with a sender that answers from memory; politeness of the client."""

from __future__ import annotations

import io
import json

import pytest
from pyspark.sql import functions as F

from casebook import api, cli
from casebook.plans import stages
from casebook.sources import policy, registry, store


class Net:
    """Answers by address and body; keeps what was asked, and the time that passed."""

    def __init__(self, answer, robots=""):
        self.answer, self.robots, self.asked, self.now, self.slept = answer, robots, [], 0.0, []

    def send(self, url, data, headers, timeout):
        self.asked.append((url, data, headers, self.now))
        if url.endswith("/robots.txt"):
            return policy.Response(url, 200, self.robots.encode(), {})
        got = self.answer(url, data)
        if isinstance(got, Exception):
            raise got
        return got if isinstance(got, policy.Response) else policy.Response(url, 200, got, {})

    def sleep(self, seconds):
        self.slept.append(seconds)
        self.now += seconds

    def client(self, name="hansard", **changes):
        p = policy.POLICIES[name]
        return policy.Client(policy.Policy(**(p.__dict__ | changes)), self.send, self.sleep, lambda: self.now, retries=3)


def test_intervals_caps_and_robots():
    net = Net(lambda url, data: b"x", "User-agent: *\nDisallow: /private\nCrawl-delay: 9\n")
    c = net.client(min_interval=2.0, daily_cap=4)
    assert c.get("https://h/a", {"q": "1 2"}).body == b"x" and c.get("https://h/b?x=1", {"y": 2}).url == "https://h/b?x=1&y=2"
    assert [a for a, *_ in net.asked] == ["https://h/robots.txt", "https://h/a?q=1+2", "https://h/b?x=1&y=2"] and net.slept == [9.0, 9.0]
    with pytest.raises(policy.Disallowed):
        c.get("https://h/private/1")
    assert json.loads(c.post_json("https://h/p", {"a": 1}) and net.asked[-1][1]) == {"a": 1}
    with pytest.raises(policy.CapReached):
        c.get("https://h/c")
    assert policy.POLICIES["sso"].merge(1.0).min_interval == 6.0 and policy.POLICIES["sso"].merge(60.0).min_interval == 60.0


def test_retries_and_waits():
    answers = [OSError("down"), policy.Response("u", 429, b"", {"Retry-After": "7"}), b"fine"]
    net = Net(lambda url, data: answers.pop(0))
    assert net.client(respect_robots=False).get("https://h/a").body == b"fine" and net.slept[0] == 2.0 and 7.0 in net.slept
    gone = Net(lambda url, data: OSError("down"))
    assert gone.client(respect_robots=False).get("https://h/a") is None and len(gone.asked) == 3
    assert Net(lambda url, data: policy.Response("u", 503, b"", {})).client(respect_robots=False).get("https://h/a").status == 503


def sitting(day, sections):
    listed = [{"startPgNo": 1, "endPgNo": 2, "title": title, "subTitle": None, "sectionType": kind, "questionNo": None, "content": content} for title, kind, content in sections]
    return json.dumps({"metadata": {"parlimentNO": 14, "sittingDate": day, "dateToDisplay": day}, "takesSectionVOList": listed, "attendanceList": [{"mpName": "A", "attendance": True}, {"mpName": "B", "attendance": False}]}).encode()


BILL = ("Ocean Safety Bill", "BP", "<p><strong>Mr Tan (Bukit Lama)</strong>: I beg to move that whales are licensed.</p><p>They are many.</p><p><strong>Dr Lim</strong>: I object to the whales.</p>")
FIRST = {"2024-02-05": sitting("05-02-2024", [BILL, ("Empty", "OS", "")]), "2024-02-06": sitting("06-02-2024", [("Trains", "OA", "<p><strong>Ms Ng</strong> asked the Minister for Transport about trains.</p>")])}


def answered(days):
    def answer(url, data):
        day = json.loads(data)["sittingDate"]
        iso = "-".join(reversed(day.split("-")))
        return days.get(iso, b'{"errorCode": "none"}')

    return answer


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("root"))
    got = stages.fetch(spark, root, "hansard", "2024-02-03", "2024-02-07", client=Net(answered(FIRST)).client())
    assert (got["fetched"], got["empty"], got["failures"], got["snapshots_total"]) == (2, 1, 0, 2)
    return root


def asked(spark, root, *argv, lines=()):
    out = io.StringIO()
    code = cli.main(["--root", root, *argv], spark, out, iter(lines))
    return code, out.getvalue()


def test_command_line_to_tools(spark, root):
    assert asked(spark, f"{root}/none", "search", "whales") == (1, "No index. Run `index` first.\n")
    assert "hansard" in asked(spark, root, "sources")[1]
    again = stages.fetch(spark, root, "hansard", "2024-02-03", "2024-02-07", client=Net(lambda *_: OSError("never asked")).client())
    assert (again["fetched"], again["skipped"], again["failures"]) == (0, 3, 0)
    counts = json.loads(asked(spark, root, "normalise", "hansard")[1])
    assert counts == {"snapshots": 2, "documents": 7, "failures": 0, "parser_rev": registry.get("hansard").revision}
    assert json.loads(asked(spark, root, "enrich", "hansard")[1]) == {"refs": 0}
    assert json.loads(asked(spark, root, "index", "--source", "hansard")[1])["documents"] == 7
    assert "urn:sg:hansard:2024-02-05:s0:sp0" in asked(spark, root, "search", "whales")[1]
    assert "No hits" in asked(spark, root, "search", "unicorns")[1] and asked(spark, root, "search", '"open')[0] == 1
    stats = asked(spark, root, "stats")[1]
    assert "2024-02-05" in stats and "attribution_pct=100.0" in stats
    ask = [{"tool": "list_tools"}, {"tool": "get_document", "arguments": {"urn": "urn:sg:hansard:2024-02-05"}}, {"tool": "get_document", "arguments": {"urn": "urn:sg:hansard:2024-02-05:s0", "parts": ["sp0", "sp1"]}}, {"tool": "nothing"}, {"tool": "search"}, {"tool": "search", "arguments": {"query": "whales", "other": 1}}, {"tool": "find_citing", "arguments": {"urn": "u"}}]
    code, out = asked(spark, root, "serve", lines=[*map(json.dumps, ask), "not json", ""])
    got = list(map(json.loads, out.splitlines()))
    assert code == 0 and set(got[0]["tools"]) == set(api.TOOLS)
    assert got[1]["meta"]["attendance_count"] == 1 and "text" not in got[1] and got[1]["source_url"]
    assert [x["urn"][-3:] for x in got[2]["parts"]] == ["sp0", "sp1"] and got[2]["more"] is False
    assert [x.get("error") for x in got[3:]] == ["not_found", "invalid_argument", "invalid_argument", "out_of_coverage", "invalid_argument"]


def test_update_adds_and_keeps(spark, root, tmp_path):
    """What is fetched later replaces its urns and no others; the search index gets a segment."""
    asked(spark, root, "normalise", "hansard")
    asked(spark, root, "index", "--source", "hansard")
    later = {"2024-02-08": sitting("08-02-2024", [("Harbours", "OS", "<p><strong>Mr Tan</strong>: Harbours need whales.</p>")])}
    stages.fetch(spark, root, "hansard", "2024-02-08", "2024-02-08", client=Net(answered(later)).client())
    asked(spark, root, "normalise", "hansard")
    assert json.loads(asked(spark, root, "index", "--source", "hansard", "--update")[1])["documents"] == 10
    tables, index = cli.opened(spark, root)
    hits = api.handle(tables, index, "search", {"query": "whales", "corpus": ["hansard"], "limit": 10})["hits"]
    assert {x["urn"] for x in hits} == {"urn:sg:hansard:2024-02-05:s0:sp0", "urn:sg:hansard:2024-02-05:s0:sp1", "urn:sg:hansard:2024-02-08:s0:sp0"}
    assert all("<<whales>>" in x["snippet"] for x in hits) and [x["score"] for x in hits] == sorted(x["score"] for x in hits)
    again = json.loads(asked(spark, root, "index", "--source", "hansard", "--update")[1])
    assert again["documents"] == 10 and index.stats().first()["docs"] == 10


def test_upsert_by_folders(spark, tmp_path):
    kinds = "urn string, corpus string, issued date, meta string, provenance struct<source_url:string,retrieved_at:timestamp,snapshot_sha256:string,adapter:string,adapter_version:string,parser_rev:int>"

    def docs(*rows):
        empty = spark.createDataFrame([], store.DOCUMENT)
        made = spark.createDataFrame([(u, c, None, "{}", ("x", None, sha, "a", "1", 1)) for u, c, _, sha in rows], kinds)
        days = spark.createDataFrame([(u, sha, day) for u, _, day, sha in rows], "urn string, sha string, day string")
        made = made.join(days, (made.urn == days.urn) & (made.provenance.snapshot_sha256 == days.sha)).select(made["*"], F.to_date("day").alias("d")).withColumn("issued", F.col("d")).drop("d")
        return empty.unionByName(made, allowMissingColumns=True)

    path = str(tmp_path / "d")
    store.insert_documents(docs(("a", "act", "2020-01-01", "s1"), ("b", "act", "2020-05-01", "s1"), ("c", "sl", None, "s1")), path)
    store.upsert_documents(docs(("b", "act", "2021-05-01", "s2"), ("c", "sl", "2020-01-01", "s2"), ("e", "bill", "2020-02-02", "s2"), ("e", "bill", "2020-02-02", "s3")), path)
    rows = spark.read.schema(store.TABLES["documents"]).parquet(path).collect()
    assert sorted((r.urn, r.corpus, r.year, r.provenance.snapshot_sha256) for r in rows) == [("a", "act", 2020, "s1"), ("b", "act", 2021, "s2"), ("c", "sl", 2020, "s2"), ("e", "bill", 2020, "s2")]


def test_resolve_by_near_citations(spark):
    docs = spark.createDataFrame([("u1", "[2024] SGCA 15"), ("u2", "[2024] SGCA 51"), ("u3", "[2019] SGHC 7")], "urn string, citation string")
    aliases = spark.createDataFrame([("PDPA", "u3", "short")], "alias string, urn string, kind string")
    ask = lambda c: [(r.urn, r.how) for r in api.resolve_citation(docs, aliases, c).collect()]
    assert ask("[2024] SGCA 15") == [("u1", "exact")] and ask("PDPA") == [("u3", "alias")]
    assert ask("[2024] SGCA 1") == [("u1", "near"), ("u2", "near")] and ask("nothing like it") == []
