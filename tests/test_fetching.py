"""Fetch decisions on odd rows, and robots rules against the standard library's own answers."""

from urllib.robotparser import RobotFileParser

import pytest
from pyspark.sql import functions as F

from annalist.operators import fetching

FILES = {
    "none": None,
    "empty": b"",
    "all": b"User-agent: *\nDisallow: /\n",
    "mine": b"User-agent: other\nDisallow: /\n\nUser-agent: bot\nDisallow: /a\nAllow: /a/b\nAllow: /\n\nUser-agent: *\nDisallow: /c\n",
    "order": b"User-agent: bot\nAllow: /a/b\nDisallow: /a\n",
    "free": b"User-agent: bot\nDisallow:\n",
    "query": b"User-agent: *\nDisallow: /x?y=\nDisallow: /%7Eu\nDisallow: /\xd0\xb0\n",
    "broken": b"\xff\xfe nonsense\nDisallow /x",
}
PATHS = ["", "/", "/a", "/a/b", "/ab", "/c/d", "/x?y=1", "/x?z=1", "/~u/1", "/%7Eu/1", "/%D0%B0/1", "/а", "/a%2Fb", "/p+q", "/bad%zz", "/#a"]


def test_rules_answer_as_the_parser_does(spark):
    files = spark.createDataFrame([(n, b) for n, b in FILES.items()], "name string, body binary")
    urls = spark.createDataFrame([(p, f"https://h.example{p}") for p in PATHS], "p string, u string")
    rules = {r["name"]: r["rules"] for r in fetching.robots_rules(files, "bot/1.0", ["name"]).collect()}
    assert rules["none"] == rules["empty"] == [] and [r["path"] for r in rules["mine"]] == ["/a", "/a/b", "/"]
    got = {(r["name"], r["p"]): r["ok"] for r in urls.join(fetching.robots_rules(files, "bot/1.0", ["name"]).hint("broadcast"), F.lit(True)).select("name", "p", fetching.allowed(F.col("rules"), F.col("u")).alias("ok")).collect()}
    for name, body in FILES.items():
        parser = RobotFileParser()
        parser.parse((body or b"").decode("utf-8", errors="replace").splitlines())
        for p in PATHS:
            assert got[name, p] == parser.can_fetch("bot/1.0", f"https://h.example{p}"), (name, p)


def test_missing_values_fail_their_own_check(spark):
    uuid = "00000000-0000-4000-8000-000000000000"
    task = "task_id int, source_id string, route_id string, url string, request_kind string, attempt int, extra string"
    tasks = spark.createDataFrame([(1, None, uuid, "https://h.example/", "page", 1, ""), (2, "s", None, "https://h.example/", "page", 1, ""), (3, "s", uuid, None, "page", 1, ""), (4, "s", uuid, "https://h.example/", None, 1, ""), (5, "s", uuid, "https://h.example/", "page", 1, ""), (6, "t", uuid, "https://h.example/", "api", 1, ""), (7, "u", uuid, "https://h.example/", "api", None, "")], task)
    preflight = spark.createDataFrame([("s", uuid, None, True, "respect", "active", None, "detail", None), ("t", uuid, "enabled", None, "respect", None, None, None, None), ("u", uuid, "enabled", True, "ignore", None, None, None, None)], "source_id string, route_id string, source_state string, has_policy boolean, robots_policy string, route_state string, circuit_open_until timestamp_ntz, route_kind string, browser_allowed boolean")
    robots = spark.createDataFrame([], f"source_id string, origin string, rules {fetching.RULES}, fresh boolean")
    responses = spark.createDataFrame([(7, 503, None, None, None, None, None, None, None)], "task_id int, status int, body_empty boolean, error string, by_policy boolean, permit_code string, permit_until timestamp_ntz, retry_after string, upload_busy boolean")
    now = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    got = {r["task_id"]: r for r in fetching.decide(tasks, preflight, robots, responses, now).collect()}
    assert {n: r["exit"] for n, r in got.items()} == {1: "source", 2: "arguments", 3: "arguments", 4: "arguments", 5: "source_state", 6: "policy", 7: "dead_letter"}
    assert got[5]["chain"] == ["source", "arguments", "preflight", "source_state"]
    assert fetching.decide(tasks.where("false"), preflight, robots, responses, now).collect() == []
