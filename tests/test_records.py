"""Values that must come out exactly, and rules on small cases."""

import datetime as dt
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from annalist.functions import contacts, hashing, markup, network, preserve, text, url
from annalist.functions import time as times
from annalist.operators import contracts, quality, relational, release, resolution, temporal, translation
from annalist.sources import registry


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


# --- identity and canonical forms

@pytest.mark.parametrize(
    ("address", "attributes", "want"),
    [
        ("https://rozetka.com.ua/ua/123456789/p123456789/", {"brand": "Bosch", "mpn": "GSB 13 RE"}, "v1:7e5a69928ff65f3290963a234cbb56ee4ee0fc5b77f74987f6a8b43dba302f96"),
        ("https://rozetka.com.ua/ua/123456789/p123456789/", {"MPN ": "gsb  13 re", "Brand": " BOSCH"}, "v1:7e5a69928ff65f3290963a234cbb56ee4ee0fc5b77f74987f6a8b43dba302f96"),
        ("https://example.com/item/1", {"a": "", "b": None}, "v1:280a8a29771a5ee8e4b2a60874c87f0bf31a121b87ecd9cfb2702197a9ff8859"),
        ("https://auto.ria.com/uk/auto_toyota_camry_1.html", {"vin": "JTNBE46K", "модель": "Camry"}, "v1:1794c8510077a757a3d6355f464be6d1a84e9950f333c64500f28efe265f44fc"),
        ("https://x.example", {"Brand": "a", "brand": "b"}, None),
    ],
)
def test_identity_hashes(spark, address, attributes, want):
    df = spark.createDataFrame([(address, attributes)], "u string, a map<string, string>")
    assert df.select(hashing.identity_hash(F.col("u"), F.col("a")).alias("h")).first()["h"] == want


def test_keys_of_fetches_translations_and_segments(spark):
    at = F.to_timestamp(F.lit("2026-09-01 12:30:00"))
    assert one(spark, hashing.fetch_key(F.lit("news_ua_liga"), F.lit("https://liga.net/ua/news/1"), at, F.lit("default"))) == "c778395a138798e89d6b2a1c01a64371d3324f9758c161e6f69d723c38256d38"
    assert one(spark, hashing.translation_key(F.lit("55555555-5555-4555-8555-555555555555"), F.lit("UK"), F.lit("deepl"), F.lit("v2-2026-08"), F.lit("glossary-3"))) == "59c4c8b4258949ad249e5b3551fdba786e9fb2a608490d6c5b94a0b32a6a43ef"
    segment = hashing.segment_hash(F.lit('Der Stadtrat hat <x id="1"/> Euro beschlossen.'))
    assert one(spark, segment) == "258cdd6484a0c92e06bdd6484833dc92c6c91393d6a834906340527c0a567cbd"
    assert one(spark, hashing.memory_key(F.lit("de"), F.lit("uk"), segment, F.lit("google-cloud-translation-v3"), F.lit("nmt"), F.lit("0" * 64))) == "2c7ddfa1ecf8b0b7fc8e3c6b68f0fb7a53bdc6703c3fc00fe7341e4863d73e7f"


@pytest.mark.parametrize(
    ("given", "want"),
    [('{"b": 1.50, "a": [1, 2.0, 1e3, -0.0]}', '{"a":[1,2,1000,0],"b":1.5}'), ('{"é": "é"}', '{"é":"é"}'), ('{"é": 1, "é": 2}', None), ("[NaN]", None), ("{", None), ('"\\ud800"', None), (None, None), ('{"n": null, "t": true}', '{"n":null,"t":true}')],
)
def test_canonical_json(spark, given, want):
    assert one(spark, hashing.canonical_json(F.lit(given).cast("string"))) == want


def test_flat_json_escapes_as_canonical_json_does(spark):
    odd = ["a\"b\\c/d", "\x1f\x0b\x01\n\t\x7f", "\\u001F \\\\u000B", "\u2028é😀", "", None]
    df = spark.createDataFrame([(v,) for v in odd], "v string")
    assert [r["j"] for r in df.select(hashing.flat_json(k=F.col("v")).alias("j")).collect()] == [json.dumps({"k": v}, separators=(",", ":"), ensure_ascii=False) for v in odd]


def test_canonical_json_does_not_depend_on_order(spark):
    rng = random.Random(1)
    for _ in range(20):
        items = [(rng.choice("abcdé") * rng.randint(1, 3) + str(n), rng.choice([None, True, n, "x", [n, {"q": n}]])) for n in range(8)]
        first, second = json.dumps(dict(items)), json.dumps(dict(rng.sample(items, len(items))), indent=1)
        assert hashing.canonical_text(first) == hashing.canonical_text(second) == json.dumps(dict(items), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_bounds_of_nested_documents(spark):
    deep = "1"
    for _ in range(9):
        deep = f'{{"k":{deep}}}'
    cases = {'{"a": [1]}': None, "[1]": "$: object", "{": "$: json", deep: "$.k.k.k.k.k.k.k.k: depth", json.dumps({"a": list(range(257))}): "$.a: items", json.dumps({"a": "x" * 65_537}): "$.a: characters", json.dumps({"a": 2**63}): "$.a: integer", json.dumps({"k" * 257: 1}): "$: key_characters"}
    df = spark.createDataFrame([(k,) for k in cases], "d string")
    assert {r["d"]: r["v"] for r in df.select("d", hashing.unbounded(F.col("d")).alias("v")).collect()} == cases


def test_events_round_trip(spark):
    df = spark.createDataFrame([('{"b": 2, "a": "x"}',), (json.dumps({"a": "y" * 300_000}),)], "e string")
    small, large = df.select(hashing.encoded_event(F.col("e"), "application/json").alias("v")).collect()
    assert bytes(small["v"]["bytes"]) == b'{"a":"x","b":2}' and not small["v"]["too_large"] and large["v"]["too_large"] and large["v"]["bytes"] is None
    assert one(spark, hashing.decoded_event(F.lit(bytes(small["v"]["bytes"])), "a string, b int")) == ("x", 2)


def test_upserts_of_repeated_and_null_keys(spark):
    target = spark.createDataFrame([(1, "a", 1), (None, "n", 4)], "k int, v string, revision long")
    incoming = spark.createDataFrame([(1, "b"), (1, "c"), (2, "x"), (2, None), (None, "n"), (None, "m")], "k int, v string")
    got = {r["k"]: (r["v"], r["revision"]) for r in relational.upsert_distinct(target, incoming, ["k"], ["v"]).collect()}
    assert got == {1: ("c", 2), 2: ("x", 1), None: ("n", 4)}
    rows = spark.createDataFrame([(None, "y", 1), (3, "z", 1)], "k int, v string, revision long")
    once = relational.insert_if_absent(target, rows, ["k"], "v")
    assert once.count() == relational.insert_if_absent(once, rows, ["k"], "v").count() == 3


def test_uuid7_keeps_the_order_of_many_of_a_millisecond(spark):
    ids = [r[0] for r in spark.range(0, 40_000, 7).orderBy("id").select(hashing.uuid7(F.timestamp_seconds(F.lit(1_700_000_000)), F.col("id"), F.col("id"))).collect()]
    assert ids == sorted(ids) and len(set(ids)) == len(ids)
    assert all(len(i) == 36 and i[14] == "7" and i[19] in "89ab" for i in ids)


def test_uuid7_grows_and_tells_its_time(spark):
    at = dt.datetime(2026, 9, 1, 12, 30, 0, 123000)
    df = spark.createDataFrame([(at, n) for n in range(50)], "t timestamp, n int").select("n", hashing.uuid7(F.col("t"), F.col("n"), F.col("n")).alias("id"))
    ids = [r["id"] for r in df.orderBy("n").collect()]
    assert ids == sorted(ids) and len(set(ids)) == 50
    assert df.select(hashing.is_uuid(F.col("id"), 7).alias("v"), hashing.uuid7_time(F.col("id")).alias("t")).distinct().collect() == [(True, at)]


def test_small_forms(spark):
    assert one(spark, hashing.decimal_text(F.lit("1.500").cast("decimal(10,3)"))) == "1.5" and one(spark, hashing.decimal_text(F.lit("-0.00").cast("decimal(5,2)"))) == "0"
    assert one(spark, hashing.parse_key(F.lit("a"), F.lit("b"))) == __import__("hashlib").sha256("a\u001fb".encode()).hexdigest()
    for raw, want in {"1.234,5": "1234.5", "1 234,5": "1234.5", "1,234.5": "1234.5", "1,234": "1234", "3,5": "3.5", "−7": "-7", "1'234'567": "1234567"}.items():
        assert one(spark, text.normalize_number(F.lit(raw))) == want == preserve.canonical_number(raw)
    assert one(spark, text.attribute_text(F.lit(" Straße  X "))) == "strasse x" and one(spark, text.shortened(F.lit("x" * 3000))) == "x" * 2047 + "…"


# --- URLs, hosts, contacts

@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("HTTPS://Example.COM:443/A?b=2&utm_source=x&a=1#f", "https://example.com/A?b=2&a=1"),
        ("http://example.com:8080", "http://example.com:8080/"),
        ("https://example.com/?a=1&&b=2&", "https://example.com/?a=1&b=2"),
        ("https://example.com/?FBCLID=1", "https://example.com/"),
        ("https://bücher.example/ü?q=ü", "https://xn--bcher-kva.example/ü?q=ü"),
        ("https://me:pw@example.com/", None),
        ("not a url", None),
        ("https://[::1]:443/x", "https://[::1]/x"),
        ("https://under_score.example/", "https://under_score.example/"),
    ],
)
def test_urls(spark, raw, want):
    assert one(spark, url.normalize(url.ascii_hosts(F.lit(raw)))) == want


def test_guards(spark):
    hosts = {"localhost": "ssrf_forbidden_host", "a.localhost": "ssrf_forbidden_host", "example.com.": "ssrf_forbidden_host", "example.com": None, "127.0.0.1": "ssrf_forbidden_address", "2130706433": "ssrf_forbidden_address", "0x7f.1": "ssrf_forbidden_address", "8.8.8.8": None, "134744072": "host_noncanonical_ip", "1.2.3.999": "url_invalid", "[::ffff:10.0.0.1]": "ssrf_forbidden_address", "[64:ff9b::a00:1]": "ssrf_forbidden_address", "[2606:4700::1111]": None, "169.254.169.254": "ssrf_forbidden_address", "1.2.3.4.5": "url_invalid", "08.1.1.1": "url_invalid"}
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    assert {r["h"]: r["c"] for r in df.select("h", network.host_guard(F.col("h"))["code"].alias("c")).collect()} == hosts
    pinned = spark.createDataFrame([("a.example", ["93.184.216.34", "10.0.0.1"]), ("b.example", ["93.184.216.34"]), ("c.example", [])], "h string, a array<string>").select(network.pinned(F.col("h"), F.col("a")).alias("p"))
    assert [tuple(r["p"]) for r in pinned.collect()] == [(None, "ssrf_forbidden_address"), ("93.184.216.34", None), (None, "dns_error")]
    assert one(spark, url.guard(F.lit("https://x.example:8443/"), ports=(8443,))) is None and one(spark, url.guard(F.lit("https://x.example:8444/"), ports=(8443,))) == "port_forbidden"


def test_contacts(spark):
    cases = [("phone", "067 123-45-67", "+380671234567"), ("phone", "+48 600 700 800", "+48600700800"), ("phone", "0048600700800", "+48600700800"), ("phone", "12", None), ("phone", "+38067", None), ("email", " Anna.B@Example.COM ", "anna.b@example.com"), ("email", "a@bücher.example", "a@xn--bcher-kva.example"), ("email", "a b@c.d", None), ("email", "@c.d", None), ("url", " é ", "é"), ("other", "  ", None)]
    df = spark.createDataFrame(cases, "kind string, raw string, want string")
    assert df.where(~contacts.contact(F.col("kind"), F.col("raw")).eqNullSafe(F.col("want"))).collect() == []


def test_retry_after_dates(spark):
    now = F.lit("2026-01-01 00:00:00").cast("timestamp")
    for value, want in {"Thu, 01 Jan 2026 00:02:00 GMT": 120, "Wed, 31 Dec 2025 23:00:00 GMT": 600, "²": 600, "-5": 600, "3": 5, "999999999999": 86_400, "": 600}.items():
        assert one(spark, times.retry_after_seconds(F.lit(value), now)) == want
    assert one(spark, times.retry_plan(F.lit("retryable"), F.lit(2), F.lit(None).cast("long"), F.lit(1.0))) == (True, 36.0, False)


# --- history

def test_long_history_of_one_entity_is_linear(spark):
    versions = spark.range(40_000).select(F.lit(1).alias("entity"), F.col("id").alias("version"), F.timestamp_seconds(F.col("id") * 7 % 39_989).cast("timestamp_ntz").alias("effective_at"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ingested_at"))
    temporal.intervals(versions).write.format("noop").mode("overwrite").save()
    began = time.perf_counter()
    temporal.intervals(versions).write.format("noop").mode("overwrite").save()
    assert time.perf_counter() - began < 2


def test_folds_against_plain_ones(spark):
    rng = random.Random(2)
    rows = [(rng.randint(0, 5), rng.randint(0, 400_000), rng.choice("aab"), n) for n in range(1500)]
    df = spark.createDataFrame(rows, "e long, t long, h string, n long").select("e", F.timestamp_seconds("t").cast("timestamp_ntz").alias("at"), "h", "n")
    want, last = set(), {}
    for e, t, h, _ in sorted(rows):
        before = last.get(e)
        if before is None or before[1] != h or t - before[0] >= 3600:
            want.add((e, t, h, "changed" if before is None or before[1] != h else "heartbeat"))
            last[e] = (t, h)
    got = temporal.heartbeat_observations(df, entity="e", at="at", state_hash="h", heartbeat_seconds=3600)
    assert {(r["e"], int(r["at"].replace(tzinfo=dt.UTC).timestamp()), r["h"], r["reason"]) for r in got.collect()} == want
    granted, bucket = {}, {}
    for e, t, _, n in sorted(rows, key=lambda r: (r[0], r[1], r[3])):
        was, tokens = bucket.get(e, (t, 20_000))
        tokens = min(20_000, tokens + (t - was) * 3)
        granted[n] = tokens >= 10_000
        bucket[e] = t, tokens - 10_000 * granted[n]
    found = relational.token_bucket(df, origin="e", at="at", tie="n", capacity=2, per_second=0.0003)
    assert {r["n"]: r["granted"] for r in found.collect()} == granted and set(granted.values()) == {True, False}


# --- resolution

def decisions(*rows):
    return [(f"d{n}", a, list(m), g) for n, (a, m, g) in enumerate(rows)]


def test_a_block_forbids_later_merges_and_leaves_groups():
    groups, held, pairs = resolution.replay(decisions(("merge", "ab", "g"), ("manual_block", "ab", None)))
    assert groups == {"g": {"a", "b"}} and held == [] and pairs == {("a", "b")}
    groups, held, _ = resolution.replay(decisions(("manual_block", "ab", None), ("merge", "ab", "g"), ("merge", "ac", "h"), ("merge", "cb", "i"), ("manual_link", "ab", "j")))
    assert held == ["d1", "d3"] and groups == {"j": {"a", "b", "c"}}
    groups, _, _ = resolution.replay(decisions(("merge", "ab", "g"), ("merge", "bc", "h"), ("unmerge", "a", None), ("reject", "bc", None)))
    assert groups == {"h": {"b", "c"}}


def test_supersession():
    assert resolution.effective({"a": None, "b": "a", "c": "b"}) == {"a", "c"}
    assert resolution.effective({"b": "missing"}) == {"b"}
    assert resolution.effective({"a": None, "b": "a", "c": "a", "x": "b"}) == {"x", "c"}
    with pytest.raises(ValueError, match="circle"):
        resolution.effective({"a": "b", "b": "a"})


def test_snapshot_replays_parts_as_one_replay_of_all(spark):
    rng = random.Random(3)
    rows = []
    for n in range(300):
        action = rng.choice(["merge", "merge", "merge", "manual_link", "manual_block", "unmerge", "reject"])
        members = rng.sample([f"m{rng.randint(0, 60)}_{k}" for k in range(4)], rng.randint(2, 3))
        at = dt.datetime(2026, 1, 1) + dt.timedelta(minutes=rng.randint(0, 500))
        rows.append((f"d{n:03d}", 1, action, members, f"g{rng.randint(0, 40)}", at, at, f"d{rng.randint(0, n):03d}" if n and rng.random() < 0.1 and rng.randint(0, n) != n else None))
    rows = [(*r[:7], None if r[7] == r[0] else r[7]) for r in rows]
    df = spark.createDataFrame(rows, "decision_id string, decision_version int, action string, members array<string>, group_id string, effective_at timestamp, recorded_at timestamp, supersedes string")
    counts = resolution.effective({r[0]: r[7] for r in rows})
    groups, held, pairs = resolution.replay([(r[0], r[2], r[3], r[4]) for r in sorted(rows, key=lambda r: (r[5], r[6], r[1], r[0])) if r[0] in counts])
    got = {(r["kind"], r["id"], r["other"]) for r in resolution.snapshot(df).collect()}
    assert {x for x in got if x[0] == "group"} == {("group", g, m) for g, ms in groups.items() for m in ms}
    assert {x[1] for x in got if x[0] == "skipped"} == set(held) and {(x[1], x[2]) for x in got if x[0] == "blocked"} == pairs
    assert {x[1] for x in got if x[0] == "applied"} == counts - set(held)


def test_replay_of_many_merges_is_linear():
    began = time.perf_counter()
    resolution.replay((str(n), "merge", [f"a{n}", f"b{n}"], f"g{n}") for n in range(20_000))
    assert time.perf_counter() - began < 0.68


# --- markup, masking, translation

@pytest.mark.parametrize(("raw", "kind"), [("1.234,5", "number"), ("1 234,5", "number"), ("1,234.5", "number"), ("05.03.2024", "date"), ("2024-03-05", "date"), ("2,4 %", "number"), ("€ 49", "number"), ("120 zł", "number"), ("9 500 Ft", "number")])
def test_protected_spans(raw, kind):
    masked = preserve.mask_html(raw)
    assert masked["masked"] == '<x id="1"/>' and [p["kind"] for p in masked["placeholders"]] == [kind]


def test_masks_survive_and_come_back(spark):
    source = '<b>Bus 5</b>: see https://en.example/Bus_(V), or (www.x.example). Mail a.b@c.example! &lt;x id="1"/&gt; COVID-19 10–15'
    masked = preserve.mask_html(source)
    assert preserve.unmask_html(masked["masked"], masked["placeholders"]) == source and preserve.broken(masked, source, masked["masked"]) == []
    assert [p["source"] for p in masked["placeholders"] if p["kind"] in ("url", "email")] == ["https://en.example/Bus_(V)", "www.x.example", "a.b@c.example"]
    df = spark.createDataFrame([(source,), (None,)], "s string").withColumn("m", preserve.mask(F.col("s")))
    rows = df.select("s", preserve.unmask(F.col("m.masked"), F.col("m")).alias("back"), preserve.issues(F.col("s"), F.col("m"), F.col("m.masked")).alias("i")).collect()
    assert rows[0]["back"] == source and rows[0]["i"] == [] and rows[1]["back"] is None and rows[1]["i"] is None


def test_what_a_translation_breaks():
    source = "<b>5 km</b> and <i>mail a@b.example</i> at https://x.example"
    masked = preserve.mask_html(source)
    say = lambda s: preserve.broken(masked, source, s)
    good = masked["masked"]
    assert say(good.replace('<x id="2"/>', "")) == ["placeholder_missing", "number_mismatch"]
    assert say(good + ' <x id="2"/>') == ["placeholder_duplicated", "number_mismatch"]
    assert say(good + '<x id="99"/>') == ["placeholder_unknown", "tag_mismatch"]
    assert say(good.replace('<x id="1"/>', "@").replace('<x id="3"/>', '<x id="1"/>').replace("@", '<x id="3"/>')) == ["tag_order_broken"]
    assert say(good + " 7") == ["number_mismatch"] and say(good + " www.y.example") == ["url_mismatch"] and say(good + " c@d.example") == ["email_mismatch"]
    glossed = preserve.mask_html("G7 in Kyiv", {"G7": "Велика сімка", "Kyiv": "Київ"})
    assert preserve.unmask_html(glossed["masked"], glossed["placeholders"]) == "Велика сімка in Київ" and preserve.broken(glossed, "G7 in Kyiv", glossed["masked"]) == []


PAGE = """<html lang="de"><head><title>x 1</title></head><body><h1>Titel eins</h1><p>Der <a href="/a?b=1&amp;c=2"><b>Plan</b></a> kostet 5 Euro.<br>Mehr Text</p>
<ul><li>eins<li>zwei <ol><li>drei</ol></ul><pre>code 1</pre><p>Siehe <code>make x</code> und <span translate="no">Name</span> hier.</p>
<table><tr><td>a 1<td lang="en">cell text</table><script>var a = "</p>";</script><img alt="Ein Bild" src="i.png"><p> 5 </p><!-- c --></body></html>"""


def test_segments_of_a_page():
    found = markup.read(PAGE, ("alt",))
    got = [(p.block, p.html) for p in found.pieces if p.kind == "text"]
    assert ("h1", "Titel eins") in got and ("p", 'Der <a href="/a?b=1&amp;c=2"><b>Plan</b></a> kostet 5 Euro.<br>Mehr Text') in got
    assert [b for b in got if b[0] == "li"] == [("li", "eins"), ("li", "zwei"), ("li", "drei")] and ("td", "a 1") in got and ("td", "cell text") in got
    assert ("p", 'Siehe <code>make x</code> und <span translate="no">Name</span> hier.') in got and not any("code 1" in h or "var a" in h for _, h in got)
    assert found.root_lang == "de" and [p.lang for p in found.pieces if p.html == "cell text"] == ["en"] and [s.text for s in found.slots] == ["Ein Bild"]
    assert markup.join(found, {}) == PAGE
    texts = sum(p.kind == "text" for p in found.pieces)
    assert 'alt="&quot;Z&quot;"' in markup.join(found, {texts: '"Z"'})


def test_long_blocks_are_divided_after_sentences():
    sentence = "Das ist ein ziemlich langer Satz über den Verkehr in der Stadt."
    source = "<p>" + " ".join([sentence] * 6) + " <b>Ende. Aus</b> des Absatzes.</p>"
    assert len([p for p in markup.read(source).pieces if p.kind == "text"]) == 1
    parts = [p for p in markup.read(source, limit=150).pieces if p.kind == "text"]
    assert len(parts) > 1 and all(len(p.text) <= 150 for p in parts) and parts[-1].html.endswith("<b>Ende. Aus</b> des Absatzes.")
    assert markup.join(markup.read(source, limit=150), {}) == source


@pytest.mark.parametrize("source", ["<div>" * 50_000 + "x" + "</div>" * 50_000, "<p>" + "&amp;" * 80_000 + "</p>", "<" * 50_000, "<!--" * 20_000, "<a " + "x='" * 10_000, "<b>" * 30_000 + "x"])
def test_hostile_markup(source):
    began = time.perf_counter()
    assert markup.join(markup.read(source), {}) == source
    assert time.perf_counter() - began < 3


@pytest.mark.parametrize("source", [" ".join(map(str, range(8000))), "a@" * 30_000, "a" * 20_000, "http://x.y/" + "(" * 20_000 + ")" * 20_000, "1." * 30_000, "<x" * 20_000, '<x id="1"/>' * 5000])
def test_hostile_masks(source):
    began = time.perf_counter()
    masked = preserve.mask_html(source)
    preserve.broken(masked, source, masked["masked"])
    assert time.perf_counter() - began < 3


def test_pieces_and_reassembly(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, ""), (3, None), (4, "plain 1 <b>x")], "page_id long, html string")
    parts = translation.pieces(pages, ["page_id"], "html", translated=("alt",))
    none = spark.createDataFrame([], "page_id long, pos int, translated string")
    assert {r["page_id"]: r["html"] for r in translation.reassemble(parts, ["page_id"], none).collect()} == {1: PAGE, 4: "plain 1 <b>x"}
    new = parts.where("kind <> 'literal'").select("page_id", "pos", F.concat(F.lit("T"), F.when(F.col("kind") == "text", F.col("html")).otherwise(F.col("text"))).alias("translated"))
    out = {r["page_id"]: r["html"] for r in translation.reassemble(parts, ["page_id"], new).collect()}
    assert "<h1>TTitel eins</h1>" in out[1] and 'alt="TEin Bild"' in out[1] and out[4] == "Tplain 1 <b>x"


def ranking(c):
    return F.when(F.contains(c, F.lit("der")), F.array(F.struct(F.lit("de").alias("language"), F.lit(0.9).alias("confidence")))).when(F.contains(c, F.lit("тут")), F.array(F.struct(F.lit("uk").alias("language"), F.lit(0.9).alias("confidence")))).otherwise(F.array(F.struct(F.lit("xx").alias("language"), F.lit(0.9).alias("confidence"))))


def test_articles_through_plan_memory_and_translator(spark):
    long = "der Stadtrat hat heute 5 Euro beschlossen und geht"
    rows = [
        (1, "full", "de", "Kurz 1", None, f"<p>{long}</p><p>{long}</p>"),
        (2, "full", "uk", "Тут", None, "<p>тут написано достатньо довгий текст українською</p>"),
        (3, "metadata_only", "de", "Kurz 1", "der Vorspann hat 7 lange Worte und noch mehr davon", "<p>never read</p>"),
        (4, "full", None, None, None, "<p>completely unknown words that say nothing here</p>"),
        (5, "full", "de", "Bad 3", None, "<pre>open"),
    ]
    articles = spark.createDataFrame(rows, "article_id long, access string, declared string, title string, lead string, body_html string")
    planned = translation.plan(articles, ranking, ["de", "en"])
    memory = translation.jobs(planned, provider="p", model="m", glossary_version="g").where("html = 'Kurz 1'").select("key", F.concat(F.lit("М "), "m.masked").alias("translated_text"))
    calls = []

    def translator(todo):
        calls.append(todo.count())
        return todo.select("key", F.when(F.col("masked").startswith("Bad"), "lost").otherwise(F.concat(F.lit("П "), "masked")).alias("translated_text"))

    outcome, entries = translation.execute(planned, memory, translator, provider="p", model="m", glossary_version="g")
    got = {r["article_id"]: r.asDict() for r in outcome.collect()}
    assert calls == [3]  # one long text twice, the lead, and the bad one
    assert got[1]["complete"] and got[1]["title"] == "М Kurz 1" and got[1]["body_html"] == f"<p>П {long}</p><p>П {long}</p>" and got[1]["memory_hits"] == 1 and got[1]["provider_segments"] == 1
    assert got[2]["not_required"] and got[2]["complete"] and got[2]["body_html"] is None
    assert got[3]["complete"] and got[3]["lead"].startswith("П der Vorspann") and got[3]["body_html"] is None
    assert not got[4]["complete"] and got[4]["quality_flags"] == ["language_unsupported"]
    assert not got[5]["complete"] and got[5]["quality_flags"] == ["preservation_failed", "untranslated_content"]
    assert entries.count() == 2


def test_articles_with_attributes_and_what_stays(spark):
    body = '<html lang="de"><p>der erste Satz steht hier ganz allein</p><img alt="der &lt;Titel&gt; eines schönen Bildes"><p lang="uk">тут лишається</p><script>der</script></html>'
    rows = [(1, "full", None, "der Titel ist & bleibt ein langer Titel", "der Vorspann ist auch ein langer Satz", body), (2, "full", None, " ", None, "<p>der Satz kommt nicht zurück, wie schade</p>"), (3, "full", "de", "", None, None), (None, "full", "de", "der Titel ohne Nummer", None, None)]
    articles = spark.createDataFrame(rows, "article_id long, access string, declared string, title string, lead string, body_html string")
    planned = translation.kept(translation.plan(articles, ranking, ["de", "en"], translated=("alt",)))
    translator = lambda todo: todo.where("masked not like '%zurück%'").select("key", F.concat(F.lit("П "), "masked").alias("translated_text"))
    memory = spark.createDataFrame([], "key string, translated_text string")
    outcome, entries = translation.execute(planned, memory, translator, provider="p", model="m", glossary_version="g", stored=True)
    got = {r["article_id"]: r.asDict() for r in outcome.collect()}
    assert sorted(got) == [1, 2] and got[1]["complete"] and got[1]["provider_segments"] == 4
    assert (got[1]["title"], got[1]["lead"]) == ("П der Titel ist & bleibt ein langer Titel", "П der Vorspann ist auch ein langer Satz")
    assert got[1]["body_html"] == body.replace("der erste", "П der erste").replace('alt="der', 'alt="П der')
    assert not got[2]["complete"] and got[2]["quality_flags"] == ["provider_truncated"] and got[2]["body_html"] is None
    again, none = translation.execute(planned, entries.select("key", "translated_text"), translator, provider="p", model="m", glossary_version="g", stored=True)
    assert none.count() == 0 and {(r["article_id"], r["body_html"], r["memory_hits"]) for r in again.collect()} == {(1, got[1]["body_html"], 4), (2, None, 0)}


def test_articles_are_stored_about_once(spark):
    """What is kept of articles on their way, the second translation and the memory included, in times of what they take."""
    import os
    from pathlib import Path

    from annalist.plans import records
    from annalist.sources import scratch

    size = lambda path: sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))
    sf, before, setting = "/root/testdata/sf0.01", set(scratch._tables), spark.conf.get(scratch._SHUFFLES_END)
    records.translation_outcome(spark, sf)
    assert spark.conf.get(scratch._SHUFFLES_END) == setting
    tables = [size(t) for t in set(scratch._tables) - before if "-profiles-" not in t]
    assert 0 < sum(tables) < 3 * os.path.getsize(f"{sf}/documents.parquet")


def test_languages_of_articles_and_segments(spark):
    pair = lambda *kv: F.array(*[F.struct(F.lit(k).alias("language"), F.lit(v).alias("confidence")) for k, v in kv])
    none = F.lit(None).cast("string")
    article = lambda d, r, rank, t="long text": tuple(one(spark, text.article_language(d, r, F.lit(t), rank, ["de", "hr", "nl"])))
    assert article(F.lit("de-AT"), F.lit("fr"), pair(("en", 0.9)))[:3] == ("de", 1.0, "metadata") and article(none, F.lit("HR"), pair(("en", 0.9)))[2] == "lang_attribute"
    assert article(none, none, pair(("hr", 0.45), ("bs", 0.4), ("de", 0.05))) == ("hr", 0.9, "classifier", False, "hr")
    assert article(none, none, pair(("af", 0.6), ("nl", 0.35))) == ("nl", 0.35, "classifier", True, "af")
    assert article(none, none, pair(("ja", 0.9))) == ("ja", 0.9, "classifier", False, "ja") and article(none, none, pair(("ja", 0.9)), " ")[2] == "none"


def test_glossaries_and_registries(spark, tmp_path):
    data = {"schema": 1, "target_language": "uk", "pairs": {"de": [{"term": " G7 ", "target": "Велика сімка"}, {"term": "BMW", "keep": True}], "*": []}}
    version, terms = registry.glossary(data)
    assert terms["de"] == {"G7": "Велика сімка", "BMW": "BMW"} and registry.glossary({**data, "extra": 1})[0] == version
    for bad in ([{"term": "a", "keep": True, "target": "b"}], [{"term": "a"}], [{"term": "a", "keep": True}, {"term": " a", "keep": True}]):
        with pytest.raises(ValueError, match="de"):
            registry.glossary({**data, "pairs": {"de": bad}})
    path = tmp_path / "sources.json"
    path.write_text(json.dumps({"sources": [{"id": "news_a", "kind": "news", "country": "UA", "name": "A", "domains": ["a.example"], "rating": 90, "research": "free", "more": 1}, {"id": "b", "kind": "news", "country": "u", "name": "", "domains": [], "rating": 101, "research": "x"}]}))
    sources = registry.source_registry(spark, str(path))
    assert quality.split(sources, contracts.registry_entry())[1].first()["violations"] == ["country", "domains", "id", "name", "rating"]
    assert registry.unknown_sources(spark.createDataFrame([("news_a",), ("c",)], "source_id string"), sources).collect() == [("c",)]


def test_bodies_with_limits(spark):
    import gzip
    import zlib

    bomb = gzip.compress(b"\0" * 3_000_000)
    rows = [(1, gzip.compress(b"hello"), "gzip"), (2, zlib.compress(gzip.compress(b"both")), "gzip, deflate"), (3, bomb, "gzip"), (4, b"x" * 5000, None), (5, gzip.compress(b"cut")[:-3], "gzip"), (6, None, "gzip"), (7, b"a", "br")]
    got = {r["k"]: (r["data"] and bytes(r["data"]), r["error"]) for r in registry.decoded_bodies(spark.createDataFrame(rows, "k int, body binary, content_encoding string"), max_bytes=4_000_000, max_ratio=100).collect()}
    assert got[1] == (b"hello", None) and got[2] == (b"both", None) and got[3] == (None, "decompression_bomb") and got[4][1] is None and got[5][1] == got[7][1] == "content_decoding_error" and got[6] == (None, None)


def test_feeds(spark):
    rss = "<rss><channel><title>c</title><item><title>A &amp; B</title><link>https://x.example/1</link><pubDate>d</pubDate></item><item><title>no link</title></item></channel></rss>"
    atom = '<feed><entry><title>T</title><link rel="alternate" href="https://x.example/2?a=1&amp;b=2"/><updated>u</updated></entry></feed>'
    site = "<urlset><url><loc> https://x.example/3 </loc><lastmod>m</lastmod></url></urlset>"
    got = registry.feed_items(spark.createDataFrame([("r", rss), ("a", atom), ("s", site), ("n", None), ("x", "text")], "source_id string, body string")).collect()
    assert sorted(map(tuple, got)) == [("a", "item", "https://x.example/2?a=1&b=2", "T", "u", None), ("r", "item", "https://x.example/1", "A & B", "d", None), ("s", "url", "https://x.example/3", None, "m", None)]


# --- releases and manifests

def test_release_round_trip(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 3).alias("p"), "id", F.timestamp_seconds("id").alias("t"))
    path = str(tmp_path / "release")
    release.write_release(df, path, ["p"], ["id"], "t")
    assert release.verify_release(spark, path, ["p"], "t").count() == 0
    other = str(tmp_path / "other")
    release.write_release(df.withColumn("id", F.when(F.col("id") == 7, 8).otherwise(F.col("id"))), other, ["p"], ["id"], "t")
    spark.read.parquet(f"{path}/manifest").write.mode("overwrite").parquet(f"{other}/manifest")
    assert [r["p"] for r in release.verify_release(spark, other, ["p"], "t").collect()] == ["1"]
    assert {r["row_count"] for r in spark.read.parquet(f"{path}/manifest").collect()} == {33, 34}
    registry.write_jsonl(df, str(tmp_path / "j"), ["id"])
    assert spark.read.json(str(tmp_path / "j/manifest")).agg(F.sum("row_count")).first()[0] == 100


def test_manifest_updates(spark):
    schema = "release_id string, state string, parts int, superseding_release_id string"
    before = spark.createDataFrame([("a", "published", 1, None), ("b", "published", 1, None), ("c", "draft", 1, None), ("d", "superseded", 1, "x"), ("e", "draft", 1, None)], schema)
    after = spark.createDataFrame([("a", "superseded", 1, "y"), ("b", "published", 2, None), ("c", "building", 3, None), ("d", "superseded", 1, "z"), ("e", "published", 1, None)], schema)
    assert {r["release_id"]: r["allowed"] for r in contracts.manifest_update(before, after).collect()} == {"a": True, "b": False, "c": True, "d": False, "e": False}
    rows = [("r", "v1", "published", "abcdef0", None, "h", None, None, "q", None, None, None, None, None, None), ("r", "v 1", "draft", "xyz", "i", "h", [("s", "1", "")], None, "q", "q", None, "r", "now", [1], None)]
    columns = "release_id string, tag string, state string, git_commit string, entity_versions string, partition_index_sha256 string, excluded_sources array<struct<source_id:string,policy_version:string,reason:string>>, degraded_sources array<struct<source_id:string,policy_version:string,reason:string>>, quality_report string, quality_report_artifact string, reconciliation_result string, superseding_release_id string, published_at string, parts array<int>, reconciliation_result_artifact string"
    got = quality.split(spark.createDataFrame(rows, columns), contracts.release_manifest())[1].collect()
    assert got[0]["violations"] == ["evidence"] and got[1]["violations"] == ["commit", "entities", "published_at", "reasons", "reports", "superseding", "tag"]


def test_rules_on_small_records(spark):
    def broken(rules, **values):
        df = spark.range(1).select(*[v.alias(k) if hasattr(v, "alias") else F.lit(v).alias(k) for k, v in values.items()])
        return [v for r in quality.split(df, rules)[1].collect() for v in r["violations"]]

    sha, uid, none = "a" * 64, "55555555-5555-4555-8555-555555555555", F.lit(None).cast("string")
    assert broken(contracts.money(), amount_minor=5, currency="EUR") == [] and broken(contracts.money(), amount_minor=F.lit(None).cast("int"), currency="eur") == ["amount", "currency"]
    assert broken(contracts.measured_value(), value=1.5, unit="", raw_value="1,5") == ["unit"]
    assert broken(contracts.raw_artifact(), http_status=99, requested_url="u", final_url="", sha256=sha, fetch_id=uid) == ["final", "status"]
    assert broken(contracts.upload_claim(), object_key="k", owner="o", status="lost", claim_generation=0, lease_expires_at=none) == ["generation", "lease", "status"]
    assert broken(contracts.lineage(), fetch_id=uid, raw_sha256=sha, parser_version="1", projection_task_id="x") == ["task"]
    assert broken(contracts.source_time(), source_time_precision="week", source_time_inferred=True, source_locale_raw="x" * 65) == ["locale", "precision"]
    assert broken(contracts.effective_time(), basis="observed", inferred=False) == ["inferred"]
    snapshot = {"core": '{"a":1}', "attributes": "{}", "latest_state": "[]", "state_hash": "v1:0"}
    assert broken(contracts.version_snapshot(), **snapshot) == ["latest_state", "state_hash"]
    right = one(spark, hashing.state_hash(F.lit('{"a": 1}'), F.lit("{}"), F.lit("{}")))
    document = {"core": '{"a":1}', "attributes": "{}", "latest_state": "{}", "state_hash": right, "schema_version": "2.0", "projection_version": 1, "first_seen_at": 2, "last_seen_at": 1}
    assert broken(contracts.current_document(), **document) == ["schema", "seen"]
    assert broken(contracts.payload_matches_artifact({"news_article": ("news",)}), entity_uuid="a", artifact_entity_uuid="b", schema_version="1.0", artifact_schema_version="1.0", entity_kind="news_article", artifact_domain="cars") == ["domain", "entity"]
    assert broken(contracts.projection_command(), entity_uuid="a", artifact_entity_uuid="a", projection_version=0, priority=101) == ["priority", "version"]
    assert broken(contracts.observed_values(), amount_minor=5, currency=none, availability="", values="{") == ["availability", "price", "values"]
    assert broken(contracts.contact_observation(), contacts=F.array(), projection_version=1, projection_task_id="a", lineage_task_id="b") == ["contacts", "lineage_task"]
    assert broken(contracts.review_question(), record_kind="rumour", content_version="") == ["content_version", "kind"]
    assert broken(contracts.normalized_url(), original="x", normalized="https://a.example/?utm_x=1") == ["tracking"]
    assert broken(contracts.audit_context(), actor="", reason="r", correlation_id="1") == ["actor", "correlation"]
    assert broken(contracts.entity_version_ref(), entity_uuid="1", projection_version=0) == ["entity", "version"]
    assert broken({**contracts.release_watermark(), **contracts.source_inclusion(), **contracts.component_versions()}, snapshot_at=none, postgres_snapshot="1", source_id="", policy_version="1", parser_version="1", normalizer_version="1", matcher_version="1", resolution_version="") == ["resolution_version", "snapshot_at", "source"]


def test_receipts(spark):
    schema = "projection_task_id string, entity_uuid string, projection_version int, target_collection string, document_id string, applied_to_current boolean, state_changed boolean, result_version int, result_hash string, event_id string, event_bytes binary, event_sha256 string, event_artifact_sha256 string"
    rows = [("t1", "e", 1, "c", "d", True, True, 1, "h", "ev", b"x", None, "big"), ("t2", "e", 2, "c", "d", True, False, 2, "h", None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    assert contracts.acknowledgement(df, F.lit("now")).orderBy("projection_task_id").first()["event_sha256"] == "big"
    assert sorted(r["table"] for r in contracts.event_rows(df).collect()) == ["changes", "outbox"]
    assert [r["projection_task_id"] for r in contracts.same_receipt(df, df.withColumn("result_hash", F.when(F.col("projection_task_id") == "t2", "other").otherwise(F.col("result_hash")))).collect()] == ["t2"]


def test_claims_and_sweeps(spark):
    now = F.lit("2026-01-01 00:00:00").cast("timestamp")
    claims = spark.createDataFrame([("a", "leased", 2, "2026-01-02"), ("b", "leased", 1, "2026-01-02"), ("c", "leased", 2, "2025-01-02"), ("d", "released", 2, "2026-01-02")], "object_key string, status string, claim_generation int, lease string").withColumn("lease_expires_at", F.col("lease").cast("timestamp"))
    assert {r["object_key"] for r in relational.can_commit(claims, now, F.lit(2)).where("can_commit").collect()} == {"a"}
    swept = relational.swept(spark.createDataFrame([("a",), ("z",)], "object_key string"), claims.where("object_key = 'a'"))
    assert {tuple(r) for r in swept.collect()} == {("a", "skipped"), ("z", "deleted")}


def test_parsed_artifacts(spark):
    df = spark.createDataFrame([(1, "news", '{"a": 1}'), (2, "news", "{"), (3, "cars", "{}")], "k int, kind string, content string")
    good, bad = registry.parsed(df, {"news": "3"}, "a int")
    assert [(r["k"], r["record"]["a"], r["parser_version"]) for r in good.collect()] == [(1, 1, "3")]
    assert {r["k"]: r["error"] for r in bad.collect()} == {2: "malformed", 3: "no_parser"}


def test_objects_and_buckets(spark, tmp_path):
    from annalist.sources import tables

    (tmp_path / "o").mkdir()
    for name, data in (("a", b"1"), ("b", b"2"), ("c", b"x" * 100)):
        (tmp_path / "o" / name).write_bytes(data)
    path = f"file:{tmp_path}/o"
    sha = lambda d: __import__("hashlib").sha256(d).hexdigest()
    expected = spark.createDataFrame([(f"{path}/a", sha(b"1")), (f"{path}/b", sha(b"1")), (f"{path}/c", sha(b"x" * 100))], "path string, sha256 string")
    assert {r["path"][-1]: r["status"] for r in tables.verified_objects(spark, path, expected, 50).collect()} == {"a": "ok", "b": "mismatch", "c": "too_large"}
    left = tables.bucketed(spark.range(100).withColumnRenamed("id", "k"), "left_side", "k", 4)
    right = tables.bucketed(spark.range(50).withColumnRenamed("id", "k"), "right_side", "k", 4)
    joined = left.hint("merge").join(right, "k")
    assert joined.count() == 50 and "Exchange hashpartitioning(k" not in joined._jdf.queryExecution().executedPlan().toString()


def test_ledgers_are_appended_once(spark, tmp_path):
    from annalist.operators import ledger

    path = str(tmp_path / "audit")
    rows = spark.createDataFrame([(1, "late", 2), (1, "early", 1), (2, "x", 5)], "k int, v string, t int").withColumn("at", F.timestamp_seconds("t"))
    ledger.append_once(spark, path, rows, ["k"], "t", month_of="at")
    ledger.append_once(spark, path, rows.withColumn("k", F.col("k") + 1), ["k"], "t", month_of="at")
    assert {(r["k"], r["v"]) for r in ledger.ledger_rows(spark, path).collect()} == {(1, "early"), (2, "x"), (3, "x")}
    objects = spark.createDataFrame([("a", b"1"), ("b", b"2")], "key string, content binary")
    store = str(tmp_path / "store")
    assert {r["result"] for r in ledger.put_objects(spark, store, objects).collect()} == {"new"}
    again = spark.createDataFrame([("a", b"1"), ("b", b"3"), ("c", b"4")], "key string, content binary")
    assert {r["key"]: r["result"] for r in ledger.put_objects(spark, store, again).collect()} == {"a": "verified", "b": "mismatch", "c": "new"}
    assert ledger.ledger_rows(spark, store).count() == 3
    assert ledger.object_heads(spark, f"{store}/epoch=1/rows/*.parquet").columns == ["path", "length", "modificationTime"]


def test_compaction_keeps_what_is_needed(spark, tmp_path):
    from annalist.operators import ledger

    versions = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 1, 1), (3, 1, 1), (3, 2, 9)], "entity int, version int, t int").withColumn("ingested_at", F.timestamp_seconds("t")).drop("t")
    pins = spark.createDataFrame([(1, 2)], "entity int, version int")
    stay, go = ledger.compacted(versions, pins, F.timestamp_seconds(F.lit(5)))
    assert {(r["entity"], r["version"]) for r in go.collect()} == {(1, 1), (3, 1)} and stay.count() == 4
    locators = ledger.archive(go, str(tmp_path / "archive"), ["entity"], "ingested_at")
    assert {(r["entity"], r["version"]) for r in locators.collect()} == {(1, 1), (3, 1)}


def test_components_of_chains_and_stars(spark):
    from annalist.operators.graph import components

    edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("s0", f"s{i}") for i in range(1, 30)] + [("x", "x"), ("y", None)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert {got[f"n{i:03d}"] for i in range(61)} == {"n000"} and {got[f"s{i}"] for i in range(30)} == {"s0"} and got["x"] == "x" and "y" not in got


def test_axes_are_combined(spark):
    at = lambda n: dt.datetime(2026, 1, 1) + dt.timedelta(hours=n)
    source = spark.createDataFrame([(1, at(1), None, False), (2, at(5), None, True)], "k int, source_event_at timestamp_ntz, source_updated_at timestamp_ntz, source_time_inferred boolean")
    system = spark.createDataFrame([(1, at(4), at(5), at(6)), (2, at(4), at(5), at(4))], "k int, observed_at timestamp_ntz, fetched_at timestamp_ntz, ingested_at timestamp_ntz")
    both = contracts.combined(source, system, "k").orderBy("k").collect()
    assert [r["violations"] for r in both] == [[], ["event_is_fetch", "ingested_before_fetched"]]
    derived = contracts.derived_time(source.join(system, "k")).orderBy("k").first()["effective"]
    assert tuple(derived) == (at(1), "source_event", False)
    joined = source.withColumn("s", F.struct("source_event_at", "source_updated_at", "source_time_inferred")).join(system.withColumn("y", F.struct("observed_at", "fetched_at", "ingested_at")), "k")
    assert joined.select(times.entity_time(F.col("s"), F.col("y")).alias("t")).first()["t"].asDict()["ingested_at"] in (at(6), at(4))
    record = source.join(system, "k").where("k = 1").withColumn("core", F.lit("[]")).withColumn("attributes", F.lit("{}")).withColumn("latest_state", F.lit("{}"))
    assert quality.split(record, contracts.payload())[1].first()["violations"] == ["core"]


def test_terms_and_groups_as_tables(spark, tmp_path):
    path = tmp_path / "terms.json"
    path.write_text(json.dumps({"schema": 1, "target_language": "uk", "pairs": {"de": [{"term": "BMW", "keep": True}]}}))
    version, terms = registry.load_glossary(str(path))
    assert len(version) == 64 and [tuple(r) for r in registry.glossary_terms(spark, terms).collect()] == [("de", 0, "BMW", "BMW")]
    groups = spark.createDataFrame([("g", "a")], "group_id string, member string")
    assert {tuple(r) for r in resolution.group_of(groups, spark.createDataFrame([("a",), ("b",)], "m string"), "m").collect()} == {("a", "g"), ("b", None)}
