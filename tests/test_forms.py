"""Forms that hashes, guards and logs depend on: canonical JSON, addresses, secrets, placeholders, markup."""

import ipaddress
import json
import random

import pytest
from pyspark.sql import functions as F

from annalist.functions import hashing, markup, network, preserve, text


def test_canonical_text_tells_numbers_from_strings():
    assert hashing.canonical_text('{"a":"﷐1﷐"}') == '{"a":"﷐1﷐"}'
    assert hashing.canonical_text('{"b":1.50,"a":[1e2,-0.0,0.1E-3,12]}') == '{"a":[100,0,0.0001,12],"b":1.5}'
    seen = {hashing.canonical_text(json.dumps(d)) for d in ({"a": "1.5"}, {"a": 1.5}, {"a": "﷐1.5﷐"}, {"﷐1.5﷐": 1}, {"a": [1.5]}, {"a": None}, {"a": "null"}, {"a": True}, {"a": 1})}
    assert len(seen) == 9


@pytest.mark.parametrize("bad", ["1E999999999", "1e-999999999", "[" * 100_000 + "]" * 100_000, '{"a":NaN}', '{"é":1,"é":2}', '"\\ud800"', "{", "9" * 5_000])
def test_what_has_no_canonical_form(bad):
    with pytest.raises(ValueError):
        hashing.canonical_text(bad)


def test_canonical_json_of_repeated_and_missing_texts(spark):
    rows = spark.createDataFrame([(1, '{"b":1, "a":2}'), (2, None), (3, '{"b":1, "a":2}'), (4, "1E999999999"), (5, "[1.0]")], "n int, d string")
    assert [r[0] for r in rows.orderBy("n").select(hashing.canonical_json("d")).collect()] == ['{"a":2,"b":1}', None, '{"a":2,"b":1}', None, "[1]"]
    h = {r[0] for r in rows.where("n in (1, 3)").select(hashing.canonical_sha256(F.col("d"))).collect()}
    assert len(h) == 1


def by_properties(ip):
    """The same answer from the standard library's own properties."""
    if ip in map(ipaddress.ip_address, ("169.254.169.254", "fd00:ec2::254")):
        return "cloud metadata"
    if ip.version == 6:
        inner = ip.ipv4_mapped or ip.sixtofour or (ipaddress.IPv4Address(int(ip) % 2**32) if ip in ipaddress.ip_network("64:ff9b::/96") else None)
        if inner is not None and by_properties(inner):
            return f"embedded IPv4 {inner}: {by_properties(inner)}"
        if ip in ipaddress.ip_network("::/96"):
            return "IPv4-compatible IPv6"
        if ip.scope_id:
            return "scoped IPv6"
    kinds = {"unspecified": ip.is_unspecified, "loopback": ip.is_loopback, "link-local": ip.is_link_local, "multicast": ip.is_multicast, "private": ip.is_private, "reserved": ip.is_reserved, "not global": not ip.is_global}
    return next((k for k, hit in kinds.items() if hit), None)


def test_addresses_are_what_the_registries_say():
    draw, found = random.Random(1), []
    for table in (network.NETWORKS_4, network.NETWORKS_6, network.HOLDERS):
        for net in map(ipaddress.ip_network, table):
            ends = [int(net[0]), int(net[-1]), int(net[0]) - 1, int(net[-1]) + 1, *(draw.randint(int(net[0]), int(net[-1])) for _ in range(30))]
            found += [type(net[0])(n) for n in ends if 0 <= n < 2**net.max_prefixlen]
    inner = ["8.8.8.8", "10.0.0.1", "169.254.169.254", "100.64.0.1", "0.0.0.0"]
    found += [ipaddress.ip_address(p + a) for p in ("::ffff:", "64:ff9b::", "::") for a in inner]
    found += [ipaddress.IPv6Address(0x2002 << 112 | int(ipaddress.ip_address(a)) << 80) for a in inner]
    found += [ipaddress.ip_address(a) for a in ("fe80::1%eth0", "2001:4860::1%1", "fd00:ec2::254%1", "::ffff:10.0.0.1%2")]
    assert [(str(a), network.address_problem(a)) for a in found] == [(str(a), by_properties(a)) for a in found]


@pytest.mark.parametrize(("host", "want"), [("0x7f.1", "127.0.0.1"), ("017700000001", "127.0.0.1"), ("2130706433", "127.0.0.1"), ("10.1", "10.0.0.1"), ("[::1]", "::1"), ("a.example", None), ("1.2.3.x", None), ("", None), ("8.8.8.8", "8.8.8.8"), ("10.0.0.1.", "10.0.0.1")])
def test_numeric_hosts(host, want):
    found = network.literal_address(host)
    assert (None if found is None else str(found)) == want


@pytest.mark.parametrize(("host", "code"), [("1.2.3.4.5", "url_invalid"), ("256.1.1.1", "url_invalid"), ("08.1.1.1", "url_invalid"), ("1.2.3.4..", "url_invalid"), ("8.8.2056", "host_noncanonical_ip"), ("8.8.8.8.", "host_noncanonical_ip"), ("[::g]", "url_invalid"), ("a.b.c.1", "url_invalid")])
def test_refused_numeric_hosts(host, code):
    with pytest.raises(network.Refused, match=code):
        network.literal_address(host)


SECRETS = {
    "no secret at all": "no secret at all",
    "GET https://me:pw@h.example/x?a=1": "GET https://[redacted]@h.example/x?a=1",
    "https://h.example/p?x=a:b@c": "https://h.example/p?x=a:b@c",
    "https://user@h.example": "https://user@h.example",
    "ftp://a:b:c@h then https://d:@k": "ftp://[redacted]@h then https://[redacted]@k",
    "api_key=1&Token=abc&q=2#sig=9": "api_key=[redacted]&Token=[redacted]&q=2#sig=[redacted]",
    "password=a=b=c d=e": "password=[redacted] d=e",
    "secret==x y": "secret=[redacted] y",
    "token= x": "token= x",
    "token=": "token=",
    "my_token=x'y": "my_token=[redacted]'y",
    "a=b=token=z": "a=b=token=[redacted]",
    "": "",
}


def test_redact(spark):
    rows = spark.createDataFrame([(n, m) for n, m in enumerate(SECRETS)] + [(99, None)], "n int, m string")
    assert [r[0] for r in rows.orderBy("n").select(text.redact(F.col("m"))).collect()] == [*SECRETS.values(), None]


def test_placeholders_in_the_forms_that_come_back():
    given = 'a <x id="1"/> b <x  id="22"></x > <x id="3" > </x>c <x id=4/> <xid="5"/> <x id="6" / ><x <x id="7"/>'
    assert [(given[a:b], n) for a, b, n in preserve.placeholders(given)] == [('<x id="1"/>', 1), ('<x  id="22"></x >', 22), ('<x id="3" > </x>', 3), ('<x id="7"/>', 7)]
    assert preserve.replaced('<x id="1"/>-<x id="2"/>', {1: "one"}) == 'one-<x id="2"/>'


@pytest.mark.parametrize("many", [3, 300, 20_000])
def test_how_many_elements_are_open_changes_nothing(many):
    document = markup.read("<body><article lang='de'>" + "<div>" * many + "<p>drinnen</p></article><p>draussen</p><ul><li>a" + "<div>" * many + "<li>b</ul></body>")
    assert [(p.lang, p.text) for p in document.pieces if p.kind == "text"][:2] == [("de", "drinnen"), (None, "draussen")]
    assert [t.block for t in document.pieces if t.kind == "text"][2:] == ["li", "li"]


def test_pages_are_handed_on_in_parts(spark, monkeypatch):
    import pyarrow as pa

    from annalist.operators import translation

    rows = [(n, f"<p>one {n}</p><p>two</p>" if n % 5 else None) for n in range(40)]
    pages = spark.createDataFrame(rows, "n int, html string")
    whole = translation.reassemble(translation.pieces(pages, ["n"], "html"), ["n"], spark.createDataFrame([], "n int, pos int, translated string"))
    assert sorted(map(tuple, whole.collect())) == [r for r in rows if r[1]]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["n", "html"])
    names = ["n", "pos", "kind", "slot", "block", "lang", "html", "text", "root_lang", "unterminated"]
    text, number = pa.string(), pa.int32()
    types = [number, number, text, number, text, text, text, text, text, pa.bool_()]
    monkeypatch.setattr(translation, "HELD_ROWS", 10)
    sizes = [b.num_rows for b in translation._taken_apart(iter([batch]), names, types, None, ())]
    assert sum(sizes) == 32 * 5 and max(sizes) <= 15


def test_files_are_found_by_halving(spark):
    from annalist.operators import release

    rows = spark.range(5_000).select((F.col("id") % 2).alias("p"), F.when(F.col("id") % 97 > 0, F.col("id") * 7919 % 5_003).alias("k"))
    found = release.with_files(rows, ["p"], ["k"], 40)
    files = {}
    for r in found.collect():
        files.setdefault((r["p"], r["_file"]), []).append(-1 if r["k"] is None else r["k"])
    for part in (0, 1):
        spans = [(min(v), max(v)) for (p, _), v in sorted(files.items()) if p == part]
        assert len(spans) > 40 and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert "filter(_bounds" not in found._jdf.queryExecution().optimizedPlan().toString()
