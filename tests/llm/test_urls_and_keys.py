"""Templates of urls without labels, deep paths, and structures that look like keys but aren't."""

from __future__ import annotations

import base64

import pytest

from walloom.llm import queries, secret_scan, url_templates


def der(tag: int, *parts: bytes) -> bytes:
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else bytes([0x80 | len(n := len(body).to_bytes(-(-len(body).bit_length() // 8), "big"))]) + n
    return bytes([tag]) + size + body


def oid(text: str) -> bytes:
    return der(6, bytes.fromhex(text))


def test_verdicts_differ_among_pages_without_a_rule(spark):
    found = queries.op9_url_filter(spark, "/root/testdata/sf0.01").where("rule is null")
    assert {r["verdict"] for r in found.select("verdict").distinct().collect()} == {"allow", "block"}


def test_what_has_no_label_is_allowed(spark):
    pages = [(1, "http://good.org/x"), (2, None), (3, "no url"), *((10 + k, f"http://bad.net/es/{k}x") for k in range(30)), (50, "http://bad.net/de/x"), *((60 + k, f"http://fine.org/es/{k}") for k in range(30))]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_templates.judge(spark.createDataFrame(pages, "page_id long, url string")).collect()}
    assert got[1] == got[2] == got[3] == (None, "allow") and got[10] == ("net/es/", "block") and got[50] == (None, "block") and got[60] == (None, "allow")


def test_deep_paths_are_passed_in_one_step(spark):
    rules = (url_templates.Rule("block", "deep.org/" + "a/" * 3000 + "b"), url_templates.Rule("allow", "deep.org/" + "a/" * 3000 + "c"))
    urls = ["http://deep.org/" + "a/" * 3000 + "bcd"[k % 3] + "xy"[k % 2] for k in range(60)]
    got = url_templates.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules=rules).collect()
    by = {r["path"][6001]: r["verdict"] for r in got}
    assert by["b"] == "block" and by["c"] == "allow" and len(got) == 60


CASES = {
    "digest": (der(0x30, der(0x30, oid("608648016503040201"), b"\x05\x00"), der(4, bytes(range(32)))), False),
    "digest without parameters": (der(0x30, der(0x30, oid("608648016503040201")), der(4, bytes(range(32)))), False),
    "encrypted by PBES2": (der(0x30, der(0x30, oid("2a864886f70d01050d"), der(0x30, der(0x30, oid("2a864886f70d01050c")))), der(4, bytes(64))), True),
    "encrypted by a scheme of containers": (der(0x30, der(0x30, oid("2a864886f70d010c0103"), der(0x30, der(4, bytes(8)), der(2, b"\x10"))), der(4, bytes(64))), True),
    "container": (der(0x30, der(2, b"\x03"), der(0x30, oid("2a864886f70d010701"), der(0xA0, der(4, bytes(90)))), der(0x30, der(0x30, der(0x30, oid("2b0e03021a")), der(4, bytes(20))), der(4, bytes(8)))), True),
    "container of something else": (der(0x30, der(2, b"\x03"), der(0x30, oid("2a864886f70d010703"), der(0xA0, der(4, bytes(90))))), False),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_structures_with_and_without_a_key(spark, name):
    data, key = CASES[name]
    text = f"see {base64.b64encode(data).decode()} there"
    assert secret_scan.private_der(data) is key
    assert any(s["kind"] == secret_scan.KINDS[4] for s in secret_scan.spans(text)) is key


def test_depth_of_nesting_has_no_limit():
    data = der(4, b"x" * 20)
    for _ in range(100):
        data = der(0x30, data)
    assert secret_scan.nested(data)
