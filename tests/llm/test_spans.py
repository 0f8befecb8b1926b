"""Secrets and personal data against the contract's patterns."""

from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larkspur.llm import pii, registry, secrets
from larkspur.llm.common import new_path

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base_secrets(t):
    out = [("assign", m.start(), m.end()) for m in re.finditer(ASSIGN, t, re.I | re.A) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], secrets.BASE_KINDS.index(s[0])))


def base_pii(t):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, lo, hi in (("card", r"[0-9]([\x20-]?[0-9])+", 14, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 10, 15)):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            if lo <= len(d) <= hi and (kind == "phone" or pii.luhn(d)):
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pii.BASE_KINDS.index(s[0])))


def of(spans, kinds):
    return [s for s in spans if s[0] in kinds]


PIECES = st.lists(st.sampled_from(["a", "@", ".", "b.c", "+1", " ", "555", "(7)", "-", "256", "1.2.3.4", "4111111111111111", "secret", "TOKEN", ":", "=", "'", "abcdef", "0123456789abcdef", "AKIA", "ABCDEFGHIJKLMNOP", "api_key", "\n", "é", "://", "x:y@"]), max_size=14).map("".join)


@given(PIECES)
@settings(max_examples=600, deadline=None)
def test_base_spans(text):
    assert of(secrets.find(text), secrets.BASE_KINDS) == base_secrets(text)
    assert of(pii.find(text), pii.BASE_KINDS) == base_pii(text)


@pytest.mark.parametrize("text, kind, part", [
    ("see http://bob:pw@h.example/", "login", "bob:pw"), ("IBAN: DE89 3704 0044 0532 0130 00.", "iban", "DE89 3704 0044 0532 0130 00"), ("Account no: 12345678", "account", "12345678"),
])
def test_more_pii(text, kind, part):
    assert [text[a:b] for k, a, b in pii.find(text) if k == kind] == [part]


@pytest.mark.parametrize("text, kinds", [
    ("0" * 5000 + ".1.1.1", ["ip"]), ("1" * 5000 + ".1.1.1", []), ("1.1.1." + "0" * 5000 + "9", ["ip"]), ("4" * 5000, []), ("+" + "1" * 5000, []), ("a" * 5000 + "@b.co", ["email"]),
    ("account: " + "1" * 5000, ["account"]), ("iban " + "DE12" * 2000, []), ("x@" * 20_000, []), ("1.1.1." * 20_000, None), ("://a:" * 20_000, []),
])
def test_long_runs(text, kinds):
    got = [s[0] for s in pii.find(text)]
    assert kinds is None or got == kinds


@pytest.mark.parametrize("text", ["eyJaaaaa" * 40_000, "token" + " " * 200_000, "://" + "a" * 200_000, "-----BEGIN " * 20_000, "password: " * 20_000, "AKIA" * 40_000, "gh" + "p_" * 80_000])
def test_secrets_of_long_runs_take_linear_time(text):
    import time

    began = time.process_time()
    secrets.find(text)
    assert time.process_time() - began < 3


def test_web_token():
    token = "eyJhbGciOi.eyJzdWIiOi.abcdefghij"
    assert [s[0] for s in secrets.find(f"x {token} y")] == ["jwt"] and not secrets.find(f"x{token}")


def test_invalid_iban():
    assert not of(pii.find("IBAN: DE00 3704 0044 0532 0130 00"), ("iban",))


def test_masked():
    t = "mail a@b.co or +1 555 555 5555"
    assert pii.masked(t, pii.find(t)) == "mail [EMAIL] or [PHONE]"
    assert pii.masked("x", []) == "x"


def test_mask_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "a@b.co", "s"), (None, None, None), (1, "", "t")], "doc_id long, text string, spans string")
    got = sorted((tuple(r) for r in pii.mask(df).collect()), key=str)
    assert got == sorted([(1, "[EMAIL]", "s"), (None, None, None), (1, "", "t")], key=str)
    assert pii.spans_of(df.limit(0)).count() == 0 and pii.spans_of(df).count() == 3


def test_queries(spark, sf):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for query, base, kinds in ((registry.op3_secret_ledger, base_secrets, secrets.BASE_KINDS), (registry.op7_pii_anchors, base_pii, pii.BASE_KINDS)):
        got = {r.doc_id: r for r in query(spark, sf).collect()}
        assert set(got) == set(texts)
        for i, t in texts.items():
            spans = base(t)
            assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
            assert all(got[i][f"n_{k}"] == sum(s[0] == k for s in spans) for k in kinds)


def test_ledger_scans_only_what_is_new(spark):
    ledger = new_path(spark, "ledger")
    one = spark.createDataFrame([(1, "secret=abcdefg"), (2, "secret=abcdefg"), (None, None), (3, "")], "doc_id long, text string")
    first = secrets.scan(one, ledger)
    assert first.count() == 4
    rows = lambda: sorted(bytes(r.blob) for r in secrets.read_ledger(spark, ledger, secrets.rule_version(secrets.RULES)).collect())
    assert len(rows()) == 2
    secrets.scan(one, ledger)
    assert len(rows()) == 2
    two = one.union(spark.createDataFrame([(4, "token: 12345678"), (4, "secret=abcdefg")], "doc_id long, text string"))
    found = secrets.scan(two, ledger)
    assert len(rows()) == 3
    assert sorted((r.doc_id or 0, [s.kind for s in r.spans]) for r in found.collect()) == [(0, []), (1, ["assign"]), (2, ["assign"]), (3, []), (4, ["assign"]), (4, ["assign"])]
    secrets.scan(one, ledger, rules=secrets.BASE_RULES)  # another rule version is scanned anew
    assert len(secrets.read_ledger(spark, ledger, secrets.rule_version(secrets.BASE_RULES)).collect()) == 2
    assert secrets.scan(one.limit(0), new_path(spark, "ledger")).count() == 0
