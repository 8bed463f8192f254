import hashlib
import random
import re

import numpy as np

from turnstone.llm import pii


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def number(m):
    return re.sub("[^0-9]", "", m)


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(number(m)) <= 19 and luhn(number(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(number(m)) <= 15),
]
TEXTS = [
    None, "", "a@b.c.d@e.f and a@b.c_d@e.f x..y@z.com", "1.2.3.4.5.6.7.8 and 300.1.1.1 or 001.02.003.255", "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111",
    "+1 (555) 010-9999 +12 +1234567890123456789", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ok', "é" * 5 + " mail é@x.com \u0001 q@r.st\u0002", "x" * 20000 + "@", "1" * 5000, "nothing to see",
]


def test_base_matches_plain_patterns(spark):
    frame = spark.createDataFrame([(i, t, "c") for i, t in enumerate(TEXTS)], "doc_id long, text string, pii string")
    found = pii.find_pii(frame)
    assert found.columns == ["doc_id", "text", "pii", "_pii"]
    for r in pii.digest(found, into="_pii").collect():
        text = TEXTS[r.doc_id] or ""
        spans = sorted((m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(BASE) for m in re.finditer(p, text) if ok(m.group()))
        joined = ",".join(f"{n}:{a}:{b}" for a, _, b, n in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), text[:40]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
        if "token" in text:
            assert r.spans == "secret:9:49"
        if "nothing" in text:
            assert r.spans == ""


def test_redaction_and_empty(spark):
    frame = spark.createDataFrame([(1, "write to ann@x.org now"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(pii.find_pii(frame)).collect()}
    assert got == {1: "write to <email> now", 2: None}
    assert pii.find_pii(frame.limit(0)).count() == 0


def test_random_texts_match_plain_patterns(spark):
    r = random.Random(9)
    pool = [*"0123456789", *"0123456789", *"ab@.-+() ", "..", "@x.", " +1", "4111 1111 1111 1111", "255.", "a@b.c", "\n", "é", "_"]
    texts = ["".join(r.choice(pool) for _ in range(r.randint(0, 40))) for _ in range(6000)]
    found = pii.digest(pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()
    for row in found:
        spans = sorted((m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(BASE) for m in re.finditer(p, texts[row.doc_id]) if ok(m.group()))
        joined = ",".join(f"{n}:{a}:{b}" for a, _, b, n in spans)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), texts[row.doc_id]
        assert row.n_spans == len(row.spans.split(",")) if row.spans else row.n_spans == 0


def spans_of(spark, texts):
    rows = pii.digest(pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()
    return [r.spans for r in sorted(rows, key=lambda r: r.doc_id)]


def test_long_values_are_found_whole(spark):
    r = random.Random(1)
    key = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    texts = [f'token = "{key(320)}" end', f"see {key(240)} here", "mail ann@example[dot]com or ann@example dot com", "mail ann at mail dot example dot com now", "pay with 4556 7375 8689 9855 or 6011000990139424"]
    got = spans_of(spark, texts)
    assert got[0] == "secret:9:329" and got[1] == "secret:4:244"
    assert got[2] == "address:5:24,address:28:47" and got[3] == "address:5:36"
    assert "secret" not in got[4]


def test_thresholds_are_calibrated_for_each_kind(spark):
    trees, thresholds = pii.trained(spark)
    assert len(trees) == pii.TREES and len(set(thresholds)) == 3 and all(np.isfinite(thresholds)) and 0.0 not in thresholds
    held = pii.calibration_lines(600, seed=123)
    rows = pii.find_pii(spark.createDataFrame([(i, *x) for i, x in enumerate(held)], "doc_id long, text string, a int, b int")).collect()
    hit = [any(s.start < x.b and x.a < s.end for s in x.pii) for x in rows]
    good = [x.b > 0 for x in rows]
    assert sum(h and g for h, g in zip(hit, good, strict=True)) >= 0.9 * sum(good) and sum(h and not g for h, g in zip(hit, good, strict=True)) <= 0.05 * sum(hit)


def test_calibration():
    score, y = np.array([3.0, 2.0, 1.0, -1.0]), np.array([1.0, 1.0, 0.0, 0.0])
    assert pii.calibrate(score, y) == 1.5 and pii.calibrate(score[:2], y[:2]) == 2.0 and pii.calibrate(score, y * 0) == float("inf")


def test_many_matches_and_repeated_rows(spark):
    text = "a@b.cd 10.0.0.1 " * 6000
    frame = spark.createDataFrame([(1, text), (1, text), (None, "a@b.cd")], "doc_id long, text string")
    rows = pii.digest(pii.find_pii(frame)).collect()
    assert [(r.n_email, r.n_ip) for r in rows if r.doc_id == 1] == [(6000, 6000)] * 2 and [r.n_email for r in rows if r.doc_id is None] == [1]
    assert rows[0].spans.startswith("email:0:6,ip:7:15,email:16:22")
