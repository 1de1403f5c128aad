"""Entropy windows beside base spans and placeholder words of one candidate."""

from __future__ import annotations

import math
import random
import re

from rivulet.llm import secret_scan as s


def base_spans(text):
    return [(m.start(), m.end()) for kind, pattern in (("assign", s.ASSIGN), ("access", s.ACCESS), ("hex", s.HEX))
            for m in re.finditer(pattern, text) if kind != "assign" or len(m.group(2)) >= s.ASSIGN_VALUE]


def hot_places(text):
    """Places in hot windows that meet no base span and no placeholder word."""
    out = set()
    for letters, bits in s.CLASSES:
        for m in re.finditer(f"{letters}{{{s.WINDOW},}}", text):
            if any(re.search(p, m.group()) for p in s.ALLOWED if p[0] == "^"):
                continue
            taken = base_spans(text) + [(m.start() + w.start(), m.start() + w.end())
                                        for p in s.ALLOWED if p[0] != "^" for w in re.finditer(p, m.group())]
            for a in range(m.start(), m.end() - s.WINDOW + 1):
                part = text[a:a + s.WINDOW]
                h = -sum(part.count(c) / s.WINDOW * math.log2(part.count(c) / s.WINDOW) for c in set(part))
                if h >= bits and not any(x < a + s.WINDOW and a < y for x, y in taken):
                    out |= set(range(a, a + s.WINDOW))
    return out


def test_rest_of_a_candidate_is_scanned(spark):
    draw = random.Random(11)
    letters = "ABCDEFGHJKabcdefghjkmnpqrstuvwxyz0123456789+/"

    def key(n):
        return "".join(draw.choice(letters) for _ in range(n))

    texts = ["x9Kd82hsLq0P2mZv7Tn4/token=abcdefgh12", "/sample/9f8Gk2Lq0P2mZv7Tn4Xw1Bq8", key(900) + "xXxX" + key(900),
             f"{key(30)}DUMMYdummy{key(19)}sample{key(21)}", "a/example/b", f"example{key(40)}example",
             f"é {key(25)}0123456789{key(25)} token={key(12)}", f"AKIA{'Z' * 14}{key(30).lower()}", "é" * 5 + key(40),
             "a1b2c3d4e5f60718293a4b5c" + "deadbeef" * 5]
    texts += ["".join(draw.choice([key(8), key(22), "sample", "/", "token=", " ", "AKIA" + "Q" * 12, "abcdefgh"])
                      for _ in range(12)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id: [x for x in r.spans if x.kind == 3] for r in s.find_secrets(df).collect()}
    for i, text in enumerate(texts):
        assert {p for x in found[i] for p in range(x.start, x.end)} == hot_places(text), text
    assert [(x.start, x.end) for x in found[0]] == [(0, 21)]
    assert found[1] and min(x.start for x in found[1]) == 7
    clean = {r.doc_id: r.text for r in s.redact(df).collect()}
    assert clean[0] == "[SECRET]" and clean[1] == "/sample[SECRET]"
