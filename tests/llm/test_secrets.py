from __future__ import annotations

import random
import re

from sitefacts.llm import secrets

PATTERNS = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 0, 20),
    "hex": (r"[0-9a-f]+", 0, 0, 24),
}


def brute(text):
    return sorted(
        (m.start(), list(PATTERNS).index(kind), m.end())
        for kind, (pattern, flags, group, least) in PATTERNS.items()
        for m in re.finditer(pattern, text, flags)
        if len(m.group(group)) >= least
    )


def spans_of(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, spans string")
    return {r["doc_id"]: [(s["start"], s["stop"], s["kind"]) for s in r["spans"]] for r in secrets.scan(docs).collect()}


def test_base_spans_match_the_definition(spark):
    random.seed(5)
    parts = ["token", "TOKEN", "api_key", "apikey", "Passwd", ":", "=", '"', "'", " ", "AKIA", "ABCD1234EFGH5678", "0a1b2c3d4e5f",
             "ſecret", "abcdef", "\U0001f600", "é", "\n", "x", "token=token:abcdefgh", "0" * 24]
    texts = [None, "", *("".join(random.choices(parts, k=random.randint(1, 25))) for _ in range(600))]
    found = spans_of(spark, texts)
    for i, text in enumerate(texts):
        strong = [(s, secrets.KINDS.index(k), e) for s, e, k in found[i] if k in PATTERNS]
        assert strong == brute(text or ""), text


def kinds(text):
    return [k for _, _, k in secrets.find_spans(text)]


def test_weak_parts_need_a_complement():
    value = "x9Kq2LmZ8vT4bN7cR1pW"
    assert kinds(f"value {value} alone") == []
    assert kinds("see https://api.example.org/v1 for help") == []
    assert kinds(f"user_name: ada.b and {value}") == ["weak_id", "weak_secret"]
    assert kinds(f"{value} goes to https://api.example.org/v1") == ["weak_secret", "endpoint"]
    assert kinds("user_name: ada.b at https://api.example.org/v1") == []  # no secret
    assert kinds(f"user_name: ada.b\n \n{value}") == []  # another paragraph
    assert kinds("user_name: ada.b " + "w " * 300 + value) == []  # out of reach
    assert kinds("user_name: ada.b token = abcdef123") == ["weak_id", "assign"]


def test_joined_parts_against_all_pairs():
    random.seed(8)
    for _ in range(200):
        text = "".join(random.choice(["\n\n", "abcdefghij" * 3]) for _ in range(30))
        parts = sorted({(s := random.randrange(len(text)), s + 5, random.choice(secrets.KINDS)) for _ in range(12)})
        bounds = [0, *(m.end() for m in secrets.PARAGRAPH.finditer(text)), len(text) + 1]
        expected = []
        for s, e, k in parts:
            low = max(b for b in bounds if b <= s)
            high = min(b for b in bounds if b > s)
            expected.append(any(
                secrets.ROLE[k2] in secrets.COMPLEMENTS[secrets.ROLE[k]] and s2 < min(e + 20, high) and e2 > max(s - 20, low)
                for s2, e2, k2 in parts
            ))
        assert secrets.joined_parts(text, parts, 20).tolist() == expected


def test_repeated_null_and_long(spark):
    long_text = "filler " * 50_000 + "token = abcdefgh"
    docs = spark.createDataFrame([(None, long_text), (1, "a"), (1, "a")], "doc_id bigint, text string")
    rows = secrets.scan(docs).collect()
    assert len(rows) == 3 and sum(len(r["spans"]) for r in rows) == 1
    assert secrets.scan(docs.limit(0)).count() == 0


def test_a_long_key_does_not_part_its_neighbours():
    random.seed(3)
    pieces = [" ".join("".join(random.choices("abcdefghijkmnpqrstuvwxyz23456789", k=60)) + "Q7" for _ in range(28)) for _ in range(2)]
    assert len(pieces[0]) > 1_700
    text = f"password = hunter2hunter2 {pieces[0]} login: ada.b\n\nhttps://api.example.org/v1 {'A' * 300} x9Kq2LmZ8vT4bN7cR1pW"
    assert kinds(text)[0] == "assign" and kinds(text)[-1] == "weak_id" and "endpoint" not in kinds(text)  # the As are no part
    parts = [(0, 5, "weak_id"), (10, 1_800, "assign"), (1_700, 1_900, "hex"), (1_910, 1_930, "endpoint")]
    short, moved = secrets.squeezed("." * 2_000, parts)
    assert moved == [(0, 1, "weak_id"), (6, 7, "assign"), (6, 7, "hex"), (17, 18, "endpoint")] and len(short) == 88
    # only the parts between the secret and the endpoint make them far from each other
    ids = " ".join(f"user_name: {'n' * 60}{i}" for i in range(10))
    assert "endpoint" in kinds(f"x9Kq2LmZ8vT4bN7cR1pW {ids} https://api.example.org/v1")


def test_names_of_identifiers_in_either_case():
    for name in ("CLIENT_ID=", "DB_USERNAME=", "ACCESS_ID=", "Login: ", "Account: "):
        assert kinds(f"{name}ada.b password = hunter2hunter2") == ["weak_id", "assign"], name
    assert kinds("akia0123456789ab password = hunter2hunter2") == ["assign"]
