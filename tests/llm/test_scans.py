"""Secrets and personal data against plain patterns, and edge rows."""

import hashlib
import math
import random
import re
from collections import Counter

from passerine.llm import pii, secret_scan

PIECES = ["@", "a", "b.c", "@x.", "1", "12", "256", ".", "1.2.3.4", " ", "-", "4111111111111111", "+", "(", "+1 555 123", "4736962573099581", "é", "%", "token", "='", "=", "PassWord", "AKIA", "ABCDEF0123456789", "abcdef12", "ſecret", "api_key:"]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (2 if k % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(text):
    return re.sub("[^0-9]", "", text)


def plain_pii(t):
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x.lstrip("0") or "0") <= 255 if len(x.lstrip("0")) < 4 else False for x in m.group().split("."))]
    out += [(m.start(), m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits_of(m.group())) <= 19 and luhn(digits_of(m.group()))]
    return out + [(m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits_of(m.group())) <= 15]


def plain_secrets(t):
    words = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_key", "apikey"))
    out = [(m.start(), m.end(), "assign") for m in re.finditer(rf"""(?:{words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m.group(1)) >= 8]
    out += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 16]
    out += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 32]
    return sorted(out, key=lambda s: (s[0], secret_scan.KINDS.index(s[2])))


def random_texts(n):
    draw = random.Random(3)
    return ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 14))) for _ in range(n)]


def test_base_spans_equal_plain_patterns():
    for t in random_texts(8000):
        assert pii.base_spans(t) == plain_pii(t), t
        assert secret_scan.base_spans(t) == plain_secrets(t), t


def test_added_spans_keep_base_spans_and_meet_none():
    for t in random_texts(3000):
        base, every = secret_scan.all_spans(t)
        assert set(base) <= set(every)
        assert not any(k == "entropy" and a < e and s < b for a, b, k in every for s, e, _ in base)
        base, every = pii.all_spans(t)
        assert set(base) <= {s[:3] for s in every}


def test_windows_equal_entropy_of_every_window():
    draw = random.Random(5)
    for _ in range(200):
        text = "".join(draw.choice("abcdefgh0123"[: draw.randint(1, 12)]) for _ in range(draw.randint(0, 60)))
        inside = set()
        for k in range(len(text) - 9):
            part = Counter(text[k : k + 10])
            if -sum(n / 10 * math.log2(n / 10) for n in part.values()) >= 2.5:
                inside |= set(range(k, k + 10))
        assert {k for a, b in secret_scan.high_windows(text, 10, 2.5) for k in range(a, b)} == inside


def test_entropy_finds_bare_secrets_and_allows_the_harmless():
    secret = "x9Kq2LmZ7vRt4WpB8nYc3HdF6sGj"
    assert secret_scan.all_spans(f"see {secret} there")[1] == [(4, 4 + len(secret), "entropy")]
    for harmless in ("123e4567-e89b-12d3-a456-426614174000", "some-long-name-of-a-thing-2024", "2024-01-31_2024-02-28/0001", "Internationalization" * 2, "AAAAAAAAAAAAAAAAAAAAAAAAAAAAAA", "EXAMPLEx9Kq2LmZ7vRt4WpB8nYc3HdF6", "-" * 5000 + "x1"):
        assert secret_scan.all_spans(harmless)[1] == [], harmless


def test_candidates_shorter_than_the_window_are_scored():
    draw = random.Random(7)
    alphabets = {"hex": "0123456789abcdefABCDEF", "alnum": "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "base64": "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"}
    seen = Counter()
    for _ in range(6000):
        text = "".join(draw.choice(alphabets[draw.choice(list(alphabets))][: draw.choice((3, 8, 70))]) for _ in range(draw.randint(19, 25)))
        if draw.random() < 0.7:
            own = alphabets[draw.choice(list(alphabets))]
            text = "".join(draw.choice(own) for _ in range(draw.randint(19, 25)))
        inside = set()
        if len(text) >= 20 and not text.isalpha() and not secret_scan.is_allowed(text):
            name = next(n for n, a in alphabets.items() if set(text) <= set(a))
            full, least = {"hex": (24, 3.0), "alnum": (20, 3.6), "base64": (24, 4.0)}[name]
            size = min(full, len(text))
            for k in range(len(text) - size + 1):
                part = Counter(text[k : k + size])
                if -sum(n / size * math.log2(n / size) for n in part.values()) >= least * math.log(size) / math.log(full) - 1e-9:
                    inside |= set(range(k, k + size))
            seen[name, len(text)] += bool(inside)
        assert {k for a, b in secret_scan.entropy_spans(f"a {text} b") for k in range(a - 2, b - 2)} == inside, text
    assert all(seen[name, n] for name in alphabets for n in range(20, 25))
    for secret in ("x9Kq-LmZ7vRt4WpB8nYc3H", "Zk3_vT8qLw1xRb5mNc7YdQ", "9F3aC07e1bD2845f6a0E", "7f3ac91e0bd2845f6ae0c"):
        assert secret_scan.all_spans(f"see {secret} there")[1] == [(4, 4 + len(secret), "entropy")], secret


def test_checksums_and_context():
    iban = "DE89 3704 0044 0532 0130 00"
    assert [s[2] for s in pii.all_spans(f"account {iban} now")[1]] == ["iban"]
    assert pii.all_spans("account DE88 3704 0044 0532 0130 00 now")[1] == []
    assert [s[2] for s in pii.all_spans("call 555-123-4567 today")[1]] == ["local_phone"]
    assert pii.all_spans("the thing 555-123-4567 today")[1] == []
    near, far = pii.all_spans("mail me: a@b.example")[1][0][3], pii.all_spans("xx a@b.com")[1][0][3]
    assert near != far or near == 1.0


def test_long_inputs_are_linear():
    for big in ("a" * 300_000 + "@", "1" * 300_000, "@a." * 100_000, "+1" * 100_000, "1 " * 200_000, "token" * 50_000 + "=" * 50_000):
        pii.all_spans(big), secret_scan.all_spans(big)


def test_edge_rows(docs, edge_rows):
    none = hashlib.sha256(b"").hexdigest()
    for find, columns in ((secret_scan.scan, ("n_assign", "n_access", "n_hex")), (pii.find, ("n_email", "n_ip", "n_card", "n_phone"))):
        rows = find(docs(edge_rows)).collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in edge_rows)
        assert all(r.base_sha256 == none and r.spans == "" and not any(r[c] for c in columns) for r in rows if r.doc_id in (1, 2, 3))
        assert find(docs([])).count() == 0


def test_parts_of_very_many_zeros():
    text = "0" * 5000 + ".1.1.1 and 1.2.3." + "0" * 6000 + "255 but 1.2.3." + "0" * 5000 + "256"
    assert [k for _, _, k in pii.base_spans(text)] == ["ip", "ip"]


def test_account_numbers_beside_words():
    account = "AT61 1904 3002 3457 3201"
    for after in ("", " THE", ".", " THE BANK1 OF2X", " DE89 3704 0044 0532 0130 00"):
        spans = [s for s in pii.all_spans(f"bank {account}{after}")[1] if s[2] == "iban"]
        assert spans[0][:2] == (5, 5 + len(account)) and len(spans) == 1 + after.startswith(" DE"), after


def test_placeholders_hide_themselves_only():
    key = "wJalrXUtnFEMI7K7MDENG3bPxRfiCYzQ4tLm9Pq2"
    assert secret_scan.all_spans(f"sample/{key}")[1][0][2] == "entropy"
    assert secret_scan.all_spans("sample-example-placeholder-dummy")[1] == [] and secret_scan.all_spans("0123456789xxxxxxxxxxxxEXAMPLE")[1] == []
    assert list(secret_scan.candidates(f"{key}/EXAMPLE_{key}")) == [(0, key + "/"), (len(key) + 8, "_" + key)]


def test_required_columns_come_first(docs):
    assert secret_scan.scan(docs([])).columns[:6] == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
