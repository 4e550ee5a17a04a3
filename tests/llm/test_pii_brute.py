"""op6 against a second implementation: values found by splitting on blanks, permuted with hashlib."""

import datetime
import hashlib
import random

from caselake.llm import pii
from caselake.llm.common import table
from tests.llm import cases

KEY = "another key"
START = datetime.date(1900, 1, 1)


def network(x, y, p, q, label):
    for r in range(10):
        digest = hashlib.sha256(f"{KEY}|{label}|{r}|{x if r % 2 else y}".encode()).hexdigest()
        if r % 2:
            y = (y + int(digest[:15], 16) % q) % q
        else:
            x = (x + int(digest[:15], 16) % p) % p
    return x, y


def permuted(digits, label):
    n = len(digits)
    left = n // 2
    x, y = network(int(digits[:left]), int(digits[left:]), 10 ** left, 10 ** (n - left), f"{label}{n}")
    return f"{x:0{left}d}{y:0{n - left}d}"


def checksum(digits):
    """Sum modulo 10 with every second digit from the right doubled, the last one not."""
    twice = [sum(map(int, str(2 * int(d)))) for d in digits[-2::-2]]
    return (sum(twice) + sum(int(d) for d in digits[::-2])) % 10


def replaced(word):
    """Kind and pseudonym of a word without blanks (phones: without the country code), or None."""
    if word.count("@") == 1 and "." in word.split("@")[1]:
        return "email", "u" + hashlib.sha256(f"{KEY}|email|{word.lower()}".encode()).hexdigest()[:16] + "@example.com"
    if word.isdigit() and 13 <= len(word) <= 19 and checksum(word) == 0:
        body = permuted(word[:-1], "card")
        return "card", body + str(-checksum(body + "0") % 10)
    parts = word.split(".")
    if len(parts) == 4 and all(p.isdigit() and int(p) < 256 for p in parts):
        a, b, c, d = map(int, parts)
        x, y = network(a * 256 + b, c * 256 + d, 65536, 65536, "ipv4")
        return "ipv4", f"{x // 256}.{x % 256}.{y // 256}.{y % 256}"
    parts = word.split("-")
    if [len(p) for p in parts] == [3, 2, 4] and word.replace("-", "").isdigit() and word[0] != "9":
        new = permuted(word.replace("-", ""), "ssn")
        return "ssn", f"{new[:3]}-{new[3:5]}-{new[5:]}"
    if [len(p) for p in parts] == [4, 2, 2] and word.replace("-", "").isdigit():
        try:
            day = (datetime.date.fromisoformat(word) - START).days
        except ValueError:
            return None
        x, y = network(day // 4297, day % 4297, 17, 4297, "date")
        return "date", str(START + datetime.timedelta(days=x * 4297 + y))
    return None


def brute(text):
    """New text and numbers of values by kind."""
    words, out, n, i = text.split(" "), [], dict.fromkeys(pii.KINDS, 0), 0
    while i < len(words):
        phone = words[i:i + 3]
        if (len(phone) == 3 and phone[0] == "+1" and len(phone[1]) == 5 and phone[1][0] == "(" and phone[1][4] == ")"
                and phone[1][1:4].isdigit() and phone[2][3:4] == "-" and (phone[2][:3] + phone[2][4:8]).isdigit()):
            new = permuted(phone[1][1:4] + phone[2][:3] + phone[2][4:8], "phone")
            out += ["+1", f"({new[:3]})", f"{new[3:6]}-{new[6:]}{phone[2][8:]}"]
            n["phone"] += 1
            i += 3
            continue
        pieces = words[i].split("\n")
        for j, piece in enumerate(pieces):
            core = piece.strip("$;,.:()\t\r")
            found = replaced(core)
            if found:
                n[found[0]] += 1
                pieces[j] = piece.replace(core, found[1])
        out.append("\n".join(pieces))
        i += 1
    return " ".join(out), n


def valid_card(rng, length):
    body = "".join(rng.choice("123456789") for _ in range(length - 1))
    return body + str(-checksum(body + "0") % 10)


def made(n):
    """Texts of values of all kinds, a third of them the same value, and of numbers that are none."""
    rng = random.Random(11)
    kinds = [lambda: f"{rng.choice('abc')}.x{rng.randrange(50)}@h{rng.randrange(9)}.example.org",
             lambda: f"+1 ({rng.randrange(1000):03d}) {rng.randrange(1000):03d}-{rng.randrange(10**4):04d}",
             lambda: ".".join(str(rng.randrange(320)) for _ in range(4)),
             lambda: f"{rng.randrange(1900, 2100)}-{rng.randrange(1, 14):02d}-{rng.randrange(1, 32):02d}",
             lambda: f"{rng.randrange(100, 660)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}",
             lambda: valid_card(rng, rng.randrange(13, 20)), lambda: "4845168114407328", lambda: "word", lambda: "12345",
             lambda: "4845168114407329", lambda: "4845168114407329", lambda: "4845168114407329"]
    return [(10**6 + i, "; ".join(rng.choice(kinds)() for _ in range(rng.randrange(1, 12)))) for i in range(n)]


def test_texts_and_counts_equal_the_second_implementation(spark, data_dir):
    docs = table(spark, data_dir, "documents").unionByName(cases.documents(spark, made(400)))
    total = dict.fromkeys(pii.KINDS, 0)
    for r in pii.pseudonymize_text(docs, KEY).join(docs.selectExpr("doc_id", "text AS old"), "doc_id").collect():
        new, n = brute(r.old or "")
        assert (r.text or "", {k: r[f"n_{k}"] for k in pii.KINDS}) == (new, n), r.doc_id
        total = {k: total[k] + n[k] for k in n}
    assert all(total.values())
