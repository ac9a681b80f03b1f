"""Personal data: patterns against plain regular expressions, associations against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from arrivals_engine.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute_base(text):
    found = []
    for kind, pattern in PLAIN.items():
        found += [(m.start(), m.end(), kind) for m in re.finditer(pattern, text or "") if holds(kind, m.group())]
    return sorted(found, key=lambda s: (s[0], list(PLAIN).index(s[2])))


def test_patterns_equal_plain_expressions():
    rng = random.Random(1)
    alphabet = ["a", "B", "9", "1", "0", "25", "4", ".", "@", "-", " ", "+", "(", ")", "%", "é", "\n", "4041894974608795"]
    for _ in range(40_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(30)))
        assert pii.base_spans(text) == brute_base(text), text
    for text in ("x@a.b@c.d", "@a.b", "a@b.", "1.2.3.4.5.6.7.8", "+1 (456) 555-2186", "4041894974608795 4041894974608795"):
        assert pii.base_spans(text) == brute_base(text), text


def test_long_texts_take_linear_time():
    n = 300_000
    for text in ("a" * n, "9" * n, "1 " * n, "+1" + "(" * n, "a@" * n, "@a.b" * n, "1." * n, "." * n):
        assert len(pii.base_spans(text)) <= n


def plain_terms(text, spans):
    found = []
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        if any(s < m.end() and m.start() < e for s, e, _ in spans):
            continue
        bare = m.group().strip(pii.EDGES)
        if bare:
            start = m.start() + m.group().index(bare)
            found.append((start, start + len(bare), re.sub("[A-Z]", lambda x: x.group().lower(), bare)))
    return found


def brute_associations(texts, limits):
    together, contexts, has, terms_of = Counter(), defaultdict(set), Counter(), Counter()
    masked = lambda t: re.sub("[0-9]", "#", t)
    for text in texts:
        spans = brute_base(text)
        words = plain_terms(text or "", spans)
        terms_of.update({w[2] for w in words} | {masked(w[2]) for w in words})
        seen = set()
        for span in spans:
            before = [w[2] for w in words if w[0] <= span[0]][-limits.near :]
            around = before + [w[2] for w in words if w[0] > span[0]][: limits.near]
            who = pii.entity(text, span)
            for t in {"", *around, *map(masked, around)}:
                contexts[who, t].add(tuple(around))
                seen.add((who, t))
        together.update(seen)
    found = set()
    for (who, t), n in together.items():
        if t and len(contexts[who, t]) >= limits.contexts:
            ic = -math.log2(together[who, ""] / len(texts))
            pmi = math.log2(n * len(texts) / (terms_of[t] * together[who, ""]))
            if ic - pmi <= limits.bits_left and pmi >= limits.share * ic and pmi > 0:
                found.add((who, t))
    return found


def corpus(seed):
    """A name that stands beside one address, a room number that does too, and other text."""
    rng = random.Random(seed)
    filler = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    say = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    texts = [say(rng.randrange(5, 60)) for _ in range(200)]
    texts += [f"{say(9)} Dr. Zanzibar, room 4711: zan@mail.example.com. {say(9)}" for _ in range(6)]
    texts += [f"{say(5)} room {rng.randrange(1000, 9999)} {say(5)}" for _ in range(20)]
    texts += [f"{say(5)} Dr. Who {say(5)}" for _ in range(20)]
    texts += [f"{say(9)} 10.0.0.{i} {say(9)}" for i in range(9)]
    texts += [f"only copies name Quagga q@mail.example.com {say(3)}"] * 30
    texts += [f"{say(4)} Zanzibar's friend, zanzibar {say(4)}"]
    return texts


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_disclosing_terms_and_spans(spark, most):
    texts = [*corpus(2), None, "", " \t"]
    rows = [(i % 200, t, "x") for i, t in enumerate(texts)] + [(None, texts[201], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _pii_key string").repartition(5)
    texts = [r[1] for r in rows]
    limits = pii.Limits()
    got = pii.associations(docs, limits, most).where("disclosing").select("entity", "term").collect()
    want = brute_associations(texts, limits)
    assert {tuple(r) for r in got} == want
    say = {r["term"]: r["written"] for r in pii.disclosing_terms(docs, limits, most).collect()}
    assert say["zanzibar"] == "" and say["4711"] == "####" and "quagga" not in say and "room" not in say
    assert set(say) == {t for _, t in want}

    found = pii.sanitised(docs, limits, most_broadcast=most)
    assert found.columns == [*docs.columns, "found"] and found.count() == len(rows)
    for r in found.collect():
        text, spans = r["text"], [tuple(s) for s in r["found"]["spans"]]
        base = brute_base(text)
        assert [s for s in spans if s[2] != "term"] == base
        told = [(s, e, "term") for s, e, t in plain_terms(text or "", base) if t in say]
        assert sorted(spans) == sorted([*base, *told])
        clean = r["found"]["clean"]
        assert (clean is None) == (text is None)
        if not spans:
            assert clean == text
        elif "zan@" in text:
            assert "Dr. , room ####: [EMAIL]" in clean

    digests = pii.span_digests(docs, limits, most_broadcast=most)
    order = lambda rows: sorted(map(tuple, rows), key=str)
    join = lambda spans: ",".join(f"{k}:{s}:{e}" for s, e, k in spans)

    def digest(doc_id, text):
        base = brute_base(text)
        told = [(s, e, "term") for s, e, t in plain_terms(text or "", base) if t in say]
        counts = Counter(k for _, _, k in base)
        listed = join(sorted([*base, *told], key=lambda s: (s[0], [*PLAIN, "term"].index(s[2]))))
        return doc_id, *(counts[k] for k in PLAIN), hashlib.sha256(join(base).encode()).hexdigest(), listed

    assert order(digests.collect()) == order(digest(i, t) for i, t, _ in rows)


def test_empty_table_and_taken_names(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.span_digests(docs).collect() == []
    assert pii.sanitised(docs, most_broadcast=-1).collect() == []
    with pytest.raises(ValueError):
        pii.sanitised(docs, into="text")
