"""Personal data against the patterns as written, and disclosing terms against counting by hand."""

import hashlib
import math
import random
import re
from collections import defaultdict

from deedmill.llm import pii
from deedmill.llm.queries import QUERIES
from tests.llm.data import SF, documents, odd_documents, rows_of, sample_documents, with_clashes


def luhn(text):
    digits = [int(c) for c in text if c in "0123456789"]
    total = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
    return 13 <= len(digits) <= 19 and total % 10 == 0


def plain_spans(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if luhn(m.group())]
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.findall("[0-9]", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


def test_patterns_on_random_texts():
    rng = random.Random(5)
    for alphabet in ("ab@.-_1é ", "0123456789.", "012345-  ", "+1 ()-.9 ", "a@b.1+4- _%"):
        for _ in range(3000):
            text = "".join(rng.choices(alphabet, k=rng.randint(0, 40)))
            assert pii.base_spans(text) == plain_spans(text), repr(text)


def test_patterns_on_cards_and_long_runs():
    for text in ("4111 1111 1111 1111", "x4111-1111-1111-1111-", "4222 2222 2222 2", "378282246310005"):
        assert pii.base_spans(text) == plain_spans(text) != []
    for text in ("1" * 200_000, "a" * 200_000, "a@" * 50_000, "1." * 50_000, "+1" + "(" * 100_000, "9" * 5000 + ".1.1.1"):
        assert isinstance(pii.base_spans(text), list)  # in linear time


def plain_row(r):
    base = plain_spans(r["text"] or "")
    listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
    counts = [sum(k == kind for k, _, _ in base) for kind in pii.KINDS]
    return (r["doc_id"], *counts, hashlib.sha256(listed.encode()).hexdigest())


COLUMNS = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def test_query_equals_the_patterns(spark):
    found = QUERIES["op1_pii"](spark, SF)
    assert rows_of(found, *COLUMNS) == {plain_row(r): 1 for r in sample_documents()}


def corpus():
    """Jane's mail stands next to her unusual street in four contexts; common words surround it."""
    rng = random.Random(1)
    common = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "lambda"]
    texts = []
    for k in range(4):
        a, b = rng.sample(common, 2)
        texts.append(f"{a} {b} Quillfeather jane@roe.example.com zebrine {b} {a} {k}")
    texts += [f"{' '.join(rng.choices(common, k=9))} zebra {k}" for k in range(30)]
    texts += ["nobody at Quillfeather today", "QUILLFEATHER", None, ""]
    texts += ["zzz only@copied.example.org copiedword"] * 20  # one witness, twenty copies
    return texts


def by_hand(texts, bits, min_contexts):
    """Counts of terms within the context of an entity, as the module describes them."""
    joint, contexts = defaultdict(int), defaultdict(set)
    df = defaultdict(int)
    for text in texts:
        own = {w.lower() for w in re.findall(r"[^\W\d_]{3,}", text or "")}
        for w in own | {w[:3] + "*" for w in own}:
            df[w] += 1
        if not text or "@" not in text:
            continue
        (kind, a, b), = plain_spans(text)
        before = [w.lower() for w in re.findall(r"[^\W\d_]{3,}", text[:a])]
        after = [w.lower() for w in re.findall(r"[^\W\d_]{3,}", text[b:])]
        for w in set(before[-8:] + after[:8]):
            joint[text[a:b], w] += 1
            contexts[text[a:b], w].add(tuple(before[-2:] + after[:2]))
    out = {}
    for (e, w), n in joint.items():
        if len(contexts[e, w]) >= min_contexts and math.log2(df[w] / n) <= bits:
            out[w] = "remove" if math.log2(df[w[:3] + "*"] / n) <= bits else "generalise"
    return out


def test_disclosing_terms(spark):
    texts = corpus()
    rows = [{"doc_id": k, "text": t, "lang": None, "source": None, "n_chars": None} for k, t in enumerate(texts)]
    want = by_hand(texts, pii.BITS, 3)
    assert want == {"quillfeather": "remove", "zebrine": "generalise"}
    for limit in (pii.BROADCAST_TERMS, 0):  # sent to every task; met by a shuffle
        found = pii.disclosing_terms(documents(spark, rows), broadcast_terms=limit)
        assert {r["term"]: r["kind"] for r in found.collect()} == want
        spans = {r["doc_id"]: r["spans"] for r in pii.find_pii(documents(spark, rows), broadcast_terms=limit).collect()}
        assert spans[34] == "remove:10:22" and spans[35] == "remove:0:12" and spans[36] == "" == spans[10]
        at = texts[0].index("zebrine")
        assert spans[0].startswith("email:") and f"generalise:{at}:{at + 7}" in spans[0]
        assert spans[40] == "email:4:27"  # copies are one witness
        clean = pii.sanitise_documents(documents(spark, rows), broadcast_terms=limit).orderBy("doc_id").collect()
        assert "zeb* " in clean[0]["text"] and "[EMAIL]" in clean[0]["text"] and "jane" not in clean[0]["text"]
        assert clean[34]["text"] == "nobody at  today" and clean[36]["text"] == "" and clean[10]["text"] == texts[10]


def test_a_name_in_a_fixed_signature(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(400)]
    sign = "\nKind regards from\nMarigold Fennimore, m.fennimore@example.org"
    body = lambda: " ".join(rng.choices(words, k=60))
    texts = [body() + sign for _ in range(200)] + [body() + " kind regards from us all" for _ in range(300)]
    # a text that is copied, and copies of it with a word changed here and there, are a few witnesses at most
    copied = body().split()
    texts += [" ".join(copied) + " Copperfield, copy@example.net"] * 300
    rows = [{"doc_id": k, "text": t, "lang": None, "source": None, "n_chars": None} for k, t in enumerate(texts)]
    found = {r["term"]: r["kind"] for r in pii.disclosing_terms(documents(spark, rows)).collect()}
    assert set(found) == {"marigold", "fennimore"}
    spans = {r["doc_id"]: r["n_terms"] for r in pii.find_pii(documents(spark, rows)).collect()}
    assert all((n == 2) == (k < 200) for k, n in spans.items())


def test_witnesses_are_documents():
    body = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)]
    sign = " Fennimore f@example.org"
    one = {w for _, w, _ in pii._mentions(" ".join(body) + sign)}
    assert one == {w for _, w, _ in pii._mentions(" ".join(body[:]) + sign)} and len(one) == 1
    near = [body[:k] + ["changed"] + body[k + 1 :] for k in range(0, 180, 3)]
    others = [{w for _, w, _ in pii._mentions(" ".join(b) + sign)} for b in near]
    assert sum(o == one for o in others) >= len(near) - 3
    assert {w for _, w, _ in pii._mentions(" ".join(reversed(body)) + sign)} != one


def test_odd_rows(spark):
    rows = odd_documents()
    found = pii.find_pii(with_clashes(documents(spark, rows)))
    want = {}
    for r in rows:
        want[plain_row(r)] = want.get(plain_row(r), 0) + 1
    assert rows_of(found, *COLUMNS) == want
    kept = pii.sanitise_documents(with_clashes(documents(spark, rows)))
    assert kept.count() == len(rows) and kept.columns == with_clashes(documents(spark, rows)).columns


def test_empty_table(spark):
    assert pii.find_pii(documents(spark, [])).collect() == []
    assert pii.sanitise_documents(documents(spark, [])).collect() == []


def test_overlapping_spans_are_replaced_once():
    text = "a 10.0.0.1@b.org z"
    spans = pii.base_spans(text)
    assert [s[0] for s in spans] == ["email", "ip"]
    assert pii.sanitise(text, spans, []) == "a [EMAIL] z"
