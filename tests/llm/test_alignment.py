"""Token alignment against plain loops over both libraries."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from deedmill.llm import alignment
from deedmill.llm.queries import QUERIES
from deedmill.llm.tokenizers import byte_alphabet, default_path
from tests.llm.data import SF, documents, odd_documents, rows_of, sample_documents, with_clashes

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(default_path(A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=default_path(B))


def plain_ends(pieces):
    out, at = [], 0
    for p in pieces:
        at += len(p)
        out.append(at)
    return out


def plain_alignment(rows, libraries):
    a, b = libraries
    back = {c: k for k, c in enumerate(byte_alphabet())}
    aligned, total = [], Counter()
    for r in rows:
        text = r["text"] or ""
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text)
        bytes_a = [bytes(back[c] for c in a.id_to_token(k)) for k in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(k)[3:-1], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in ids_b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == b" " + text.encode():
            aligned.append((r, [], [], [], ""))
            continue
        ends_a, ends_b = plain_ends(bytes_a), plain_ends(bytes_b)
        at_b = {e: k for k, e in enumerate(ends_b)}
        links, parts, last_a, last_b = [], [], 0, 0
        for k, e in enumerate(ends_a):
            if e in at_b:
                j = at_b[e]
                links.append((ids_a[k], ids_b[j]))
                parts.append(",".join(map(str, ids_a[last_a : k + 1])) + "|" + ",".join(map(str, ids_b[last_b : j + 1])))
                last_a, last_b = k + 1, j + 1
        total.update(links)
        aligned.append((r, ids_a, ids_b, links, hashlib.sha256(";".join(parts).encode()).hexdigest()))
    most = {}
    for (x, y), n in total.items():
        most[y] = max(most.get(y, 0), n)
    return Counter(
        (r["doc_id"], len(x), len(y), len(links), len(links), sum(total[p] == most[p[1]] for p in links), sum(total[p] for p in links), digest)
        for r, x, y, links, digest in aligned
    )


def special_rows():
    texts = ["a▁b", "<s>x</s> <unk> <0x0A>", "<|endoftext|> and <|endoftext|>" * 30, "tab\there\r\nand  two   spaces ", " ", "\u0000\u0001", "é ﬁ ½ Ａ",
             "=" * 700, "ab" * 400 + " <|endoftext|>"]
    return [{"doc_id": 7000 + k, "text": t, "lang": None, "source": None, "n_chars": 0} for k, t in enumerate(texts)]


@pytest.mark.parametrize("chunk, merge", [(2_000_000, 2_000_000), (3_000, 50)])
def test_against_plain_loops(spark, libraries, monkeypatch, chunk, merge):
    monkeypatch.setattr(alignment, "CHUNK_CHARS", chunk)
    monkeypatch.setattr(alignment, "MERGE_ROWS", merge)
    rows = sample_documents() + odd_documents() + special_rows()
    found = alignment.align_tokenizers(with_clashes(documents(spark, rows)), default_path(A), default_path(B))
    assert found.columns == list(COLUMNS)
    want = plain_alignment(rows, libraries)
    assert rows_of(found, *COLUMNS) == want
    assert {r[0] for r in want if r[1] == 0} >= {1000, 1001, 7000}


@pytest.mark.parametrize("rows", [[], odd_documents()[:2], special_rows()[:1], odd_documents()[-2:] * 2])
def test_few_rows(spark, libraries, rows):
    found = alignment.align_tokenizers(documents(spark, rows), default_path(A), default_path(B))
    assert rows_of(found, *COLUMNS) == plain_alignment(rows, libraries)


def test_query(spark, libraries):
    found = QUERIES["op13_tokenizer_alignment"](spark, SF)
    assert rows_of(found, *COLUMNS) == plain_alignment(sample_documents(), libraries)


def test_counts_are_bounded_by_the_vocabularies(spark):
    aligner = alignment.load_aligner(default_path(A), default_path(B))
    aligned = alignment.align_documents(documents(spark), default_path(A), default_path(B), id_col="doc_id", text_col="text")
    pieces = [side.pieces.to_pylist() for side in aligner.sides]
    for r in alignment.pair_counts(aligned, aligner.width).collect():
        a, b = pieces[0][r["pair"] // aligner.width], pieces[1][r["pair"] % aligner.width]
        assert a.endswith(b) or b.endswith(a)
