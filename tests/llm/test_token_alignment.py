"""Alignment of two tokenizers against a plain version over byte offsets, with encodings by the original libraries."""

import collections
import hashlib
import random

import numpy as np
import pytest

from kindred.llm import token_alignment

FOLDER = token_alignment.FOLDER
LONG = "The quick brown fox jumps over the lazy dog; naïve café 😀 12345. " * 800
ODD = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, LONG), (5, LONG), (6, "two words"), (None, "no id"), (None, None), (7, "\n\t  \r\n x"),
    (8, "<|endoftext|> and <s> </s> <unk> <0x41>"), (9, "under ▁ line ▁▁"), (10, "\x00 \x01 control"), (11, "漢字とかな 한국어 العربية"), (12, "é ﬁ ½ Å"),
    (13, "internationalization" * 30), (14, " leading and trailing  "),
]


@pytest.fixture(scope="module")
def originals():
    tokenizers = pytest.importorskip("tokenizers")
    sentencepiece = pytest.importorskip("sentencepiece")
    one = tokenizers.Tokenizer.from_file(f"{FOLDER}/{token_alignment.A_FILE}")
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/{token_alignment.B_FILE}")


def encoded(text, originals):
    """Ids and byte ranges of both, or nothing where the bytes differ."""
    one, other = originals
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in letters}
    for b in range(256):
        if b not in letters:
            byte_of[chr(256 + len(byte_of) - len(letters))] = b
    out = []
    a = one.encode(" " + text, add_special_tokens=False)
    out.append([(i, bytes(byte_of[c] for c in token)) for i, token in zip(a.ids, a.tokens, strict=True)])
    pieces = [(i, other.id_to_piece(i)) for i in other.encode(text)]
    out.append([(i, bytes([int(p[3:5], 16)]) if other.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces])
    for tokens in out:
        if b"".join(t for _, t in tokens) != b" " + text.encode():
            return None
    return [placed(tokens) for tokens in out]


def placed(tokens):
    at, out = 0, []
    for i, token in tokens:
        out.append((i, at, at + len(token)))
        at += len(token)
    return out


def plain(rows, originals):
    documents = [encoded(text, originals) if text else None for _, text in rows]
    links = []
    for both in documents:
        found = []
        for a, start, end in both[0] if both else []:
            found += [(a, b) for b, s, e in both[1] if s < end and start < e]
        links.append(found)
    counts = collections.Counter(pair for found in links for pair in set(found))
    highest = collections.defaultdict(int)
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    out = []
    for (key, _), both, found in zip(rows, documents, links, strict=True):
        groups = []
        if both:
            cuts = sorted({e for _, _, e in both[0]} & {e for _, _, e in both[1]})
            for start, end in zip([0, *cuts], cuts, strict=False):
                groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in both))
        shown = ";".join(groups)
        out.append((
            str(key), len(both[0]) if both else 0, len(both[1]) if both else 0, len(groups), len(found),
            sum(counts[p] == highest[p[0]] for p in found), sum(counts[p] for p in found),
            hashlib.sha256(shown.encode()).hexdigest() if groups else "",
        ))
    return sorted(out)


def answer(frame):
    return sorted((str(r[0]), *r[1:]) for r in frame.collect())


def random_texts(seed, n):
    rng = random.Random(seed)
    alphabet = ["the ", "of", " and", "ing", "é", "😀", "漢", "\n", "  ", "1", "ab", "xyz ", "\t", "ü"]
    return [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(80)))) for i in range(n)]


@pytest.mark.parametrize("hot_pairs", [0, 40, token_alignment.HOT_PAIRS])
def test_score(spark, originals, hot_pairs):
    rows = [r for r in ODD if r[1] != LONG] + [(50, LONG[:500]), (50, LONG[:500])] + random_texts(1, 60)
    docs = spark.createDataFrame([(*r, 1, 2, "x", 4) for r in rows], "doc_id long, text string, pairs int, times long, _row string, c int").repartition(4)
    found = token_alignment.score(docs, hot_pairs=hot_pairs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert answer(found) == plain(rows, originals)


def test_driver_documents(spark, originals):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.orderBy(docs.text).limit(120).collect()]
    some = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(token_alignment.score(some)) == plain(rows, originals)


def test_empty_and_long(spark):
    assert token_alignment.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = [(1, LONG), (2, " " * 200_000), (3, "x" * 100_000)]
    found = {r.doc_id: r for r in token_alignment.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(r.n_groups > 0 and r.n_links >= max(r.n_a, r.n_b) for r in found.values())


def test_encoder_equals_the_original(originals):
    """The fast encoder is another library with the vocabulary of the file: hard strings must get the same ids."""
    both = token_alignment.tokenizers(FOLDER)
    rng = random.Random(3)
    tokens = [t.decode() for t in both.a_bytes if t and t.decode("utf-8", "ignore").encode() == t]
    texts = ["".join(rng.choice(tokens) for _ in range(rng.randrange(1, 6))) for _ in range(4000)]
    texts += [rng.choice(tokens) * rng.randrange(2, 9) for _ in range(2000)]
    texts += ["".join(chr(rng.choice([rng.randrange(0x300), rng.randrange(0x300, 0xD800), rng.randrange(0xE000, 0x20000)])) for _ in range(8)) for _ in range(2000)]
    assert [both._encode_a(t) for t in texts] == [e.ids for e in originals[0].encode_batch(texts, add_special_tokens=False)]
    gap = "a" + " \n" * token_alignment.LONG_GAP + "b"
    assert both._encode_a(gap) == originals[0].encode(gap, add_special_tokens=False).ids


def test_terminals_are_the_common_ends():
    rng = np.random.default_rng(5)
    for _ in range(200):
        size = int(rng.integers(1, 60))
        a, b = (np.unique(np.append(rng.integers(1, size + 1, rng.integers(1, 30)), size)) for _ in range(2))
        common = np.intersect1d(a, b)
        got = token_alignment.terminals(a, b)
        assert [g.tolist() for g in got] == [np.searchsorted(common, ends).tolist() for ends in (a, b)]


def test_groups_text(spark):
    rows = spark.createDataFrame([(1, "tokenizers")], "doc_id long, text string")
    row = token_alignment.aligned(rows, with_groups=True).first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    assert row.groups.count(";") + 1 == row.n_groups
