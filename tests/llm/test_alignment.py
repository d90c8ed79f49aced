"""Cross-tokenizer alignment (12): against whole texts and brute force, hashes, odd texts, many groups of parts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import SF001, SF01
from tidepool.llm import alignment

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = alignment.byte_letters()
    raw_a = lambda i: bytes(letters[c] for c in a.id_to_token(i))

    def raw_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()

    return a, b, raw_a, raw_b


def whole(text, tokenizers):
    """(A ids, B ids, groups, links) of a whole text, by walking over its bytes."""
    a, b, raw_a, raw_b = tokenizers
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    by_a, by_b = [raw_a(i) for i in ids_a], [raw_b(i) for i in ids_b]
    if not (b"".join(by_a) == b"".join(by_b) == (" " + text).encode()):
        return None
    owner = [[k for k, x in enumerate(by) for _ in x] for by in (by_a, by_b)]
    links = sorted(set(zip(*owner, strict=True)))
    groups, left_a, left_b, ends = [], 0, 0, lambda by: {sum(map(len, by[:k + 1])) for k in range(len(by))}
    end_a, end_b, at_a, at_b = ends(by_a), ends(by_b), 0, 0
    na = nb = 0
    for end in sorted(end_a & end_b):
        while at_a < end:
            at_a += len(by_a[na])
            na += 1
        while at_b < end:
            at_b += len(by_b[nb])
            nb += 1
        groups.append((ids_a[left_a:na], ids_b[left_b:nb]))
        left_a, left_b = na, nb
    return ids_a, ids_b, groups, [(ids_a[i], ids_b[j]) for i, j in links]


def brute(rows, tokenizers):
    found = [(i, whole(t, tokenizers)) for i, t in rows]
    counts, best = {}, {}
    for _, w in found:
        for pair in set(w[3]) if w else ():
            counts[pair] = counts.get(pair, 0) + 1
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for i, w in found:
        if w is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in w[2])
        out.append((i, len(w[0]), len(w[1]), len(w[2]), len(w[3]), sum(counts[p] == best[p[0]] for p in w[3]),
                    sum(counts[p] for p in w[3]), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def aligned(spark, rows, **options):
    out = alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), **options)
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()), key=str)


ODD = ["", None, " ", "  ", "a", " a", "a ", "a  b", "a\n b", "\n", "a \n b", "\t x\t y ", "don't you've  I'LL", "1234 567,89",
       "naïve café 東京 мир", "é é", "👩‍👩‍👧 ok", "▁under ▁ bar", "<|endoftext|> <s> </s> <unk> <0x41>", "a b   c",
       "\x1c x \x00 y", "x\r\ny;\r\n z", "ﬁ ½ Å ｆｕｌｌ", "a" * 3000, "ab " * 2000, "𝕏" * 50, "​ z‍", "(x) -- [y]\n\n  {z}"]


def test_odd_texts_equal_brute_force(spark, tokenizers):
    rows = [*enumerate(ODD), (None, "a null id"), (None, "a null id"), (5, "another text"), (900, "a\n b"), (901, "a\n b")]
    want = brute(rows, tokenizers)
    assert aligned(spark, rows) == want
    assert sum(r[1] == 0 for r in want) < 10                     # most of them have tokens
    assert aligned(spark, rows, part_keys=20, group_keys=60) == want
    assert aligned(spark, []) == [] and aligned(spark, [(1, None)]) == [(1, 0, 0, 0, 0, 0, 0, "")]
    extra = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, mark int, n_best string")
    assert sorted(map(tuple, alignment.align(extra).collect()), key=str) == want


def test_query_equals_brute_force(spark, tokenizers):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert sorted(map(tuple, alignment.op12_alignment(spark, SF001).collect()), key=str) == brute(rows, tokenizers)


def test_ids_equal_the_tokenizers(spark, tokenizers):
    """Both ways of encoding give the ids of the named tokenizers, for texts of the table and random ones."""
    a, b, _, _ = tokenizers
    rnd = random.Random(11)
    texts = ["".join(rnd.choices(list(alphabet), k=rnd.randint(1, 60))) for _ in range(4000) for alphabet in
             ("ab'sT .,;\n\t\r 09é東  ́▁<|>👍-_", "aZ'sTre llm,.;!09\n \t\r éÀñßİıÆ¿«·½²ª×÷ǅʼ°µ-_")]
    texts += [r["text"] for r in spark.read.parquet(f"{SF01}/documents.parquet").select("text").collect() if r["text"]]
    texts += ["a" * 600, " " * 700 + "b", "\n" * 800, "ab1" * 900, "don't'll've" * 100]
    enc = alignment.encoder((public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")))
    assert sum(not alignment.is_odd(t) for t in texts) > 3000
    assert all(alignment.is_odd(t) for t in ("x" * 500, "a " + "b" * 500 + " c", " " * 500, "東")) and not alignment.is_odd("x" * 499)
    for text, (ids_a, ids_b) in zip(texts, enc.encode(texts), strict=True):
        if ids_a or "▁" not in text:
            assert (ids_a, ids_b) == (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)), text


def test_documents_aligned_together_or_apart(tokenizers, monkeypatch):
    enc = alignment.encoder((public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")))
    ids = enc.encode(ODD)
    pack = lambda x: np.array(x, dtype=alignment.KIND).tobytes()
    together = alignment.Aligned([pack(a) for a, _ in ids], [pack(b) for _, b in ids], enc.lengths())
    apart = [alignment.Aligned([pack(a)], [pack(b)], enc.lengths()) for a, b in ids]
    assert together.digests() == [x.digests()[0] for x in apart]
    assert together.links.tolist() == [v for x in apart for v in x.links.tolist()]
    assert together.n_groups.tolist() == [int(x.n_groups[0]) for x in apart]
    none = alignment.Aligned([], [], enc.lengths())
    assert none.digests() == [] and not len(none.links)


def test_minimal_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 5000):
        keys = np.unique(rng.integers(0, 1 << 50, size=n))
        number = alignment.MinimalHash(keys)
        assert sorted(number(keys).tolist()) == list(range(len(keys)))
        assert ((number(rng.integers(1 << 51, 1 << 52, size=100)) < len(keys)).all())
    with pytest.raises(ValueError):
        alignment.MinimalHash(np.array([3, 3]))


def test_keys_left_after_the_last_level(monkeypatch):
    monkeypatch.setattr(alignment, "LEVELS", 1)
    keys = np.arange(1000) * 7
    number = alignment.MinimalHash(keys)
    assert len(number.rest) and sorted(number(keys).tolist()) == list(range(1000))


def test_unknown_pairs_have_no_number():
    keys = np.arange(500, dtype=np.int64) << 32 | 5
    number = alignment.MinimalHash(keys)
    held = np.empty(500, dtype=np.int64)
    held[number(keys)] = keys
    numbers = alignment.Numbers([(0, alignment.SLOTS - 1, number, held)])
    assert sorted(numbers(keys).tolist()) == list(range(500)) and (numbers(keys + 1) == -1).all()


def test_units_equal_whole_texts(monkeypatch):
    """Ids put together from units are those of the whole text, also where a worker forgets its units."""
    monkeypatch.setattr(alignment, "UNITS_ROOM", 2_000)
    enc = alignment.Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    assert enc.parted
    rng = random.Random(7)
    bits = ["a", "of", "The", "'s", "1234", "-", "é", "ß", "ŉ", "ł", "<s>", "</s>", "<unk>", "<0x41>", "▁", "\n", "\t", " ",
            "  ", "\xa0", "´", "½", "中", "x" * 30]
    texts = [rng.choice(["", " "]).join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    texts += ["b " * 300, " a", "a ", "a  b", " ", "a\n" * 400]
    for text in texts:
        a, b = enc.a.encode(" " + text, add_special_tokens=False).ids, enc.b.encode(text)
        raw = (" " + text).encode()
        same = b"".join(enc.bytes_a[i] for i in a) == raw and b"".join(enc.bytes_b[i] for i in b) == raw
        assert enc.encode([text]) == [(a, b) if same and text else ([], [])], text
    assert sum(bool(enc.by_units(t)) for t in texts) > 500
