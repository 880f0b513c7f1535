import base64
import random
import zlib

from llm import brute
import numpy as np
import pytest

from titleprep.llm.fillings import best_fit, completed, pack
from titleprep.llm.packing import BestFitPacking

tokenizers = pytest.importorskip("tokenizers")
tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")

ODD = [
    "don't we'll I'VE 'S it's",
    "x1²y ½ ª µß ÿ \x85 \xa0 \x1c\x1d",
    "e\u0301cole A\u030a İstanbul ΣΑΣ ﬁ",
    "a  b\n\n c\t\td \r\n e   ",
    "日本語 🎉🎉 <|endoftext|> <|startoftext|>",
    "a <|EndOfText|> b",
    "x<|startoftext|>y",
    "!!..,,;;--==>> <= a.b,c;d",
    "z" * 700 + "xyzzy" * 200,
]


@pytest.fixture(scope="module")
def texts(hard_docs):
    return [*hard_docs, *[(100 + i, t) for i, t in enumerate(ODD)]]


def test_byte_bpe_equals_the_library(texts, as_docs):
    from titleprep.llm.byte_bpe import ByteBpe

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = ByteBpe(path, public_tokenizers.PATTERN)
    rows = coder.round_trip(as_docs(texts, clashing=True)).select("doc_id", "text", "ids", "decoded").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["ids"] == own.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    again = coder.decode(coder.encode(as_docs(texts))).select("text", "decoded").collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in again)
    assert coder.round_trip(as_docs([])).count() == 0


@pytest.mark.parametrize(
    ("count", "make"),
    [
        (60_000, lambda i: "".join(chr(0x4E00 + (i * 7 + j * j + i // 300) % 8_000) for j in range(30))),
        (300, lambda i: f"{chr(97 + i % 26)}bcdefghij" * 49 + chr(97 + i // 26)),
    ],
)
def test_byte_bpe_of_long_pieces_in_bounded_memory(count, make):
    from titleprep.llm.byte_bpe import _Coder

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coder = _Coder(path, public_tokenizers.PATTERN)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    pieces = list({make(i) for i in range(count)})
    coder._learn(pieces)
    for piece in pieces[:: max(1, len(pieces) // 3_000)]:
        assert np.frombuffer(coder.known[piece], "<u4").tolist() == own.encode_ordinary(piece)


def placed(rows):
    """Checks that sequences have no gaps; returns their number."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4_096
    return len(by_sequence)


def test_packing(texts, as_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = tokenizers.Tokenizer.from_file(path)
    expected, total = [], 0
    for id_, text in texts:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        for piece, at in enumerate(range(0, len(ids), 4_096)):
            part = ids[at : at + 4_096]
            expected.append((id_, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    rows = BestFitPacking(path)(as_docs(texts, clashing=True)).collect()
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert placed(rows) == -(-total // 4_096)
    assert BestFitPacking(path)(as_docs([])).count() == 0


def test_sequences_hold_the_ids(as_docs, prose):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = [(i, prose(i, 700)) for i in range(4)]
    rows = BestFitPacking(path, capacity=2_048).sequences(as_docs(docs)).collect()
    whole = tokenizers.Tokenizer.from_file(path)
    ids = [i for _, t in docs for i in [*whole.encode(t, add_special_tokens=False).ids, 1]]
    got = [i for r in rows for i in np.frombuffer(bytes(r["ids"]), "<u4").tolist()]
    assert sorted(got) == sorted(ids)
    assert all(len(r["ids"]) <= 4 * 2_048 for r in rows)


def used(fillings, counts, capacity):
    """The number of bins, after checking that every item is in one and no bin is too full."""
    left = dict(counts)
    for filling, bins in fillings:
        assert bins > 0 and sum(s * n for s, n in filling) <= capacity
        for size, n in filling:
            left[size] -= n * bins
    assert not any(left.values())
    return sum(bins for _, bins in fillings)


def test_completion_saves_a_bin():
    # best fit decreasing puts 44 with 41 and needs three bins
    counts = {44: 1, 41: 1, 36: 1, 35: 1, 23: 1, 21: 1}
    assert used(best_fit(counts, 100), counts, 100) == 3
    assert used(completed(counts, 100, 2), counts, 100) == 2
    assert used(pack(counts, 100), counts, 100) == 2


def test_pack_random_sizes():
    for seed in range(40):
        rng = random.Random(seed)
        capacity = rng.choice([10, 60, 100, 4_096])
        counts = {}
        for _ in range(rng.randint(0, 200)):
            size = rng.randint(1, capacity)
            counts[size] = counts.get(size, 0) + rng.choice([1, 1, 50])
        bins = used(pack(counts, capacity), counts, capacity)
        assert -(-sum(s * n for s, n in counts.items()) // capacity) <= bins
        assert bins <= used(best_fit(counts, capacity), counts, capacity)


def test_quality_of_brute_force():
    assert brute.luhn("4111111111111111") and not brute.luhn("4111111111111112")
