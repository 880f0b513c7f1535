import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from titleprep.llm.byte_tokens import byte_tokens
from titleprep.llm.window_packing import WindowPacking
from titleprep.llm.windows import OpenWindows, best_fit_decreasing, layout

PATH = public_tokenizers.path("byte_bpe_50k.json")


def one_by_one(lengths, capacity):
    """Best-fit decreasing, item by item over all open windows; the filled lengths of windows."""
    windows = []
    for n in sorted(lengths, reverse=True):
        fitting = [i for i, used in enumerate(windows) if used + n <= capacity]
        if fitting:
            windows[max(fitting, key=lambda i: windows[i])] += n
        else:
            windows.append(n)
    return sorted(windows)


@pytest.mark.parametrize("seed", range(30))
def test_best_fit_decreasing_equals_item_by_item(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 16, 64, 100])
    top = rng.randint(1, capacity)
    lengths = [rng.randint(1, top) for _ in range(rng.choice([0, 1, 5, 300]))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    runs, windows = best_fit_decreasing(counts, capacity)
    assert sorted(u for u, _, n in windows for _ in range(n)) == one_by_one(lengths, capacity)
    assert sum(r.windows * r.times for r in runs) == len(lengths)


def test_tightest_leaf():
    tree = OpenWindows(9)
    assert tree.tightest(0) is None
    for r in (3, 9):
        tree.put(r, (r, 1))
    assert [tree.tightest(n) for n in range(10)] == [3] * 4 + [9] * 6
    assert tree.take(9) == (9, 1)
    assert tree.tightest(4) is None


def test_work_does_not_grow_with_counts():
    plan = layout({n: 10**9 + n for n in range(1, 2_049)}, 2_048)
    assert len(plan.slots["key"]) < 50_000


TEXTS = [
    "a <|endoftext|> b", "x<|endoftext|>", "", None, "word " * 5_000, " " * 40_000, "漢字仮名 " * 900, "é" * 3_000,
    "a" * 20_000, "It's 12345 o'clock!\n\n\n  next", "word " * 5_000,
]


def test_ids_equal_the_library():
    library = Tokenizer.from_file(PATH)
    for text in TEXTS:
        assert byte_tokens(PATH).encode(text or "").tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_other_files_go_through_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for text in TEXTS[:6]:
        assert byte_tokens(path).encode(text or "").tolist() == library.encode(text or "", add_special_tokens=False).ids


def check(rows, texts, capacity):
    """Every id once, checksums, gapless sequences; the tokens of padding."""
    library = Tokenizer.from_file(PATH)
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for doc, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids[doc]))
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[doc][r["start"] : at], "<u4"))
        assert at == len(ids[doc])
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
        padding += capacity - at if at & (at - 1) else 0
    return padding


def packed(spark, texts, **options):
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    return WindowPacking(PATH, **options)(docs).collect()


def test_whole_result(spark):
    texts = list(enumerate(TEXTS))
    assert check(packed(spark, texts), texts, 2_048) == 0


@pytest.mark.parametrize("seed", range(2))
def test_random_lengths(spark, seed):
    rng = random.Random(seed)
    texts = [(i, "word " * rng.choice([0, 3, 40, 41, 55, rng.randint(0, 300)])) for i in range(400)]
    rows = packed(spark, texts, capacity=100)
    assert check(rows, texts, 100) == 0
    pieces = sum(-(-n // 100) for n in {r["doc_id"]: r["doc_tokens"] for r in rows}.values())
    assert len(rows) - pieces <= 60  # cuts besides those into full windows


def test_one_length_for_all(spark):
    texts = [(i, "word " * 54) for i in range(1_000)]
    assert check(packed(spark, texts, capacity=100), texts, 100) == 0


def test_empty_table_null_and_repeated_ids_and_clashing_columns(spark):
    assert packed(spark, []) == []
    docs = spark.createDataFrame(
        [(None, "a b", 1, 2), (None, None, 1, 2), (7, "c", 1, 2), (7, "c", 1, 2)],
        "doc_id long, text string, length long, _rank long",
    )
    rows = WindowPacking(PATH)(docs).collect()
    # "a b" and "c" have two ids and one id, and every document its end
    assert sum(r["length"] for r in rows if r["doc_id"] is None) == 3 + 1
    assert sum(r["length"] for r in rows if r["doc_id"] == 7) == 2 + 2
