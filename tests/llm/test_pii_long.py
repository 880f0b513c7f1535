"""Texts of many matches: places against brute force, and a cost in proportion to the matches."""

import random
import time

from llm import brute
from titleprep.llm.pii import PersonalData


PARTS = [
    "a.b@c.de", "10.1.2.3", "300.1.1.1", "4111 1111 1111 1111", "+49 (30) 123-4567", "123-45-6789", "ssn",
    "DE89 3704 0044 0532 0130 00", "social security", "é🎉", "日本語", "\n", "prose", "x" * 39, "x" * 41, "y" * 1_500, "z" * 1_024,
]


def test_spans_and_redaction_against_brute_force(as_docs):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 120)))) for i in range(60)]
    docs += [(100, "y" * 1_016 + "a.b@c.de"), (101, "y" * 1_020 + " a.b@c.de"), (102, "a.b@c.de" + "\n" * 2_040)]
    frame = as_docs(docs, clashing=True)
    found = {r["doc_id"]: r["pii"] for r in PersonalData()(frame).collect()}
    clean = {r["doc_id"]: r["text"] for r in PersonalData().redact(frame).collect()}
    for id_, text in docs:
        spans = brute.all_pii(text)
        assert [(s["kind"], s["start"], s["end"]) for s in found[id_]] == spans, id_
        assert clean[id_] == brute.redacted(text), id_


def test_cost_grows_with_the_matches(as_docs):
    """Four times the matches take some four times the time, not sixteen."""
    seconds = []
    for n in (500, 4_000, 16_000):
        text = " ".join(f"10.{i % 200}.{i % 100}.7" for i in range(n))
        frame = as_docs([(1, text)], partitions=1)
        begin = time.monotonic()
        (row,) = PersonalData().redact(frame).collect()
        seconds.append(time.monotonic() - begin)
        assert row["text"] == " ".join(["<IP>"] * n)
    assert seconds[2] < 8 * seconds[1] + 2, seconds
