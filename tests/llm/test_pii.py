from llm import brute
import pytest

from titleprep.llm.pii import BASE_KINDS, PersonalData

TEXTS = [
    None,
    "",
    "mail a.b@c.de_x@d.ef and x@y, x@y.z.",
    "a@b@c.d e@f.g.h- @@ é@x.yz ünï.cöde@mail1.example.com",
    "10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.004 0000000255.1.1.1 1.2.3 9999999999999999999999.1.1.1",
    "4111 1111 1111 1111, 4111111111111112 4111-1111-1111-1111-4 30569309025904 5 3 0",
    "+1 (522) 555-2427 +12 +123456789012345678 +1..........5 +49 30 1234567-",
    "é日🎉 +49 (30) 123-4567 é a@b.co 🎉 4111111111111111 10.1.2.3",
    "1 2 3 4 5 6 7 8 9 " * 800,
    "a." * 20_000,
    "7" * 30_000,
    "x@" * 5_000 + "y.z",
    "IBAN DE89 3704 0044 0532 0130 00 and DE88 3704 0044 0532 0130 00, GB82WEST12345698765432",
    "my social security number 123-45-6789; part no 123-45-6789",
]


@pytest.fixture(scope="module")
def found(as_docs):
    docs = [(i, t) for i, t in enumerate(TEXTS)]
    rows = PersonalData()(as_docs(docs, clashing=True)).collect()
    return {r["doc_id"]: r["pii"] for r in rows}


def test_base_spans(found):
    for i, text in enumerate(TEXTS):
        got = [(s["kind"], s["start"], s["end"]) for s in found[i] if s["kind"] in BASE_KINDS]
        assert got == brute.pii(text), i
        assert all(s["text"] == text[s["start"] : s["end"]] for s in found[i])


def test_checksums_and_context(found):
    iban = [s["text"] for s in found[12] if s["kind"] == "iban"]
    assert iban == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
    # the number alone scores too little; words before it decide
    assert [s["start"] for s in found[13] if s["kind"] == "ssn"] == [TEXTS[13].index("123")]


def test_redaction(as_docs, pairs):
    docs = [(1, "to a@b.co now"), (2, None), (3, "é +4111111111111111 x"), (4, "no"), (5, "10.0.0.1")]
    got = PersonalData().redact(as_docs(docs, clashing=True))
    expected = [(1, "to <EMAIL> now"), (2, None), (3, "é +<CARD> x"), (4, "no"), (5, "<IP>")]
    assert pairs(got, "doc_id", "text") == expected


def test_empty_table_and_repeated_rows(as_docs, pairs):
    assert PersonalData()(as_docs([])).count() == 0
    assert pairs(PersonalData().redact(as_docs([(1, "a@b.co")] * 3)), "text") == [("<EMAIL>",)] * 3
