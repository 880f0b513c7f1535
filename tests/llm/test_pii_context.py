"""Context words count wherever they stand near a span."""

from titleprep.llm.pii import PersonalData

A, B = "123-45-6789", "987-65-4321"


def test_context_reaches_over_matches_and_behind(as_docs):
    far = " " + "x" * 60 + " "
    texts = [
        (f"Social security numbers: {A}, {B}", [A, B]),
        (f"é🎉 {A} (SSN)", [A]),
        (f"part {A}, {B}", []),
        (f"ssn{far}{A}{far}ssn", []),
        (f"ssn {A}{far}{B}", [A]),
    ]
    rows = PersonalData()(as_docs([(i, t) for i, (t, _) in enumerate(texts)])).collect()
    for r in rows:
        text, expected = texts[r["doc_id"]]
        assert [s["text"] for s in r["pii"] if s["kind"] == "ssn"] == expected, text
        assert all(s["text"] == text[s["start"] : s["end"]] for s in r["pii"])


def test_redaction_leaves_no_number_of_a_list(as_docs):
    got = PersonalData().redact(as_docs([(1, f"SSN: {A}, {B}")])).collect()
    assert [r["text"] for r in got] == ["SSN: <SSN>, <SSN>"]
