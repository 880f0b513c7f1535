import random

import pytest

VOWELS, CONSONANTS = "aeiouéü", "bcdfglmnprst"


@pytest.fixture(scope="session")
def prose():
    """Invented prose: prose(seed, words) is always the same text."""

    def make(seed, n):
        rng = random.Random(seed)
        names = ["".join(rng.choice(CONSONANTS) + rng.choice(VOWELS) for _ in range(rng.randint(1, 4))) for _ in range(400)]
        text = []
        for i in range(n):
            text.append(rng.choice(names).capitalize() if i % 11 == 0 else rng.choice(names))
        return " ".join(w + (".\n" if i % 13 == 12 else "") for i, w in enumerate(text))

    return make


@pytest.fixture(scope="session")
def hard_docs(prose):
    """(id, text): nulls, empty and blank texts, one very long text, copies, near copies, repeated rows."""
    base = [prose(i, 120) for i in range(6)]
    boiler = "This Line stands in many documents."
    docs = [(i, text) for i, text in enumerate(base)]
    docs += [(10 + i, base[0].replace(base[0].split()[7], f"changed{i}", 1)) for i in range(4)]
    docs += [(20 + i, base[1]) for i in range(3)]
    docs += [(30 + i, f"{prose(50 + i, 60)}\n  {boiler.upper() if i % 2 else boiler}\t\n{prose(60 + i, 30)}") for i in range(5)]
    docs += [(40, None), (41, ""), (42, " \t\n\x0b\x0c\r "), (43, "one"), (44, "one two"), (45, "\n\n\n")]
    docs += [(46, "Été À l'École 日本語 🎉 naïve\u00a0x\u2028y")] * 2
    docs += [(47, prose(99, 30_000)), (48, "a" * 5_000), (49, "ab " * 900), (None, base[2]), (None, None)]
    docs += [(50, f"{prose(70, 40)} {base[3][100:520]} {prose(71, 40)}"), (51, base[3][60:560])]
    return docs


CLASHING = {
    "n_lines": 7,
    "N_Dropped": 8,
    "_drop": 9,
    "_drop_id": 10,
    "_kept": 11,
    "kept": 12,
    "pii": 13,
    "_hits_email": 14,
    "_text": 15,
    "_id": 16,
    "h": 17,
    "ids": 18,
    "piece": 19,
    "length": 20,
}


@pytest.fixture(scope="session")
def as_docs(spark):
    """A DataFrame of (doc_id, text), optionally with columns named like those inside the operators."""

    def make(rows, clashing=False, partitions=3):
        schema = "doc_id long, text string"
        if clashing:
            rows = [(*r, *CLASHING.values()) for r in rows]
            schema += "".join(f", `{name}` long" for name in CLASHING)
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def pairs():
    """Rows of a DataFrame, sorted, as tuples of the named columns."""

    def get(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

    return get
