"""Personal data: patterns propose spans, checksums confirm them, words nearby weigh them.

Everything is a native expression.  The texts between the matches of a pattern
(``split``) and the matches themselves (``regexp_extract_all``) together give the
places of the matches in code points, by prefix sums.  What stands at a place is read
from the text cut into blocks.  So the cost of a text grows with its length and its
matches, not with their product.

Kinds: email, ip, card (Luhn), phone, iban (mod 97) and ssn.  A span that passes
its check gets a score: its kind's own and a bonus when one of the kind's context
words stands shortly before or after it.  Spans of the four base kinds are reported
whatever their score; those of the other kinds need ``least_score``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleprep.llm.common import free_name

# The patterns of the base kinds; possessive where a shorter match could not succeed either,
# and starting only where the text before could not have been part of the match.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
}
# a text without this character class has no match
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+", "iban": None, "ssn": "-"}
BASE_KINDS = ("email", "ip", "card", "phone")
# score of a span that passes its check, and words that raise it
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT = {
    "email": r"e-?mail|contact|write\sto",
    "ip": r"\bip\b|address|host|server",
    "card": r"card|visa|credit|payment",
    "phone": r"phone|\btel\b|call|mobile|fax",
    "iban": r"iban|account|bank",
    "ssn": r"\bssn\b|social\ssecurity",
}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    digits = F.reverse(_digits(text))
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, place, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(place % 2 == 0, doubled).otherwise(digit)

    fits = F.length(digits).between(14, 19)
    return F.when(fits, F.aggregate(places, F.lit(0), add) % 10 == 0).otherwise(F.lit(False))


def _mod97(text: Column) -> Column:
    solid = F.replace(text, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(solid, F.lit(5)), F.substring(solid, 1, 4))

    def add(rest: Column, place: Column) -> Column:
        code = F.ascii(F.substring(moved, place, F.lit(1)))
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    places = F.sequence(F.lit(1), F.length(moved))
    return F.length(solid).between(15, 34) & (F.aggregate(places, F.lit(0), add) == 1)


def _small_parts(text: Column) -> Column:
    """Every part at most 255, however many zeros lead it."""

    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

    return F.forall(F.split(text, r"\."), small)


def _valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        return _small_parts(text)
    if kind == "card":
        return _luhn(text)
    if kind == "phone":
        return F.length(_digits(text)).between(10, 15)
    if kind == "iban":
        return _mod97(text)
    return F.lit(True)


_SPAN = "array<struct<start:int,kind_no:int,kind:string,end:int,text:string,score:double>>"
_BLOCK = 1_024  # code points
_STRIDES = [1 << i for i in range(31)]


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each place what ``join`` makes of all values up to it, in log2(size) passes over the array."""

    def widen(own: Column, stride: Column) -> Column:
        return F.transform(own, lambda x, i: join(x, F.coalesce(F.get(own, i - stride), F.lit(0))))

    strides = F.filter(F.array(*map(F.lit, _STRIDES)), lambda s: s < F.size(values))
    return F.aggregate(strides, values, widen)


def _blocks(text: Column) -> Column:
    """``text`` in blocks, so that a place in it is found without a walk from its beginning."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))


def _cut(blocks: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end`` (exclusive, may lie behind the text)."""
    first, last = F.floor(start / _BLOCK).cast("int"), F.floor(end / _BLOCK).cast("int")

    def block(i: Column) -> Column:
        return F.coalesce(F.get(blocks, i), F.lit(""))

    within = F.substring(block(first), start % _BLOCK + 1, end - start)
    inner = F.when(last - first > 1, F.array_join(F.slice(blocks, first + 2, last - first - 1), ""))
    across = F.concat(
        F.substring(block(first), start % _BLOCK + 1, F.lit(_BLOCK)),
        F.coalesce(inner, F.lit("")),
        F.substring(block(last), F.lit(1), end % _BLOCK),
    )
    return F.when(end <= start, F.lit("")).when(first == last, within).otherwise(across)


def _spans(kind_no: int, kind: str, found: Column, blocks: Column, near: int) -> Column:
    """Valid spans of one kind; ``found`` has the fields ``gaps`` and ``hits``."""
    empty = F.array().cast(_SPAN)

    def of(state: Column) -> Column:
        hits, ends = state["hits"], state["ends"]

        def span(hit: Column, i: Column) -> Column:
            end = F.get(ends, i)
            return F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("text"))

        def scored(s: Column) -> Column:
            # what stands around the span, whatever matched in between
            before = F.lower(_cut(blocks, F.greatest(s["start"] - near, F.lit(0)), s["start"]))
            after = F.lower(_cut(blocks, s["end"], s["end"] + near))
            told = before.rlike(CONTEXT[kind]) | after.rlike(CONTEXT[kind])
            score = F.lit(SCORES[kind]) + F.when(told, 0.4).otherwise(0.0)
            return F.struct(
                s["start"].alias("start"),
                F.lit(kind_no).alias("kind_no"),
                F.lit(kind).alias("kind"),
                s["end"].alias("end"),
                s["text"].alias("text"),
                F.least(score, F.lit(1.0)).alias("score"),
            )

        valid = F.filter(F.transform(hits, span), lambda s: _valid(kind, s["text"]))
        return F.transform(valid, scored)

    def placed(state: Column) -> Column:
        gaps, hits = state["gaps"], state["hits"]
        lengths = F.transform(hits, lambda hit, i: F.length(hit) + F.length(F.get(gaps, i)))
        ends = _bound(lengths, lambda own: _running(own, lambda a, b: a + b))
        return F.struct(hits.alias("hits"), ends.alias("ends"))

    spans = _bound(found, lambda state: _bound(placed(state), of))
    return F.when(F.size(found["hits"]) > 0, spans).otherwise(empty)


@dataclass(frozen=True)
class PersonalData:
    """Adds ``pii``, the spans of each text in order of start and kind; other columns stay.

    A span has kind, start and end in code points (end exclusive), text and score.
    Null and empty texts have no spans.  Every row is judged by itself, so repeated
    rows and ties need no rule; an empty table gives an empty table.  A column named
    ``pii`` is replaced.  Within a kind spans do not overlap, across kinds they may.
    """

    least_score: float = 0.7
    near: int = 40
    text_col: str = "text"

    def __call__(self, docs: DataFrame) -> DataFrame:
        text = F.col(f"`{self.text_col}`")
        found = docs
        names = {kind: free_name(docs, f"_hits_{kind}") for kind in PATTERNS}
        blocks = free_name(docs, "_blocks")
        for kind, pattern in PATTERNS.items():
            hint = F.lit(True) if HINTS[kind] is None else F.contains(text, F.lit(HINTS[kind]))
            hits = F.when(hint, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
            found = found.withColumn(names[kind], hits)
        lists = []
        for kind, pattern in PATTERNS.items():
            hits = F.col(names[kind])
            found_kind = F.struct(
                F.when(F.size(hits) > 0, F.split(text, pattern, -1)).alias("gaps"), hits.alias("hits")
            )
            found = found.withColumn(names[kind], found_kind)
        some = F.greatest(*[F.size(F.col(name)["hits"]) for name in names.values()]) > 0
        found = found.withColumn(blocks, F.when(some, _blocks(text)))
        for kind_no, kind in enumerate(PATTERNS):
            lists.append(_spans(kind_no, kind, F.col(names[kind]), F.col(blocks), self.near))
        spans = F.filter(
            F.flatten(F.array(*lists)),
            lambda s: (s["kind_no"] < len(BASE_KINDS)) | (s["score"] >= self.least_score),
        )
        spans = F.transform(
            F.array_sort(spans), lambda s: F.struct(s["kind"], s["start"], s["end"], s["text"], s["score"])
        )
        return found.withColumn("pii", spans).drop(blocks, *names.values())

    def redact(self, docs: DataFrame) -> DataFrame:
        """``docs`` with every span replaced by its kind in angle brackets.

        Spans that overlap are replaced together, by the kind of the first.
        """
        text = F.col(f"`{self.text_col}`")

        def replaced(state: Column) -> Column:
            spans, reach, blocks = state["spans"], state["reach"], state["blocks"]
            count = F.size(spans)

            def piece(span: Column, i: Column) -> Column:
                # what stands between the spans before and this one, and the tag
                before = F.coalesce(F.get(reach, i - 1), F.lit(0))
                tag = F.concat(F.lit("<"), F.upper(span["kind"]), F.lit(">"))
                return F.when(span["start"] >= before, F.concat(_cut(blocks, before, span["start"]), tag))

            rest = _cut(blocks, F.get(reach, count - 1), F.size(blocks) * _BLOCK)
            return F.concat(F.array_join(F.transform(spans, piece), ""), rest)

        ends = F.transform("pii", lambda span: span["end"])
        reach = _bound(ends, lambda own: _running(own, F.greatest))
        state = F.struct(F.col("pii").alias("spans"), reach.alias("reach"), _blocks(text).alias("blocks"))
        clean = _bound(state, replaced)
        marked = self(docs)
        redacted = marked.withColumn(
            self.text_col, F.when(F.size("pii") > 0, clean).otherwise(text)
        )
        return redacted.drop("pii")
