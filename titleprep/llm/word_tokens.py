"""Token ids of whole texts by a tokenizer file, each distinct word encoded once.

White space separates words for the tokenizers meant here, so a text is cut at
spaces and line feeds and the pieces are looked up in a bounded memory.  In texts
of the first 256 code points, lower-casing and the tokenizer's own split into
letters, digits and signs can be done before the lookup, which makes far fewer
distinct words; their ids come from the tokenizer's model.  All other texts go
through the whole tokenizer, piece by piece; texts with the string of an added token
uncut.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Callable, Iterable

_REMEMBERED = 800_000
# the tokenizer's split pattern for the first 256 code points
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PARTS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\t-\r \x85\xa0{_LETTERS}{_NUMBERS}]+"
)


class _Remembered(dict):
    """Ids by piece of text; an unknown piece is encoded and remembered."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self._encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self._encode(piece)
        return ids

    def all(self, pieces: Iterable[str]) -> bytes:
        return b"".join(map(self.__getitem__, pieces))

    def bound(self, size: int) -> None:
        if len(self) > size:
            self.clear()


class WordTokens:
    """Encodes texts to little-endian unsigned 32-bit ids; one object per Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        whole = Tokenizer.from_file(path)
        # the strings of added tokens become their ids, as the library does by default
        self._added = [t.content.lower() for t in whole.get_added_tokens_decoder().values()]
        model = whole.model
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = {i: byte_level.pre_tokenize_str(chr(i)) for i in range(256)}
        letters = {i: found[0][0] for i, found in letters.items() if found}
        number = [i.to_bytes(4, "little") for i in range(whole.get_vocab_size(with_added_tokens=True))]

        def part(text: str) -> bytes:
            return b"".join([number[t.id] for t in model.tokenize(text.translate(letters))])

        def other(text: str) -> bytes:
            return b"".join([number[i] for i in whole.encode(text, add_special_tokens=False).ids])

        self._parts = _Remembered(part)
        self._simple = _Remembered(lambda piece: self._parts.all(_PARTS.findall(piece)))
        self._other, self._uncut = _Remembered(other), other

    def encode(self, text: str) -> bytes:
        lower = text.lower()
        if any(token in lower for token in self._added):
            return self._uncut(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            self._other.bound(_REMEMBERED // 4)
            return self._other.all(text.replace("\n", " ").split(" "))
        self._simple.bound(_REMEMBERED)
        self._parts.bound(_REMEMBERED // 2)
        return self._simple.all(lower.replace("\n", " ").split(" "))


@functools.lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)
