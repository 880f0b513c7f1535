"""Token ids of whole texts by a byte-level tokenizer file of the ``tokenizers`` library.

Where the file is a plain byte-level model whose merges stand in the order of their
ids, ``tiktoken`` gives the same ids several times faster; any other file is read by
``tokenizers`` itself.  Strings of added tokens in a text become their ids, as that
library does by default.
"""

from __future__ import annotations

import functools
import json
import os

import numpy as np

# fixed value: the split pattern of the byte-level pre-tokenizer
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Ranks by bytes, or None where ids do not follow the order of merges."""
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = (
        model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and spec["normalizer"] is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and all(t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
    )
    if not plain:
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = [model["vocab"].get(a + b, -1) for a, b in merges]
    letters = _byte_letters()
    bases = [model["vocab"].get(letter, -1) for letter in letters]
    added = {t["content"] for t in spec["added_tokens"]}
    learned = {t: i for t, i in model["vocab"].items() if t not in added}
    ordered = all(a < b for a, b in zip([max(bases), *merged], merged))
    if min(bases) < 0 or not ordered or len(learned) != len(bases) + len(merged):
        return None
    return {bytes(letters[c] for c in t): i for t, i in learned.items()}


class ByteTokens:
    """Encodes texts to arrays of unsigned 32-bit ids; one object per Python worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ranks = _ranks(spec)
        self.ids = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        if ranks is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(path)
            self.encode = lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)
        else:
            import tiktoken

            added = {t["content"]: t["id"] for t in spec["added_tokens"]}
            coder = tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=added)
            self.encode = lambda text: coder.encode_to_numpy(text, allowed_special="all")


@functools.lru_cache(maxsize=2)
def byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)
