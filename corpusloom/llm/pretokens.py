"""Cutting a text into pre-tokens exactly as a byte-level BPE tokenizer file asks for.

Texts of plain ASCII and Latin letters (nearly all of most corpora) are cut with one compiled
expression; its classes list what the file's pattern means on that range. Any other text goes to
the tokenizer library's own pre-tokenizer. Strings of added special tokens are cut out first.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(rf"[\t\n\r\x20-\x7e{_LETTER}]*")
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+", re.ASCII)
#: Above this length pre-tokens are produced one by one, so that no list of all of them is held.
LONG = 4_000_000


class Splitter:
    def __init__(self, path: str):
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, added = spec["pre_tokenizer"], spec["added_tokens"]
        if pre != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} or spec["normalizer"] is not None:
            raise ValueError("not a plain byte-level tokenizer file")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that strip or stand alone are not supported")
        self.special_ids = {t["content"]: t["id"] for t in added}
        names = sorted(self.special_ids, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self._markers = names
        self._library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """Parts of the text and whether each is a special token's string."""
        if self._special is None or not any(m in text for m in self._markers):
            if text:
                yield text, False
            return
        for k, part in enumerate(self._special.split(text)):
            if part:
                yield part, bool(k % 2)

    def pieces(self, segment: str):
        """The pre-tokens of a segment without special tokens, in order."""
        if _PLAIN.fullmatch(segment):
            return _PIECE.findall(segment) if len(segment) <= LONG else (m.group() for m in _PIECE.finditer(segment))
        return [segment[a:b] for _, (a, b) in self._library.pre_tokenize_str(segment)]
