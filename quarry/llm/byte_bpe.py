"""Byte-level BPE ids of whole texts by the ``tokenizers`` library, with a cache of words.

The tokenizer's split pattern always begins a new piece at a space before something else than white space, after other
white space, and where a run of letters meets ASCII punctuation; merges never cross pieces.  So a text may be cut there
without a change of its ids, and words that come again are looked up.  Files whose pattern isn't that one are encoded
text by text.
"""
from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

CACHE, STRETCH = 1 << 20, 1 << 20
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTER = r"A-Za-zÀ-ÖØ-öø-ÿ"
_LETTERS = re.compile(rf" ?[{_LETTER}]+")
#: A word that ends before white space or punctuation; any other run without white space; white space but for a last
#: character before something else; that character.
_UNIT = re.compile(rf""" ?[{_LETTER}]++(?=[{_SPACE}.,;:!?"()'-]|\Z)| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]""")


class Words:
    """Cached encoder; one a Python worker and file."""

    _open: dict[tuple, "Words"] = {}

    def __init__(self, path: str, end_id: int | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), [] if end_id is None else [end_id]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        plain = all(" " not in t["content"] and not t.get("lstrip") and not t.get("rstrip") for t in spec.get("added_tokens", []))
        self.by_word = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and spec.get("normalizer") is None and plain
        self.known: dict[str, bytes] = {}
        # the character that stands for each byte in the model's vocabulary: printable Latin-1 itself, others from 256 on
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        self.shown = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}

    @classmethod
    def open(cls, path: str, end_id: int | None) -> "Words":
        if (path, end_id) not in cls._open:
            cls._open[path, end_id] = cls(path, end_id)
        return cls._open[path, end_id]

    def _pieces(self, text: str) -> list[str]:
        return _UNIT.findall(text) if self.by_word else [text] if text else []

    def _learn(self, new: set[str]) -> None:
        """Encodes pieces that aren't known yet: words of letters by the model alone, the others by the whole tokenizer."""
        known, model, letters, other = self.known, self.tokenizer.model.tokenize, _LETTERS.fullmatch, []
        for p in new:
            if letters(p):
                shown = p.replace(" ", self.shown[32]) if p.isascii() else p.encode().decode("latin-1").translate(self.shown)
                known[p] = array("I", [t.id for t in model(shown)]).tobytes()
            else:
                other.append(p)
        for i in range(0, len(other), 2000):
            part = other[i:i + 2000]
            got = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids, at = np.array(got.ids, dtype="<u4"), np.searchsorted(np.array(got.word_ids, dtype=np.int64), np.arange(len(part) + 1))
            known.update((p, ids[x:y].tobytes()) for p, x, y in zip(part, at[:-1].tolist(), at[1:].tolist(), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        end, out, at = np.array(self.end, dtype="<u4").tobytes(), [], 0
        while at < len(texts):  # some texts at a time, whole texts each
            size, split, every = 0, [], set()
            while at < len(texts) and size < STRETCH:
                split.append(self._pieces(texts[at]))
                every.update(split[-1])
                size += len(texts[at])
                at += 1
            if len(self.known) > CACHE:
                self.known.clear()
            self._learn(every.difference(self.known))
            get = self.known.__getitem__
            out += [np.frombuffer(b"".join(map(get, pieces)) + end, dtype="<u4") for pieces in split]
        return out
