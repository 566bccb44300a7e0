"""Exact token ids of whole texts through a cache of white-space units.

The two supported tokenizers never let a pre-token cross white space: the word
BPE drops white space, the byte-level BPE glues one blank to the word after it.
So the ids of a text are the ids of its units, one after the other, and a unit
met before needs no second encoding.  Texts that hold a special string go to the
library whole, as do all texts of a tokenizer of any other kind.
"""

from __future__ import annotations

import json
import re

from recoda.llm.common import single_threaded

# Unicode White_Space, the class that the tokenizers' patterns call \s
# (Python's own \s and str.split() also take the four separators x1c-x1f).
WS = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_SEPARATORS = re.compile("[\x1c-\x1f]")
_BEYOND_LATIN = re.compile("[\u0130\u0250-\U0010ffff]")
_WORDS = re.compile(f"[^{WS}]+")
_BLANK_GLUED = re.compile(f" ?[^{WS}]+|[{WS}]+(?![^{WS}])|[{WS}]+")


class UnitEncoder:
    """Encodes texts of one tokenizer file; keeps two generations of about ``max_units`` cached units."""

    def __init__(self, path: str, max_units: int = 250_000):
        single_threaded()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = [re.escape(t["content"]) for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(special)) if special else None
        plain = [t for t in spec.get("added_tokens", []) if not (t["lstrip"] or t["rstrip"] or t["single_word"])]
        self.separator = plain[-1]["content"] if plain and not plain[-1]["normalized"] else None
        self.kind = self._kind(spec)
        self.max_units = max_units
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def _kind(spec: dict) -> str:
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
            return "blank_glued"
        steps = [s.get("type") for s in pre.get("pretokenizers", [])]
        split = (pre.get("pretokenizers") or [{}])[0]
        norms = [s.get("type") for s in norm.get("normalizers", [])]
        if (
            steps == ["Split", "ByteLevel"]
            and split.get("behavior") == "Removed"
            and split.get("invert")
            and norms == ["NFC", "Replace", "Lowercase"]
            and not pre["pretokenizers"][1].get("use_regex")
            and not pre["pretokenizers"][1].get("add_prefix_space")
        ):
            return "words"
        return "whole"

    def units(self, text: str) -> list[str] | None:
        """The units of a text; None when only the library may cut it."""
        if self.kind == "whole" or (self.special and self.special.search(text)):
            return None
        if self.kind == "blank_glued":
            return _BLANK_GLUED.findall(text)
        if not _BEYOND_LATIN.search(text):
            text = text.lower()  # as the tokenizer lowers it, character by character
        return _WORDS.findall(text) if _SEPARATORS.search(text) else text.split()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def unit_ids(self, units: list[str]) -> list[bytes]:
        """Ids of each unit, as bytes.

        Units are joined by a special token (no unit holds one), which the library
        cuts out before anything else, and encoded as one text: that costs far
        less than a text for each.
        """
        import numpy as np

        if self.separator is None:
            return [np.asarray(ids, "<u4").tobytes() for ids in self._ids(units)]
        out: list[bytes] = []
        mark = self.tokenizer.token_to_id(self.separator)
        for i in range(0, len(units), 1000):
            ids = np.asarray(self._ids([self.separator.join(units[i : i + 1000])])[0], "<u4")
            cuts, flat = (4 * np.flatnonzero(ids == mark)).tolist(), ids.tobytes()
            out += [flat[a:b] for a, b in zip([0, *[c + 4 for c in cuts]], [*cuts, len(flat)], strict=True)]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text: its ids as little-endian unsigned 32-bit integers."""
        import numpy as np

        if len(self.cache) > self.max_units:
            self.cache, self.older = {}, self.cache  # units met again move back from the older generation
        cache, split = self.cache, [self.units(t) for t in texts]
        fresh = set().union(*(u for u in split if u is not None)).difference(cache)
        again = fresh.intersection(self.older)
        cache.update(zip(again, map(self.older.__getitem__, again), strict=True))
        fresh = list(fresh.difference(again))
        cache.update(zip(fresh, self.unit_ids(fresh), strict=True))
        out = []
        for text, u in zip(texts, split, strict=True):
            if u is None:
                out.append(np.asarray(self._ids([text])[0], "<u4").tobytes())
            else:
                out.append(b"".join(map(cache.__getitem__, u)))
        return out
