"""Exact token ids of whole texts, encoded by rank-based BPE from the tokenizer's own file.

The ids are those the tokenizers library gives for the file.  Its merges and
vocabulary are handed to tiktoken, which merges the same pairs in the same order
several times faster, so that no cache of the corpus's words is needed and memory
does not depend on the texts.  Two kinds of file are taken that way:

* byte-level BPE whose blank is glued to the next word: the file's split pattern
  and its vocabulary as byte strings;
* BPE with an end-of-word suffix, lower case, white space dropped: the suffix is
  written as a NUL after every pre-token, and tokens that hold it end with a NUL
  (the pair of a word's last byte and the NUL has the lowest rank, so it is merged
  first, as the suffix belongs to that byte from the start).

A text goes to the library itself when it holds a special string, when the kind of
file is another one, and, for the second kind, when it holds a NUL, is not in
normal form C, has a letter whose lower case depends on its neighbours, or one so new that
the libraries' Unicode tables may differ.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array

from recoda.llm.common import single_threaded
from recoda.llm.tokens import UnitEncoder

CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"  # fixed values: the two split patterns of the tokenizers' files
GLUED_PATTERN = CONTRACTIONS + r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = CONTRACTIONS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def newer_letters() -> str:
    """Characters that are letters or numbers now, or were, but not both by Unicode 3.2: as ranges of a character class."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    now = {c: kind for kind in "LN" for c in regex.findall(rf"\p{{{kind}}}", every)}
    out, start = [], None
    for c in [*every, ""]:
        old = unicodedata.ucd_3_2_0.category(c)[0] if c else ""
        differs = bool(c) and now.get(c, "") != (old if old in "LN" else "")
        if differs and start is None:
            start = c
        elif not differs and start is not None:
            out.append(f"\\U{ord(start):08x}-\\U{ord(last):08x}")
            start = None
        last = c
    return "".join(out)


class Encoder:
    """Encodes whole texts with one tokenizer file."""

    def __init__(self, path: str):
        single_threaded()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = [re.escape(t["content"]) for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(special)) if special else None
        self.fast = self._fast(spec, {t["content"] for t in spec.get("added_tokens", [])})

    def _fast(self, spec: dict, special: set[str]):
        """A function from a text to its ids (None: the library must encode it), or None for other kinds of file."""
        import regex
        import tiktoken

        kind, model = UnitEncoder._kind(spec), spec["model"]
        suffix, byte = model.get("end_of_word_suffix") or "", byte_of_char()
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        made = [model["vocab"].get("".join(m)) for m in merges]
        if kind == "whole" or None in made or made != sorted(made):
            return None  # ranks are ids only if merges are numbered in their order

        def raw(token: str) -> bytes:
            ends = bool(suffix) and token.endswith(suffix)
            return bytes(byte[c] for c in (token[: -len(suffix)] if ends else token)) + b"\0" * ends

        ranks = {raw(t): i for t, i in model["vocab"].items() if t not in special}
        if kind == "blank_glued":
            if suffix:
                return None
            return tiktoken.Encoding("file", pat_str=GLUED_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]
        first = max((i for r, i in ranks.items() if len(r) == 1 or (len(r) == 2 and r.endswith(b"\0"))), default=0)
        if not suffix or split != {"Regex": WORD_PATTERN} or first > min(made, default=sys.maxsize):
            return None
        encode = tiktoken.Encoding("file", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        pieces = regex.compile(WORD_PATTERN).findall
        # letters and numbers that are newer than Unicode 3.2 may be unknown to one of the libraries
        latin, alone = re.compile("[\0\u0130\u0250-\U0010ffff]"), re.compile(f"[\0İΣ{newer_letters()}]")

        def words(text: str):
            if latin.search(text) and alone.search(text):
                return None
            if not text.isascii() and not unicodedata.is_normalized("NFC", text):
                return None
            return encode("\0".join([*pieces(text.lower()), ""]))

        return words

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text: its ids as little-endian unsigned 32-bit integers."""
        out = []
        for text in texts:
            ids = None
            if self.fast and not (self.special and self.special.search(text)):
                ids = self.fast(text)
            if ids is None:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            flat = array("I", ids)
            if sys.byteorder == "big":
                flat.byteswap()
            out.append(flat.tobytes())
        return out
