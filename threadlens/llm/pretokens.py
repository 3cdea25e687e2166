"""Token ids by way of pre-tokens, for tokenizers whose merges never cross a pre-token.

The library encodes each distinct pre-token once per worker; a text is then a pattern match and look-ups. Results equal
the library's on the whole text:

* strings of added tokens are cut out first, as the library does;
* texts of Latin letters and usual punctuation take a plain `re` pattern;
* others take the same pattern with Unicode classes, unless they hold a character whose class may differ between Unicode
  versions; those go to the library whole;
* a tokenizer of any other make goes to the library whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import unicodedata
from array import array

import numpy as np

#: Patterns of the two supported makes, as their files state them. Must equal the files.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?<L>+| ?<N>+| ?[^<s><l><n>]+|[<s>]+(?![^<s>])|[<s>]+"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|<L>+|<N>|[^<s><l><n>]+"
WORDS_IN_FILE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORDS_NORMALIZER = ["NFC", ("Replace", r"\s+", " "), "Lowercase"]

LATIN = {"l": "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f", "n": "0-9", "s": r"\t-\r \xa0"}
#: Anything but ASCII, the letters above, and punctuation that is neither letter, number nor space.
NOT_LATIN = re.compile("[^\x00-\x7f\xa0\xa1\xa7\xab\xb0\xb7\xbb\xbf\xd7\xf7" + LATIN["l"] + "\u2010-\u2027\u2030-\u205e\u20ac]")
UNICODE = {"l": r"\p{L}", "n": r"\p{N}", "s": r"\p{White_Space}"}


def _byte_chars() -> dict[int, str]:
    """How byte-level tokenizers show a byte: visible Latin-1 characters as such, the others from U+0100 on, in order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(0x100 + i) for i, b in enumerate(hidden)}


BYTE_CHARS = _byte_chars()


def _fill(pattern: str, classes: dict[str, str]) -> str:
    for name, chars in {**classes, "L": f"[{classes['l']}]", "N": f"[{classes['n']}]"}.items():
        pattern = pattern.replace(f"<{name}>", chars)
    return pattern


def _unsettled() -> re.Pattern:
    """Characters that Unicode 3.2 lacked or classed otherwise."""

    def kind(category: str) -> str:
        return category[0] if category[0] in "LNZ" else "-"

    old, ranges, start = unicodedata.ucd_3_2_0, [], None
    for code in range(0x110001):
        odd = False
        if code < 0x110000:
            was, now = old.category(chr(code)), unicodedata.category(chr(code))
            odd = was == "Cn" or kind(was) != kind(now)
        if odd and start is None:
            start = code
        elif not odd and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return re.compile("[" + "".join(ranges) + "]")


def _make(config: dict) -> str | None:
    """Which supported make a tokenizer file is of, or None."""
    plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in config["added_tokens"])
    if not plain or config["model"]["type"] != "BPE" or config["truncation"] or config["padding"]:
        return None
    before, normal = config["pre_tokenizer"] or {}, config["normalizer"]
    if before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and not normal:
        return "bytes"
    if before.get("type") != "Sequence" or (normal or {}).get("type") != "Sequence":
        return None
    split, level = (before["pretokenizers"] + [{}, {}])[:2]
    steps = [("Replace", n["pattern"].get("Regex"), n["content"]) if n["type"] == "Replace" else n["type"] for n in normal["normalizers"]]
    if (
        len(before["pretokenizers"]) == 2 and split.get("type") == "Split" and split["pattern"] == {"Regex": WORDS_IN_FILE}
        and split["behavior"] == "Removed" and split["invert"] and level.get("type") == "ByteLevel"
        and not level["use_regex"] and not level["add_prefix_space"] and steps == WORDS_NORMALIZER
    ):
        return "words"
    return None


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker and is shared by the tasks it runs."""
    return sys.modules.setdefault("_threadlens_worker_state", types.ModuleType("_threadlens_worker_state")).__dict__


class Encoder:
    """Token ids of texts as little-endian bytes of `dtype`. At most `cache_size` pre-tokens are remembered."""

    def __init__(self, path: str, dtype: str = "<u4", cache_size: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already fill the cores; its threads would only spin
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        config = json.loads(self.library.to_str())
        self.dtype, self.width, self.cache_size = dtype, np.dtype(dtype).itemsize, cache_size
        self.code = {2: "H", 4: "I"}[self.width]  # of the array module, whose small arrays are cheaper than NumPy's
        if np.dtype(dtype).itemsize < 4 and self.library.get_vocab_size() > 1 << 16:
            raise ValueError("the vocabulary does not fit the id type")
        self.make = _make(config)
        self.added = {t["content"]: t["id"] for t in config["added_tokens"] if t["content"]}
        self.cut = re.compile("(" + "|".join(sorted(map(re.escape, self.added), key=len, reverse=True)) + ")") if self.added else None
        if self.make:
            shape = BYTE_LEVEL if self.make == "bytes" else WORDS
            self.latin = re.compile(_fill(shape, LATIN)).findall
            self.unicode = regex.compile(_fill(shape, UNICODE)).findall
            self.unsettled: re.Pattern | None = None
        self.model = self.library.model
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def pretokens(self, segment: str) -> list[str] | None:
        """The pre-tokens of a text without added tokens, or None where the library must see it whole."""
        if not self.make:
            return None
        if NOT_LATIN.search(segment) is None:
            return self.latin(segment.lower() if self.make == "words" else segment)
        if self.make == "words":  # its normaliser is the library's affair beyond Latin
            return None
        self.unsettled = self.unsettled or _unsettled()
        return None if self.unsettled.search(segment) else self.unicode(segment)

    def segments(self, text: str) -> list[str]:
        """Alternately plain text and strings of added tokens."""
        if self.cut is None or not any(s in text for s in self.added):
            return [text]
        return self.cut.split(text)

    def _bytes(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def fresh(self, pretokens: list[str]) -> list[bytes]:
        """Ids of pre-tokens by the library's merge model, which is what remains to be done to a pre-token.

        A call of the model costs a quarter of one that normalises and splits again.
        """
        merge = self.model.tokenize
        shown = (w.encode().decode("latin-1").translate(BYTE_CHARS) for w in pretokens)
        return [self._bytes([t.id for t in merge(w)]) for w in shown]

    def whole(self, segment: str) -> bytes:
        return self._bytes(self.library.encode(segment, add_special_tokens=False).ids)

    def learn(self, missing: set[str]) -> dict[str, bytes]:
        """Ids of pre-tokens that the cache lacks; they enter it. Half the cache is kept when it is full, the used half."""
        if len(self.cache) + len(missing) > self.cache_size // 2:
            self.cache, self.older = {}, self.cache
        found = {w: self.older[w] for w in missing if w in self.older}
        words = [w for w in missing if w not in found]
        found.update(zip(words, self.fresh(words) if words else ()))
        self.cache.update(found)
        return found

    def encode(self, text: str) -> bytes:
        out = []
        for i, segment in enumerate(self.segments(text)):
            if i % 2:
                out.append(self._bytes([self.added[segment]]))
                continue
            if not segment:
                continue
            words = self.pretokens(segment)
            if words is None:
                out.append(self.whole(segment))
                continue
            ids = list(map(self.cache.get, words))
            if None in ids:
                found = self.learn({w for w, x in zip(words, ids) if x is None})
                ids = [found[w] if x is None else x for w, x in zip(words, ids)]
            out.extend(ids)
        return b"".join(out)


def encoder(path: str, dtype: str = "<u4") -> Encoder:
    """The worker's encoder for a file; its cache serves all tasks of the worker."""
    kept = worker_state().setdefault("encoders", {})
    key = (path, dtype)
    if key not in kept:
        kept[key] = Encoder(path, dtype)
    return kept[key]
