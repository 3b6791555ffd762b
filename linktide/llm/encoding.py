"""Texts to token ids with a public tokenizer file, one word at a time where that is exact."""

from __future__ import annotations

import json
from functools import cache

import numpy as np
from tokenizers import Tokenizer

from linktide.llm.common import LOWER, span_hashes

# What the word BPE file declares about white space, case, words and bytes.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
# Byte-level BPE writes printable Latin-1 bytes as themselves, the others from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_LETTER_OF = {b: chr(b) for b in _PRINTED} | {
    b: chr(0x100 + k) for k, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))
}

# Plain texts: printable ASCII without apostrophes, tab, line ends and the letters of
# Latin-1. For them the rules above need no Unicode tables.
_SPACE, _LETTER, _DIGIT, _SIGN = 0, 1, 2, 3
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[[9, 10, 13, 32]] = _SPACE
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[ord("a") : ord("z") + 1] = _LETTER
_KIND[0x80:] = _LETTER
_OTHER = np.ones(256, bool)
_OTHER[[9, 10, 13, *range(0x20, 0x7F), *range(0x80, 0xC0), 0xC3]] = False
_OTHER[ord("'")] = True


class TextEncoder:
    """Encodes whole texts; equal to the library's ``encode`` without special tokens.

    Words of plain texts are looked up by their 64-bit hash and length in a table of at
    most ``table_words`` words, which is emptied when full; the file's own BPE model
    encodes those that are missing. All other texts go through the library as a whole.
    """

    def __init__(self, path: str, table_words: int = 1_000_000):
        with open(path, encoding="utf-8") as file:
            declared = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        steps = (declared.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        special = [t["content"] for t in declared.get("added_tokens", [])]
        self.by_word = (
            declared.get("normalizer") == _NORMALIZER
            and steps[0].get("pattern") == {"Regex": _WORDS}
            and steps[0].get("behavior") == "Removed"
            and steps[1:] == [_BYTES]
            and all(s.startswith("<|") for s in special)
        )
        self.table_words = table_words
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.codes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Add words; ``hashes`` are theirs, ascending and not in the table yet."""
        found: list[int] = []
        ends = []
        for word in words:
            found += [t.id for t in self.tokenizer.model.tokenize("".join(map(_LETTER_OF.get, word)))]
            ends.append(len(found))
        place = np.searchsorted(self.known, hashes)
        codes = len(self.starts) - 1 + np.arange(len(words))
        self.known = np.insert(self.known, place, hashes)
        self.codes = np.insert(self.codes, place, codes)
        ends = np.array(ends, np.int64) + len(self.flat)
        self.starts = np.concatenate([self.starts, ends])
        self.flat = np.concatenate([self.flat, np.array(found, np.uint32)])

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, cuts)`` of lower-cased plain texts."""
        kind = _KIND[data]
        fresh = np.ones(len(data) + 1, bool)
        np.not_equal(kind[1:], kind[:-1], out=fresh[1:-1])
        fresh[:-1] |= kind == _DIGIT
        fresh[offsets] = True
        edges = np.flatnonzero(fresh)
        starts, ends = edges[:-1], edges[1:]
        worded = kind[starts] != _SPACE
        starts, ends = starts[worded], ends[worded]
        hashes, first, of = np.unique(
            span_hashes(data, starts, ends), return_index=True, return_inverse=True
        )
        if len(self.known) + len(hashes) > self.table_words:
            self._clear()
        place = np.minimum(np.searchsorted(self.known, hashes), max(0, len(self.known) - 1))
        new = np.flatnonzero(self.known[place] != hashes) if len(self.known) else np.arange(len(hashes))
        if len(new):
            raw = data.tobytes()
            spans = zip(starts[first[new]], ends[first[new]], strict=True)
            self._learn(hashes[new], [raw[a:b] for a, b in spans])
        codes = self.codes[np.searchsorted(self.known, hashes)][of]
        sizes = self.starts[codes + 1] - self.starts[codes]
        sums = np.concatenate([[0], np.cumsum(sizes)])
        place = np.arange(sums[-1]) + np.repeat(self.starts[codes] - sums[:-1], sizes)
        return self.flat[place], sums[np.searchsorted(starts, offsets)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids, as unsigned 32-bit integers, of each text ``data[offsets[i]:offsets[i + 1]]``."""
        n = len(offsets) - 1
        lowered = LOWER[data]
        after = np.flatnonzero(data[:-1] == 0xC3) + 1
        accent = data[after]
        capital = after[(accent < 0x9F) & (accent != 0x97)]
        lowered[capital] += 0x20
        other = _OTHER[data]
        other[after[(accent == 0x97) | (accent == 0xB7)]] = True
        other[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
        places = np.flatnonzero(other)
        whole = np.searchsorted(places, offsets[1:]) > np.searchsorted(places, offsets[:-1])
        if not self.by_word:
            whole[:] = True
        found: list[np.ndarray] = [np.zeros(0, np.uint32)] * n
        if not whole.all():
            # Texts of the other kind are blanked, so that they have no words here.
            for i in np.flatnonzero(whole):
                lowered[offsets[i] : offsets[i + 1]] = 0x20
            ids, cuts = self._plain(lowered, offsets)
            found = [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for i in np.flatnonzero(whole):
            text = data[offsets[i] : offsets[i + 1]].tobytes().decode()
            encoded = self.tokenizer.encode(text, add_special_tokens=False)
            found[i] = np.array(encoded.ids, np.uint32)
        return found


@cache
def encoder(path: str) -> TextEncoder:
    """One encoder per worker process and file."""
    return TextEncoder(path)
