"""Token ids of whole texts with a public tokenizer: each different word is encoded once per batch and worker."""

import numpy as np
import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

from reelforge.llm.rawtext import Hasher, runs, utf8

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
CACHED_WORDS = 300_000
WORDS_AT_ONCE = 2_000
PIECE_BYTES = 1 << 20

# Byte classes of the tokenizer's word pattern (0 white space, 1 letter, 2 digit, 3 other, 9 not settled here).
_CLASS = np.full(256, 3, np.uint8)
_CLASS[:32] = 9
_CLASS[[9, 10, 13, 32]] = 0
_CLASS[48:58] = 2
_CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[127] = 9
_CLASS[128:192] = 1
_CLASS[192:] = 9
_CLASS[0xC3] = 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CONTRACTED = np.zeros(256, bool)
_CONTRACTED[[ord(letter) for letter in "strvmld"]] = True


class WordTokenizer:
    """Encodes Arrow columns of text exactly as ``Tokenizer.encode(text, add_special_tokens=False)`` does.

    The tokenizer lower-cases, drops white space and encodes each word by itself, so a word's ids can be kept. Texts
    of ASCII and Latin letters with accents are cut into words over their bytes; a text that holds anything else
    (other scripts, control characters, contractions, special tokens) is given to the tokenizer whole. Words are known
    by 64-bit hashes. At most ``CACHED_WORDS`` are kept from batch to batch; beyond that the store starts afresh.
    """

    def __init__(self, path: str = VOCABULARY) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.hasher = Hasher()
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.offsets = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and each text's range of ids (one more than texts)."""
        raw, limits = utf8(column)
        parts, counts, first = [np.zeros(0, np.uint32)], [], 0
        while first < len(limits) - 1:  # memory is bound by pieces of some MB, or one text
            last = max(first + 1, int(np.searchsorted(limits, limits[first] + PIECE_BYTES, "right")) - 1)
            piece = raw[limits[first] : limits[last]]
            ids, count = self._encode(piece, limits[first : last + 1] - limits[first])
            parts.append(ids)
            counts.append(count)
            first = last
        sizes = np.concatenate([[0], *counts]).astype(np.int64)
        return np.concatenate(parts), np.cumsum(sizes)

    def _encode(self, raw: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = len(limits) - 1
        odd = self._odd(raw, limits)
        kept = raw
        if odd.any():  # blank them here; they are encoded whole below
            kept = raw.copy()
            for at in np.flatnonzero(odd):
                kept[limits[at] : limits[at + 1]] = 32
        kept = _LOWER[kept]
        after = np.flatnonzero(kept[:-1] == 0xC3) + 1
        upper = after[(kept[after] <= 0x9E)]
        kept[upper] += 0x20
        starts, ends = runs(_CLASS[kept], limits, single=2)
        hashes = self.hasher(kept, starts, ends)
        codes, distinct = pd.factorize(hashes)
        slots = self._slots(distinct, codes, kept, starts, ends)
        slot_of = slots[codes] if len(codes) else np.zeros(0, np.int64)
        sizes = self.offsets[slot_of + 1] - self.offsets[slot_of]
        before = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(before[-1]) + np.repeat(self.offsets[slot_of] - before[:-1], sizes)
        ids = self.ids[places]
        limits_in_ids = before[np.searchsorted(starts, limits)]
        counts = np.diff(limits_in_ids)
        if odd.any():
            parts = [ids[limits_in_ids[i] : limits_in_ids[i + 1]] for i in range(texts)]
            for at in np.flatnonzero(odd):
                whole = bytes(raw[limits[at] : limits[at + 1]]).decode("utf-8", "replace")
                parts[at] = np.array(self.tokenizer.encode(whole, add_special_tokens=False).ids, np.uint32)
                counts[at] = len(parts[at])
            ids = np.concatenate(parts)
        return ids, counts

    def _odd(self, raw: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """Which texts the byte classes do not settle."""
        bad = _CLASS[raw] == 9
        if len(raw) > 1:
            lead = raw[:-1] == 0xC3
            bad[1:] |= lead & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))
            bad[1:] |= (raw[:-1] == 39) & _CONTRACTED[_LOWER[raw[1:]]]
            bad[1:] |= (raw[:-1] == 60) & (raw[1:] == 124)
        odd = np.zeros(len(limits) - 1, bool)
        odd[np.searchsorted(limits, np.flatnonzero(bad), "right") - 1] = True
        return odd

    def _slots(self, distinct, codes, raw, starts, ends) -> np.ndarray:
        if len(self.slot) > CACHED_WORDS:
            self._forget()
        slot = self.slot
        found = np.fromiter((slot.get(word, -1) for word in distinct.tolist()), np.int64, len(distinct))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            example = np.zeros(len(distinct), np.int64)
            example[codes[::-1]] = np.arange(len(codes))[::-1]
            lows, highs = starts[example[missing]].tolist(), ends[example[missing]].tolist()
            data = raw.tobytes()
            words = [data[low:high].decode() for low, high in zip(lows, highs)]
            ids, sizes = [self.ids], [np.diff(self.offsets)]
            for at in range(0, len(words), WORDS_AT_ONCE):
                some = words[at : at + WORDS_AT_ONCE]
                encoded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
                ids.append(np.array(encoded.ids, np.uint32))
                sizes.append(np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(some)))
            self.ids = np.concatenate(ids)
            sizes = np.concatenate(sizes)
            self.offsets = np.concatenate([[0], np.cumsum(sizes)])
            found[missing] = len(slot) + np.arange(len(missing))
            slot.update(zip(distinct[missing].tolist(), found[missing].tolist()))
        return found


_READY: dict[str, WordTokenizer] = {}


def tokenizer(path: str = VOCABULARY) -> WordTokenizer:
    """The worker's tokenizer, kept while the worker lives."""
    if path not in _READY:
        _READY[path] = WordTokenizer(path)
    return _READY[path]


def with_end(ids: np.ndarray, limits: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The end id appended to each text."""
    return np.insert(ids, limits[1:], np.uint32(end_id)), limits + np.arange(len(limits))
