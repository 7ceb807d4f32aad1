"""Encoding whole texts fast, with the very ids that the tokenizers' own libraries give.

A regular text has white space only as single characters between others, and letters of the Latin blocks only. There

* the splitting pattern of a byte-level vocabulary needs no look-ahead, without which its library matches faster;
* a piece vocabulary, none of whose pieces holds a space after another character (looked up when the model is
  loaded), gives each word the same ids wherever it stands. Where both kinds are asked for, words are encoded when a
  worker first meets them, those of a text together; the memory for known words is bounded.

Any other text goes to its library as a whole.
"""

from __future__ import annotations

import re

import numpy as np

from reportgrid.llm.bpe import PATTERN, Encoder
from reportgrid.llm.tables import remembered

#: Known words: some 150 MB.
MOST_WORDS = 600_000
#: Ids that are compared with their text at once.
PART = 1 << 18
#: A byte in a piece vocabulary: fixed value of the format.
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def regular(data: bytes) -> bool:
    """Whether no white space stands beside other white space or at an end, and no letter is beyond the Latin blocks."""
    codes = np.frombuffer(data, np.uint8)
    if not len(codes) or codes.max() >= 0xC9 or b"\xc2\x85" in data or b"\xc2\xa0" in data:
        return False
    gap = (codes == 32) | ((codes >= 9) & (codes <= 13))
    return not (gap[0] or gap[-1] or (gap[1:] & gap[:-1]).any())


class ByteLevel:
    """Ids by a byte-level vocabulary file; special tokens are recognised, or taken as plain text."""

    def __init__(self, vocabulary: str, plain: bool = False):
        import tiktoken

        by = Encoder(vocabulary)
        self.bytes_of, self.length_of = by.bytes_of, by.length_of
        self.whole, self.plain = by.whole, plain
        self.whole.encode_special_tokens = plain
        self.latin = by.fast.encode_ordinary
        self.regular = tiktoken.Encoding(
            "regular", pat_str=PATTERN.replace(r"\s+(?!\S)|", ""), mergeable_ranks=by.fast._mergeable_ranks, special_tokens={}
        ).encode_ordinary

    def encode(self, text: str) -> np.ndarray:
        data = text.encode()
        if (not self.plain and "<|" in text) or (data and np.frombuffer(data, np.uint8).max() >= 0xC9):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            # a space at the start begins a word like any other
            ids = self.regular(text) if regular(data.removeprefix(b" ")) else self.latin(text)
        return np.array(ids, np.uint32)

    def encode_after_space(self, text: str) -> np.ndarray:
        return self.encode(" " + text)


class Pieces:
    """Ids by a piece vocabulary (BPE with byte fallback) that puts a space before each text."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.by = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.by.id_to_piece(n) for n in range(self.by.get_piece_size())]
        self.bytes_of = []
        for name in names:
            as_byte = BYTE_PIECE.fullmatch(name)
            self.bytes_of.append(bytes([int(as_byte[1], 16)]) if as_byte else name.replace("▁", " ").encode())
        self.length_of = np.array([len(b) for b in self.bytes_of], np.int64)
        #: whether no piece holds a space after another character
        self.by_word = not any("▁" in name.lstrip("▁") for name in names)

    def encode_after_space(self, text: str) -> np.ndarray:
        return np.array(self.by.encode(text), np.uint32)


class Letters:
    """The texts of ids, one after the other."""

    def __init__(self, by: ByteLevel | Pieces):
        self.all = np.frombuffer(b"".join(by.bytes_of), np.uint8)
        self.length, self.start = by.length_of, np.cumsum(by.length_of) - by.length_of

    def spell(self, ids: np.ndarray, data: bytes) -> bool:
        """Whether the ids are the text ``data``; looked at in parts, so that a long text takes little memory."""
        codes = np.frombuffer(data, np.uint8)
        low = 0
        for part in range(0, len(ids), PART):
            some = ids[part : part + PART]
            n = self.length[some]
            high = low + int(n.sum())
            if high > len(codes) or (self.all[np.arange(high - low) + _apart(self.start[some], n)] != codes[low:high]).any():
                return False
            low = high
        return low == len(codes)


def _apart(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What to add to 0, 1, 2, ... to get the positions of stretches one after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


class Side:
    """The ids of known words by one tokenizer, as one list with the place of each word."""

    def __init__(self, by: ByteLevel | Pieces):
        self.by, self.letters = by, Letters(by)
        self.ids = np.zeros(0, np.int32)
        self.start, self.length = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.spelled = np.zeros(0, bool)

    def learn(self, words: list[str]) -> None:
        text = " ".join(words)
        ids = self.by.encode_after_space(text)
        if self.letters.spell(ids, b" " + text.encode()):
            ends = np.cumsum(self.by.length_of[ids])
            until = np.cumsum([len(word.encode()) + 1 for word in words])
            lengths, spelled = np.diff(np.searchsorted(ends, until, "right"), prepend=0), np.ones(len(words), bool)
        else:
            parts = [self.by.encode_after_space(word) for word in words]
            ids, lengths = np.concatenate(parts), np.array([len(p) for p in parts])
            spelled = np.array([self.letters.spell(p, b" " + word.encode()) for p, word in zip(parts, words)])
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.spelled = np.concatenate([self.spelled, spelled])

    def tokens(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of the words with these numbers, one after the other."""
        n = self.length[numbers]
        return self.ids[np.arange(n.sum()) + _apart(self.start[numbers], n)]


class Words:
    """The ids that both tokenizers give to a space and a word, for the words of regular texts."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.of = a, b
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.sides = tuple(Side(by) for by in self.of)

    def numbers(self, words: list[str]) -> np.ndarray:
        """The numbers of the words in this table, which is begun anew when it gets too large."""
        found = list(map(self.known.get, words))
        places = [k for k, n in enumerate(found) if n is None]
        if places:
            missing = list(dict.fromkeys([words[k] for k in places]))
            if self.known and len(self.known) + len(missing) > MOST_WORDS:
                self._clear()
                return self.numbers(words)
            for side in self.sides:
                side.learn(missing)
            self.known |= zip(missing, range(len(self.known), len(self.known) + len(missing)))
            for k in places:
                found[k] = self.known[words[k]]
        return np.array(found, np.int32)


def byte_level(vocabulary: str, plain: bool = False) -> ByteLevel:
    return remembered(f"byte level {plain} {hash(vocabulary)}", lambda: ByteLevel(vocabulary, plain))


def pieces(model: bytes) -> Pieces:
    return remembered(f"pieces {hash(model)}", lambda: Pieces(model))
