"""Token ids of whole texts by a word-level tokenizer of the ``tokenizers`` library.

Tokens of such a vocabulary never reach over white space, so a text's ids are its words' ids in a
row. Words repeat, so each Python worker encodes a word once and remembers its ids as bytes.

Where the tokenizer's file says that it splits words into runs of letters, single digits and runs of marks, in lower case, texts of
common Latin characters are split in the same way here, and the pieces, of which there are far fewer than words, are
remembered. All other texts go by words.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

#: Words, and parts of words, that a worker remembers before it starts anew; they bound its memory, not the result.
REMEMBERED, REMEMBERED_PARTS = 250_000, 700_000
#: Texts are cut at a space after about this many characters, so that a giant one is not a giant list of words.
STRETCH = 1_000_000
#: Pieces that are encoded in one go.
JOINED = 500
#: Marks that may stand behind a run of letters; an apostrophe may belong to it and so is not among them.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: How such a tokenizer's file describes its steps.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters beyond ASCII that stay one letter in lower case, and marks beyond ASCII.
LETTERS, OTHER_MARKS = "À-ÖØ-öø-įı-ňŊ-ž", "«»¿¡–—‘’“”„…€£°•"
_UNCOMMON = re.compile(f"[^\\x00-\\x7f{LETTERS}{OTHER_MARKS}]")
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LETTERS}]+|[0-9]|[^\\sa-z0-9{LETTERS}]+", re.ASCII)


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, followed by ``end_id``."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([end_id], "<u4").tobytes()
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        steps = [(told.get("normalizer") or {}).get("normalizers"), ((told.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0].get("pattern")]
        self.splits = steps == [NORMALIZERS, {"Regex": SPLIT}] and bool(told["model"].get("end_of_word_suffix"))
        self.special = [token["content"] for token in told.get("added_tokens") or []]
        if self.splits:
            suffix = told["model"]["end_of_word_suffix"]
            # pieces are normal and split already: only the byte level and the merges are left to do
            self.by_piece = Tokenizer.from_file(path)
            self.by_piece.encode_special_tokens = True
            self.by_piece.normalizer = normalizers.Sequence([])
            self.by_piece.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.last = np.zeros(self.by_piece.get_vocab_size(), bool)
            self.last[[i for token, i in self.by_piece.get_vocab().items() if token.endswith(suffix)]] = True

    def _split(self, text: str) -> list[str] | None:
        """The pieces of a text of common characters; None for any other text."""
        if not self.splits or not (text.isascii() or _UNCOMMON.search(text) is None) or any(token in text for token in self.special):
            return None
        return _PIECE.findall(text.lower())

    def _learn_pieces(self, pieces: set[str]) -> None:
        new = pieces.difference(self.pieces)
        if len(self.pieces) + len(new) > REMEMBERED:
            self.pieces.clear()
            new = pieces
        missing = list(new)
        joined = [" ".join(missing[i : i + JOINED]) for i in range(0, len(missing), JOINED)]
        found = [np.array(x.ids, "<u4") for x in self.by_piece.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.concatenate(found) if found else np.empty(0, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1  # every piece ends with a token that ends a word, and only there
        if len(ends) != len(missing):
            raise ValueError("the vocabulary's word ends do not tell pieces apart")
        data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        self.pieces.update((piece, data[i:j]) for piece, i, j in zip(missing, cuts[:-1], cuts[1:], strict=True))

    def _learn(self, words: set[str]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = words
        divided = {word: _divided(word) for word in new}
        parts = {part for both in divided.values() for part in both}
        if len(self.parts) + len(parts) > REMEMBERED_PARTS:
            self.parts.clear()
        missing = list(parts.difference(self.parts))
        for part, found in zip(missing, self.tokenizer.encode_batch_fast(missing, add_special_tokens=False), strict=True):
            self.parts[part] = np.array(found.ids, "<u4").tobytes()
        for word, (letters, marks) in divided.items():
            self.known[word] = self.parts[letters] + self.parts[marks]

    def encode(self, text: str | None) -> bytes:
        """All ids of one text; a null text is an empty one."""
        parts = []
        for stretch in _stretches(text or ""):
            pieces = self._split(stretch)
            if pieces is not None:
                self._learn_pieces(set(pieces))
                parts.append(b"".join(map(self.pieces.__getitem__, pieces)))
                continue
            words = stretch.replace("\n", " ").split(" ")
            self._learn(set(words))
            parts.append(b"".join(map(self.known.__getitem__, words)))
        return b"".join(parts) + self.end

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of many texts; the words of about one stretch are learned at a time."""
        group: list[str | None] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text or "")
            if size >= STRETCH:
                yield from self._encode_group(group, size)
                group, size = [], 0
        yield from self._encode_group(group, size)

    def _encode_group(self, group: list[str | None], size: int) -> Iterator[bytes]:
        if size <= 2 * STRETCH:
            split = [self._split(text or "") for text in group]
            self._learn_pieces(set().union(*(pieces for pieces in split if pieces is not None)))
            lists = [(text or "").replace("\n", " ").split(" ") if pieces is None else None for text, pieces in zip(group, split, strict=True)]
            self._learn(set().union(*(words for words in lists if words is not None)))
            for pieces, words in zip(split, lists, strict=True):
                known, row = (self.known, words) if pieces is None else (self.pieces, pieces)
                yield b"".join(map(known.__getitem__, row)) + self.end
        else:
            yield from map(self.encode, group)


def _divided(word: str) -> tuple[str, str]:
    """The letters of a word and the marks behind them; any other word is undivided."""
    letters = word.rstrip(MARKS)
    if not (letters.isalpha() and letters.lower().isalpha()):  # a letter can become one with a mark of its own
        return word, ""
    return letters.lower() if letters.isascii() else letters, word[len(letters) :]


def _stretches(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > STRETCH:
        cut = text.find(" ", start + STRETCH)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut + 1
    yield text[start:]


@lru_cache(maxsize=2)
def word_encoder(path: str, end_id: int) -> WordEncoder:
    """The encoder of this worker; workers are reused, and so is what they remember."""
    return WordEncoder(path, end_id)
