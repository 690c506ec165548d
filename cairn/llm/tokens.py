"""Whole-text encoding with a public word-level BPE file, through a bounded word cache.

The tokenizer file lower-cases, drops white space and splits text into letter
runs, single digits and symbol runs; BPE then works inside each of those
pre-tokens alone.  So the ids of a pre-token, and of a run of them without white
space, can be looked up, and only new
pre-tokens go through the library, many in one call.  Texts with characters
outside the plain set, or with special-token strings, go through the library
whole; both paths give the same ids.
"""

from __future__ import annotations

import re

import numpy as np

DEFAULT_VOCAB = "word_bpe_49k.json"

#: Characters whose lower-casing, composition and classes are the same in both engines.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xa9\xab-\xac\xae-\xb1\xb4\xb6-\xb8\xbb\xbf-\xff]*")
#: The file's pre-token pattern, for lower-cased texts of those characters.
_SPLIT = re.compile(r"[a-zß-öø-ÿ]+|\d|'(?:s|t|re|ve|m|ll|d)|[^\sa-zß-öø-ÿ\d]+")

_ENCODERS: dict[tuple[str, int], "WordEncoder"] = {}


def vocab_path(name: str = DEFAULT_VOCAB) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, cache_words: int = 250_000) -> "WordEncoder":
    """The Python worker's encoder for that file, loaded once."""
    key = (path, cache_words)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path, cache_words)
    return _ENCODERS[key]


class _Index(dict):
    """Word -> number; an unknown word gets the next number and is noted."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class _Ids:
    """The ids of numbered keys, one after the other."""

    def __init__(self):
        self.index = _Index()
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.begin = np.zeros(1 << 14, dtype=np.int64)
        self.size = np.zeros(1 << 14, dtype=np.int32)
        self.used = 0

    def add(self, ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        """Ids of the newest ``len(size)`` keys, in order."""
        n = len(self.index) - len(size)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while n + len(size) > len(self.begin):
            self.begin = np.concatenate((self.begin, np.zeros_like(self.begin)))
            self.size = np.concatenate((self.size, np.zeros_like(self.size)))
        self.flat[self.used : self.used + len(ids)] = ids
        self.begin[n : n + len(size)] = begin + self.used
        self.size[n : n + len(size)] = size
        self.used += len(ids)

    def of(self, at: np.ndarray) -> np.ndarray:
        begin, size = self.begin[at], self.size[at]
        ends = np.cumsum(size, dtype=np.int64)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)]

    def forget(self, known: int, used: int) -> None:
        """A full cache keeps what it had; the last block's new keys go."""
        while len(self.index) > known:
            self.index.popitem()
        self.used = used


class WordEncoder:
    """Ids of whole texts as unsigned 32-bit arrays, as ``encode(text, add_special_tokens=False)``.

    Two caches: pre-tokens, and runs between white space, which are looked up
    whole.  No pre-token crosses white space, so a run's ids are those of its own.
    """

    #: Characters that are split before their new words are encoded in one call.
    BLOCK_CHARS = 1_000_000

    def __init__(self, path: str, cache_words: int = 250_000):
        from tokenizers import Tokenizer

        self.raw = Tokenizer.from_file(path)
        self.cache_words = cache_words
        vocab = self.raw.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.special = [t.content for t in self.raw.get_added_tokens_decoder().values()]
        self.words, self.runs = _Ids(), _Ids()

    def _plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def whole(self, text: str) -> np.ndarray:
        return np.asarray(self.raw.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids of the words, and where each word's begin and how many there are."""
        runs = [" ".join(words[i : i + 2000]) for i in range(0, len(words), 2000)]
        parts = [self.raw.encode_batch_fast([run], add_special_tokens=False)[0].ids for run in runs]
        ids = np.concatenate([np.asarray(part, dtype=np.uint32) for part in parts])
        last = np.flatnonzero(self.ends[ids]) + 1
        if len(last) != len(words):  # a word that the library splits otherwise: one by one
            each = [self.whole(w) for w in words]
            size = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
            return (np.concatenate(each) if each else ids), np.cumsum(size) - size, size
        begin = np.concatenate(([0], last[:-1])).astype(np.int64)
        return ids, begin, last - begin

    def _learn(self) -> None:
        """The ids of the new runs, from their words'."""
        runs, self.runs.index.new = self.runs.index.new, []
        known, used, get = len(self.words.index), self.words.used, self.words.index.__getitem__
        words = [_SPLIT.findall(run) for run in runs]
        at = np.fromiter((get(w) for some in words for w in some), dtype=np.int32)
        if self.words.index.new:
            new, self.words.index.new = self.words.index.new, []
            self.words.add(*self._pieces(new))
        ends = np.cumsum(np.concatenate(([0], self.words.size[at])), dtype=np.int64)[np.cumsum([0, *map(len, words)])]
        self.runs.add(self.words.of(at), ends[:-1], np.diff(ends))
        if len(self.words.index) > self.cache_words:
            self.words.forget(known, used)

    def _places(self, texts: list[str]) -> list[np.ndarray | None]:
        """For each text the numbers of its runs, whose ids are known then; none for a text that goes through the library."""
        get, found = self.runs.index.__getitem__, []
        for text in texts:
            if self._plain(text):
                runs = text.lower().split()
                found.append(np.fromiter(map(get, runs), dtype=np.int32, count=len(runs)))
            else:
                found.append(None)
        if self.runs.index.new:
            self._learn()
        return found

    def encode_many(self, texts):
        """The ids of each text (null: none), in order."""
        block: list = []
        chars = 0
        for text in texts:
            block.append(text or "")
            chars += len(block[-1])
            if chars >= self.BLOCK_CHARS:
                yield from self._encode_block(block)
                block, chars = [], 0
        yield from self._encode_block(block)

    def _encode_block(self, texts: list[str]):
        known, used = len(self.runs.index), self.runs.used
        for text, at in zip(texts, self._places(texts)):
            yield self.whole(text) if at is None else self.runs.of(at)
        if len(self.runs.index) > self.cache_words:
            self.runs.forget(known, used)

    def encode(self, text: str | None) -> np.ndarray:
        return next(self._encode_block([text or ""]))

    def count_many(self, texts: list[str]) -> list[int]:
        """How many ids each text has."""
        known, used = len(self.runs.index), self.runs.used
        counts = [len(self.whole(text)) if at is None else int(self.runs.size[at].sum()) for text, at in zip(texts, self._places(texts))]
        if len(self.runs.index) > self.cache_words:
            self.runs.forget(known, used)
        return counts
