"""Token ids of whole texts with a file of the tokenizers library, as little-endian unsigned 32-bit integers."""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: The splitting pattern and the normalisers that make a word's ids independent of its neighbours.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: The same pattern for lower-cased Latin-1, which normalisation leaves alone.
_LETTERS, _DIGITS, _BLANKS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
_words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_BLANKS}{_LETTERS}{_DIGITS}]+").findall

_encoders: dict[str, Encoder] = {}


class Words(dict):
    """Ids of words; those that have come up only once are in `once`, for the texts at hand."""

    once: dict[str, bytes]

    def __missing__(self, word: str) -> bytes:
        return self.once[word]


class Encoder:
    """Ids of texts. Where the file splits texts into words whose ids don't depend on other words, each word goes through
    the library when it is met first and again when it comes up in later texts; from then on it is taken from a table of
    at most `most` words (emptied when full, but for the words at hand). Any other file, and any text beyond Latin-1 or with a special token in it, is encoded by the library whole."""

    def __init__(self, path: str, most: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.most = most
        with open(path) as f:
            spec = json.load(f)
        steps = (spec.get("normalizer") or {}).get("normalizers") or []
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = [x["type"] for x in steps] == WORD_NORMALIZERS and splits[0].get("pattern") == {"Regex": WORD_PATTERN} and spec["model"].get("end_of_word_suffix") == "</w>"
        if self.by_word:
            self.bare = Tokenizer(self.whole.model)
            self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            vocab = self.whole.get_vocab()
            self.last = np.zeros(max(vocab.values()) + 1, bool)
            self.last[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
            self.special = [x["content"] for x in spec.get("added_tokens", [])]
            self.table = Words()
            self.met = bytearray(1 << 22)

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: set[str]) -> None:
        """Ids of words that the table lacks; the last id of a word marks its end."""
        want = list(words)
        ids = np.array(self.bare.encode_batch_fast([" ".join(want)], add_special_tokens=False)[0].ids, "<u4")
        ends = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
        raw, at, met, slots = ids.tobytes(), 0, self.met, len(self.met) - 1
        self.table.once = once = {}
        for w, end in zip(want, ends, strict=True):
            slot = hash(w) & slots
            (self.table if met[slot] else once)[w] = raw[at:end]
            met[slot] = 1
            at = end

    def _plain(self, text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return not any(x in text for x in self.special)

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; a null text has those of the empty one: none."""
        texts = [x or "" for x in texts]
        plain = [self.by_word and self._plain(x) for x in texts]
        rest = iter(self._raw([x for x, p in zip(texts, plain, strict=True) if not p]))
        split = [_words(x.lower()) if p else () for x, p in zip(texts, plain, strict=True)]
        if split and (new := set().union(*split)) and (lack := new - self.table.keys()):
            if len(self.table) + len(lack) > self.most:
                self.table = Words((w, b) for w in new if (b := self.table.get(w)) is not None)
                self.met = bytearray(len(self.met))
            self._learn(lack)
        get = self.table.__getitem__ if self.by_word else None
        return [b"".join(map(get, s)) if p else next(rest) for s, p in zip(split, plain, strict=True)]


def encoder(path: str) -> Encoder:
    """The encoder of a file; a Python worker keeps it for its later tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
