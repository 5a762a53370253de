"""Byte-level BPE ids of whole texts by the ``tokenizers`` library.

The vocabulary's pre-tokenizer never joins two words over a single blank, so a text
whose only white space is single blanks and line feeds between words has the ids of
its words one after the other. Words are encoded by the library once and kept in a
bounded per-worker cache; any other text goes to the library as it is. Both give the
ids that one ``encode(text, add_special_tokens=False)`` gives.
"""

from __future__ import annotations

import os
from array import array

import numpy as np

CACHE_WORDS = 1_000_000    # words kept by one Python worker; rarer ones are encoded each time
SHORT = 8                  # characters of a piece without a blank that is kept, too

# Fixed value: the byte-level vocabulary's published pre-tokenization pattern.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizer files are installed."""
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves and the other
    bytes, in order, as the letters from code point 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordCachedTokenizer:
    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.cache_words = cache_words
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.byte_level = (str(self.tok.pre_tokenizer).startswith("ByteLevel(add_prefix_space=False")
                           and self.tok.normalizer is None)
        self.kind = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        self.pieces = regex.compile(PIECE).findall
        self.letters = byte_letters()
        self.code = "H" if self.kind is np.uint16 else "I"
        self.known: dict[str, bytes] = {}
        self.short: dict[str, bytes] = {}

    def encode_plain(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def words(self, text: str) -> list[str] | None:
        """Blank-separated words, those at a line's start with their line feed; None
        where the text has other white space or a special token's string."""
        if not self.byte_level or any(s in text for s in self.special):
            return None
        if " ".join(text.split()) != text.replace("\n", " "):
            return None
        return text.replace("\n", " \n").split(" ")

    def _word(self, word: str) -> bytes:
        """Ids of a word as it stands in a text: after its line feed, or after a blank. Its
        pieces are often known already, as words of their own or as punctuation."""
        out = b""
        for p in self.pieces(word if word[0] == "\n" else " " + word):
            spaced = p[0] == " "
            ids = self.known.get(p[1:]) if spaced else self.short.get(p)
            if ids is None:
                ids = array(self.code, [t.id for t in self.tok.model.tokenize(
                    p.encode().decode("latin-1").translate(self.letters))]).tobytes()
                if not spaced and len(p) <= SHORT and len(self.short) < self.cache_words:
                    self.short[p] = ids
            out += ids
        return out

    def encode_many(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text as uint32; a null text is the empty text."""
        out: list[np.ndarray] = []
        known = self.known
        for text in texts:
            words = self.words(text) if text else None
            if words is None:
                out.append(self.encode_plain(text) if text else np.empty(0, np.uint32))
                continue
            head = self.encode_plain(words[0])
            try:
                got = [known[w] for w in words[1:]]
            except KeyError:
                got = []
                for w in words[1:]:
                    ids = known.get(w)
                    if ids is None:
                        ids = self._word(w)
                        if len(known) < self.cache_words:
                            known[w] = ids
                    got.append(ids)
            out.append(np.concatenate([head, np.frombuffer(b"".join(got), self.kind)]).astype(np.uint32))
        return out


_LOADED: dict[tuple[str, int], WordCachedTokenizer] = {}


def tokenizer(path: str, cache_words: int = CACHE_WORDS) -> WordCachedTokenizer:
    """One tokenizer a Python worker, for each size of its cache that is asked for."""
    if (path, cache_words) not in _LOADED:
        _LOADED[path, cache_words] = WordCachedTokenizer(path, cache_words)
    return _LOADED[path, cache_words]
