"""Exact fast path for a lower-casing word BPE tokenizer file (``word_bpe_49k.json``).

White space never takes part in a token of this tokenizer, so a text is the
concatenation of its white-space separated chunks. A chunk made of ASCII and
Latin letters is cut into pre-tokens here; any other chunk, and any chunk that
holds a special string, goes to the library as it is. Pre-tokens are merged by
the library's own model, once each as long as the bounded cache keeps them.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

# Characters for which lower-casing, composition and the letter / digit /
# space classes of the file's pattern are plain; everything else is left to
# the library.
_LATIN = "À-ÖØ-öø-įı-ſ"  # without U+0130, whose lower case is two characters
_ODD = re.compile(rf"[^\t\n\v\f\r\x20-\x7e{_LATIN}]")
_PRE = re.compile(r"[a-zß-öø-įı-ſ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-zß-öø-įı-ſ0-9]+")
_SPACE = re.compile(r"[ \t\n\r]+")


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others for the code points from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    table = {b: chr(b) for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + k)
    return table


class _Merged(dict):
    """Pre-token -> result of ``make``; the fixed entries stay, the others are
    dropped when ``limit`` is reached."""

    def __init__(self, make, fixed: dict, limit: int):
        super().__init__(fixed)
        self.make, self.fixed, self.limit = make, fixed, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
            self.update(self.fixed)
        value = self[word] = self.make(word)
        return value


class WordBpe:
    def __init__(self, path: str, cache: int = 400_000):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        self.vocab = spec["model"]["vocab"]
        self._model = self.tokenizer.model
        self._bytes = byte_alphabet()
        self.whole = self._prove_whole_tokens()
        self.ids = _Merged(self._merge_packed, {w: array("I", [i]).tobytes() for w, i in self.whole.items()}, cache)
        self.counts = _Merged(lambda w: len(self._merge(w)), dict.fromkeys(self.whole, 1), cache)

    def _merge(self, word: str) -> list[int]:
        """Ids of one pre-token, merged by the library's model."""
        return [t.id for t in self._model.tokenize("".join(self._bytes[b] for b in word.encode()))]

    def _merge_packed(self, word: str) -> bytes:
        return array("I", self._merge(word)).tobytes()

    def _prove_whole_tokens(self) -> dict[str, int]:
        """Vocabulary strings that are one pre-token and encode alone as one
        token. Each is tried once, when the worker loads the file; the table
        is bounded by the vocabulary."""
        back = {c: b for b, c in self._bytes.items()}
        proven = {}
        for piece, token in self.vocab.items():
            if not piece.endswith(self.suffix):
                continue
            try:
                word = bytes(back[c] for c in piece[: len(piece) - len(self.suffix)]).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if word == word.lower() and _PRE.findall(word) == [word] and not _ODD.search(word) and self._merge(word) == [token]:
                proven[word] = token
        return proven

    def pieces(self, text: str):
        """(pre-tokens, None) and (None, chunk) in text order; the chunks are
        those only the library can cut."""
        if not _ODD.search(text) and not any(s in text for s in self.special):
            yield _PRE.findall(text.lower()), None
            return
        plain: list[str] = []
        for chunk in _SPACE.split(text):
            if _ODD.search(chunk) or any(s in chunk for s in self.special):
                if plain:
                    yield _PRE.findall(" ".join(plain).lower()), None
                    plain = []
                yield None, chunk
            else:
                plain.append(chunk)
        if plain:
            yield _PRE.findall(" ".join(plain).lower()), None

    def library_ids(self, chunk: str) -> list[int]:
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def encode_packed(self, text: str | None) -> bytes:
        """All ids as native unsigned 32-bit integers; null text is empty."""
        out = []
        for words, chunk in self.pieces(text or ""):
            out += [array("I", self.library_ids(chunk)).tobytes()] if words is None else map(self.ids.__getitem__, words)
        return b"".join(out)

    def count(self, text: str | None) -> int:
        """Number of ids; whole tokens count one, only the rest is merged."""
        return sum(
            len(self.library_ids(chunk)) if words is None else sum(map(self.counts.__getitem__, words))
            for words, chunk in self.pieces(text or "")
        )


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One tokenizer per worker process and file."""
    return WordBpe(path)
