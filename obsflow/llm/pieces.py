"""SentencePiece encoding and decoding by a shared-prefix Viterbi pass
(operator 2).

The distinct marked words of a batch (``▁`` marks a word's start) are sorted,
which lays them out as a trie in depth-first order, and traversed: a word
starts from the forward states of the prefix it shares with the word before
it, so each trie node is computed once.

The forward state of a position depends on the kind of model file:

- unigram: the best sum of piece scores up to there, and its last piece;
- BPE: the last piece of the only admissible segmentation up to there. Two
  neighbouring pieces are admissible if merging their characters by the
  model's ranks yields just these two; a segmentation is the merge result if
  and only if all its pieces are and all its neighbours are (the first merge
  across a boundary would also happen with the two pieces alone). So the pass
  gives the very ids of the merge procedure. A sum of a BPE file's scores,
  which are ranks, would not.

Characters outside the vocabulary are cut out before the pass, as no piece
spans them, and become byte pieces (or the unknown id).
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import values

MARK = "▁"
# Words with no mark inside: no piece crosses their ends.
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
CACHED_WORDS = 200_000  # in each of two halves of the cache
CACHED_PAIRS = 1_000_000
SLICE = 2_000  # rows worked on at once: the more words are sorted together, the more prefixes they share
# Penalty and kinds as the file format defines them (fixed values).
NORMAL, UNKNOWN, BYTE = 1, 2, 6
UNIGRAM, BPE = 1, 2


class PieceModel:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, train = model.normalizer_spec, model.trainer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models that leave the text as it is are supported")
        if train.model_type not in (UNIGRAM, BPE) or train.treat_whitespace_as_suffix:
            raise ValueError("only unigram and BPE models with leading marks are supported")
        self.unigram = train.model_type == UNIGRAM
        self.prefix = MARK if norm.add_dummy_prefix else ""
        self.unknown = next(k for k, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.ids = {p.piece: k for k, p in enumerate(model.pieces) if p.type == NORMAL}
        self.text = [p.piece for p in model.pieces]
        self.score = [p.score for p in model.pieces]
        if any(p.type not in (1, 2, 3, 5, 6) or re.search(f"[^{MARK}]{MARK}", p.piece) for p in model.pieces):
            raise ValueError("pieces that span words or are user-defined are not supported")
        self.byte_ids = {int(p.piece[1:-1], 16): k for k, p in enumerate(model.pieces) if p.type == BYTE}
        self.alphabet = {p for p in self.ids if len(p) == 1}
        if not self.unigram:  # pieces that no merge yields are never used
            self.ids = {p: k for p, k in self.ids.items() if self._merge(list(p)) == [p]}
        self._lengths = self._by_tail()
        byte_of = {k: bytes([b]) for b, k in self.byte_ids.items()}
        shown = {1: lambda k: self.text[k].encode(), UNKNOWN: lambda k: " ⁇ ".encode(), BYTE: byte_of.__getitem__}
        shown_bytes = [shown[p.type](k).replace(MARK.encode(), b" ") if p.type in shown else b"" for k, p in enumerate(model.pieces)]
        # What each piece decodes to: one run of bytes, and its place and size.
        self._bytes = np.frombuffer(b"".join(shown_bytes), np.uint8)
        self._sizes = np.array([len(x) for x in shown_bytes], np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._pairs: dict[tuple[int, int], bool] = {}
        self._words: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    # BPE admissibility

    def _merge(self, chars: list[str]) -> list[str]:
        """Merge by score, the leftmost first among equals."""
        while True:
            best, at = None, -1
            for k in range(len(chars) - 1):
                piece = self.ids.get(chars[k] + chars[k + 1])
                if piece is not None and (best is None or self.score[piece] > best):
                    best, at = self.score[piece], k
            if best is None:
                return chars
            chars[at : at + 2] = [chars[at] + chars[at + 1]]

    def _neighbours(self, left: int, right: int) -> bool:
        if len(self._pairs) >= CACHED_PAIRS:
            self._pairs.clear()
        a, b = self.text[left], self.text[right]
        good = self._pairs[left, right] = self._merge(list(a + b)) == [a, b]
        return good

    # The forward pass; a state is (last piece, where it starts, score)

    def _by_tail(self) -> dict[str, tuple[int, ...]]:
        """Lengths, longest first, of the pieces that end in four given characters
        or, for shorter ones, in the last of them; and the same by three
        characters, for ends that no longer piece has."""
        found: dict[str, set[int]] = {}
        for piece in self.ids:
            for n in (3, 4):
                if len(piece) >= n:
                    found.setdefault(piece[-n:], set()).update([len(piece)] if n == 4 or len(piece) == 3 else [])
        for tail, lengths in found.items():
            lengths.update(n for n in (1, 2, 3) if n <= len(tail) and tail[len(tail) - n :] in self.ids)
        return {tail: tuple(sorted(lengths, reverse=True)) for tail, lengths in found.items()}

    def _ends(self, word: str, end: int) -> tuple[int, ...]:
        """Lengths that a piece that ends at a place of the word may have."""
        get = self._lengths.get
        return (get(word[end - 4 : end]) if end >= 4 else None) or (get(word[end - 3 : end]) if end >= 3 else None) or (2, 1)

    def _segment_bpe(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        ids, lengths, pairs, neighbours = self.ids.get, self._lengths.get, self._pairs, self._neighbours
        short = (2, 1)
        last, begin, before = [-1], [0], ""  # the state of each place: its last piece and where that starts
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], begin[shared + 1 :]
            padded = "    " + word  # no piece holds a space: ends near a word's start have no longer key
            for end in range(shared + 1, len(word) + 1):
                for length in lengths(padded[end : end + 4]) or lengths(padded[end + 1 : end + 4]) or short:
                    start = end - length
                    if start < 0 or (piece := ids(word[start:end])) is None:
                        continue
                    if start:
                        pair = last[start], piece
                        good = pairs.get(pair)
                        if good is None:
                            good = neighbours(*pair)
                        if not good:
                            continue
                    last.append(piece)
                    begin.append(start)
                    break
                else:
                    raise AssertionError("each prefix of known characters has a segmentation")
            before, out, end = word, [], len(word)
            while end:
                out.append(last[end])
                end = begin[end]
            yield word, out[::-1]

    def _next_unigram(self, word: str, states: list[tuple[int, int, float]], end: int) -> tuple[int, int, float]:
        best = None
        for length in self._ends(word, end):
            start = end - length
            piece = self.ids.get(word[start:end]) if start >= 0 else None
            if piece is not None and (best is None or states[start][2] + self.score[piece] > best[2]):
                best = piece, start, states[start][2] + self.score[piece]
        return best

    def segment(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Ids of sorted distinct words of known characters; the states of the
        prefix shared with the previous word are used again."""
        return self._segment_unigram(words) if self.unigram else self._segment_bpe(words)

    def _segment_unigram(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        states, before = [(-1, 0, 0.0)], ""
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del states[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                states.append(self._next_unigram(word, states, end))
            before, ids, end = word, [], len(word)
            while end:
                piece, end, _ = states[end]
                ids.append(piece)
            yield word, ids[::-1]

    # Words and texts

    def _known_runs(self, word: str) -> list[str]:
        """The word cut at characters outside the vocabulary, which stay as
        runs of their own."""
        if self.alphabet.issuperset(word):
            return [word]
        runs, start = [], 0
        for k, c in enumerate(word):
            if c not in self.alphabet:
                runs += [word[start:k], c] if k > start else [c]
                start = k + 1
        return runs + [word[start:]] if start < len(word) else runs

    def _outside(self, c: str) -> list[int]:
        return [self.byte_ids[b] for b in c.encode("utf-8", "surrogatepass")] if self.byte_ids else [self.unknown]

    def marked_words(self, text: str | None) -> list[str]:
        return _WORD.findall(self.prefix + text.replace(" ", MARK)) if text else []

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as native 32-bit integers; null is empty."""
        split = [self.marked_words(t) for t in texts]
        used = set().union(*split)
        new = used.difference(self._words)
        for w in new.intersection(self._older):
            self._words[w] = self._older[w]
        new.difference_update(self._words)
        runs = {w: self._known_runs(w) for w in new}
        found = dict(self.segment(sorted({r for rs in runs.values() for r in rs if len(r) > 1 or r in self.alphabet})))
        for w, rs in runs.items():
            ids = found[w] if len(rs) == 1 and w in found else [i for r in rs for i in (found[r] if r in found else self._outside(r))]
            self._words[w] = array("i", ids).tobytes()
        out = [b"".join(map(self._words.__getitem__, words)) for words in split]
        if len(self._words) > CACHED_WORDS:  # words that are met again come back from the older half
            self._words, self._older = {}, self._words
        return out

    def decode_batch(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of many rows of ids at once; ``ends`` holds where each row
        ends, after a leading 0."""
        first, size = self._starts[ids], self._sizes[ids]
        before = np.concatenate(([0], np.cumsum(size)))
        data = self._bytes[np.repeat(first - before[:-1], size) + np.arange(before[-1])].tobytes()
        cut = before[ends].tolist()
        texts = [data[i:j].decode("utf-8", "replace") for i, j in zip(cut[:-1], cut[1:], strict=True)]
        return [t[1:] if t.startswith(" ") else t for t in texts] if self.prefix else texts

    def decode(self, ids: Iterable[int]) -> str:
        ids = np.fromiter(ids, np.int64)
        return self.decode_batch(ids, np.array([0, len(ids)]))[0]


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """One model per worker process and file."""
    return PieceModel(path)


def _fields(df: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema)


def encode(df: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """``df`` with the ids of each whole text (an array; null and empty texts
    get the empty one) and, if asked for, their decoding in the same pass.
    Columns of these names are replaced. No shuffle."""
    rows = df.drop(ids_col, *([decoded_col] if decoded_col else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                packed = pieces.encode_batch(list(values(batch, text_col)))
                ends = np.cumsum([0] + [len(p) // 4 for p in packed], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))
                columns, names = [*batch.columns, ids], [*batch.schema.names, ids_col]
                if decoded_col:
                    columns.append(pa.array(pieces.decode_batch(ids.values.to_numpy(), ends), pa.string()))
                    names.append(decoded_col)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, f"{_fields(rows)}`{ids_col}` array<int>" + f", `{decoded_col}` string" * bool(decoded_col))


def decode(df: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of each array of ids; a null array gives null."""
    rows = df.drop(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                rows_of = batch.column(ids_col)
                ends = np.concatenate(([0], np.cumsum(rows_of.value_lengths().fill_null(0).to_numpy())))
                found = pieces.decode_batch(rows_of.flatten().to_numpy(), ends)
                texts = [t if ok else None for t, ok in zip(found, rows_of.is_valid().to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text_col])

    return rows.mapInArrow(run, f"{_fields(rows)}`{text_col}` string")


def encoded_documents(df: DataFrame, model: str) -> DataFrame:
    """Per row of ``df``: ``doc_id, n_tokens, ids, decoded_sha256,
    round_trip``; ``round_trip`` tells whether decoding gives the text back (the mark itself
    in a text comes back as a space; a null text counts as empty)."""
    rows = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = encode(rows, model, decoded_col="decoded")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )
