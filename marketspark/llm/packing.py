"""Pack tokenised documents into sequences by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import tidy

CAPACITY = 1024
END = 0
#: Pieces of text whose ids a worker remembers, and the longest of them.
REMEMBERED = 400_000
LONGEST = 64
#: Stops that are pieces of their own behind a letter; the apostrophe is not, it joins contractions.
STOPS = ".,;:!?)"
# Fixed value: how byte-level vocabularies of this kind cut a text before they merge.
CUT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PROBE = ["", " the", "Don't we'll", " 12ab ²Ⅷ", "a  b\n\n c\t", " é日本😀\u0301", "x" * 50, " !?..'", "\x00\xa0 \u2003"]
#: Texts that are split before the pieces not yet known are encoded together.
TOGETHER = 512
OUT = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
ROWS = 20_000


def _signs() -> dict[str, int]:
    """The sign for each byte in byte-level vocabularies: itself if it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of whole texts, as ``tokenizers`` gives them without special tokens, as packed 32-bit values.

    A byte-level tokenizer never joins across a single blank between two other characters: the
    blank starts the next piece. Nor does it join letters with the stops behind them. So texts are
    cut there, and the ids of the pieces are remembered. Blanks next to other white space are no
    cut. Texts that spell an added token are encoded as a whole.

    ``tiktoken`` with the same file's vocabulary is several times faster, also than looking up
    pieces where many words are new. That needs ids in the order of merges and the usual cut of
    byte-level vocabularies; a probe decides. With it ``ids`` encodes whole texts, without it pieces
    not yet known are encoded by ``tokenizers``.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Ids of words with a blank in front, by the word, and of pieces as they are; each with the
        #: generation before, from which a piece that is met again comes back.
        self.words: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.short = self._ranked()
        if self.short and [self.short(p) for p in PROBE] != [x.ids for x in self.tokenizer.encode_batch(PROBE, add_special_tokens=False)]:
            self.short = None

    def _ranked(self):
        """Encoder by ranks, or None if the vocabulary is not one of bytes."""
        import tiktoken

        signs = _signs()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        if not all(set(token) <= signs.keys() for token in vocabulary) or not set(signs) <= vocabulary.keys():
            return None
        ranks = {bytes(signs[c] for c in token): rank for token, rank in vocabulary.items() if token not in self.added}
        return tiktoken.Encoding("own", pat_str=CUT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def forget(self) -> None:
        """Drop the remembered pieces: a worker goes on to other work."""
        self.words, self.others, self.older = {}, {}, {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def parts(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without added tokens."""
        if self.short is None:
            return self.whole(texts)
        return [array("I", self.short(text)).tobytes() for text in texts]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, the fastest way that this vocabulary allows; equal texts are encoded once."""
        different = list(dict.fromkeys(texts))
        if len(different) < len(texts):
            known = dict(zip(different, self.ids(different), strict=True))
            return [known[t] for t in texts]
        if self.short is None:
            return self.encode(texts)
        odd = [any(t in text for t in self.added) for text in texts]
        whole, plain = iter(self.whole(list(compress(texts, odd)))), iter(self.parts([t for t, o in zip(texts, odd, strict=True) if not o]))
        return [next(whole if o else plain) for o in odd]

    def pieces(self, text: str) -> list[str]:
        """Pieces that are encoded alone; all but the first with their leading blank."""
        parts = text.split(" ")
        pieces, open_piece = [], parts[0]
        for part in parts[1:]:
            if open_piece and part and not open_piece[-1].isspace() and not part[0].isspace():
                pieces.append(open_piece)
                open_piece = " " + part
            else:
                open_piece += " " + part
        pieces.append(open_piece)
        return pieces

    def _learn(self, wanted: set[str], known: dict[str, bytes], blank: str) -> dict[str, bytes]:
        """Ids of the pieces, each with ``blank`` in front; kept in ``known`` unless they are long."""
        stopped, plain = [], set()
        for p in wanted:
            if p[-1:] in STOPS:
                core = p.rstrip(STOPS)
                if core and core[-1].isalpha():
                    stopped.append((p, core))
                    if core not in known:
                        plain.add(core)
                    continue
            plain.add(p)
        fresh = list(plain)
        learned = dict(zip(fresh, self.parts([blank + p for p in fresh] if blank else fresh), strict=True))
        ends = list({p[len(core):] for p, core in stopped} - self.others.keys())
        self.others.update(zip(ends, self.parts(ends), strict=True))
        for p, core in stopped:
            learned[p] = (learned[core] if core in learned else known[core]) + self.others[p[len(core):]]
        known.update(learned if max(map(len, learned)) <= LONGEST else {p: v for p, v in learned.items() if len(p) <= LONGEST})
        return learned

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > REMEMBERED:
            self.older, self.words = self.words, {}
        if len(self.others) > REMEMBERED:
            self.others.clear()
        out: list[bytes | None] = [None] * len(texts)
        cut: dict[int, tuple] = {}
        odd: dict[int, list[str]] = {}
        new_words, new_others, whole = set(), set(), []
        get = self.words.get
        for i, text in enumerate(texts):
            if any(t in text for t in self.added):
                whole.append(i)
                continue
            first, *parts = text.split(" ")
            ids = list(map(get, parts))
            missing = set()
            for k in [k for k, v in enumerate(ids) if v is None]:
                p = parts[k]
                if p in self.older:
                    ids[k] = self.words[p] = self.older[p]
                else:
                    missing.add(p)
            if not first or first[-1].isspace() or any(not p or p[0].isspace() or p[-1].isspace() for p in missing):
                odd[i] = self.pieces(text)
                new_others.update(p for p in odd[i] if p not in self.others)
                continue
            new_words.update(missing)
            if first not in self.others:
                new_others.add(first)
            if missing or first not in self.others:
                cut[i] = (first, parts, ids)
            else:
                out[i] = self.others[first] + b"".join(ids)
        words = self._learn(new_words, self.words, " ") if new_words else {}
        others = self._learn(new_others, self.others, "") if new_others else {}

        def look(piece: str, known: dict[str, bytes], fresh: dict[str, bytes]) -> bytes:
            return known[piece] if piece in known else fresh[piece]

        for i, (first, parts, ids) in cut.items():
            ids = [words[p] if v is None else v for p, v in zip(parts, ids, strict=True)]
            out[i] = look(first, self.others, others) + b"".join(ids)
        for i, pieces in odd.items():
            out[i] = b"".join([look(p, self.others, others) for p in pieces])
        for i, ids in zip(whole, self.whole([texts[i] for i in whole]) if whole else [], strict=True):
            out[i] = ids
        return out


class Packer:
    """Sum-of-squares placement over an array of counts of partly filled sequences by level."""

    def __init__(self, capacity: int, first: int):
        self.capacity = capacity
        self.levels = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.next = first
        self.rows: list[tuple] = []

    def _close(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next, offset))
            offset += n
        self.next += 1

    def level_for(self, size: int) -> int:
        """The level (0: a new sequence) at which adding ``size`` leaves the least sum of squares.

        Moving one sequence from level h to h + size changes the sum by 2 (N[h + size] - N[h]) + 2;
        level 0 and a full sequence are not counted. Equal changes go to the fullest level.
        """
        room = self.capacity - size
        counts = self.levels
        used = np.flatnonzero(counts[1:room + 1]) + 1
        change = 2 * (counts[used + size] - counts[used]) + 2
        if len(used) and used[-1] == room:
            change[-1] = 1 - 2 * counts[room]
        new = 2 * counts[size] + 1
        if not len(used):
            return 0
        best = len(used) - 1 - int(change[::-1].argmin())
        return int(used[best]) if change[best] <= new else 0

    def add(self, doc, ids: bytes) -> None:
        total, width = len(ids) // 4, self.capacity
        whole = total - total % width
        for start in range(0, whole, width):
            self._close([(doc, start, ids[4 * start:4 * (start + width)], total)])
        size = total - whole
        if size:
            level = self.level_for(size)
            pieces = []
            if level:
                self.levels[level] -= 1
                pieces = self.open[level].pop()
            pieces.append((doc, whole, ids[4 * whole:], total))
            if level + size == width:
                self._close(pieces)
            else:
                self.levels[level + size] += 1
                self.open.setdefault(level + size, []).append(pieces)

    def finish(self) -> None:
        """Close what is still open: fullest first, each topped up by cutting the emptiest ones.

        The last sequence is cut into lengths that are powers of two, which need no padding.
        """
        left = [pieces for level in sorted(self.open, reverse=True) for pieces in self.open[level]]
        flat = [piece for pieces in left for piece in pieces]
        remaining = sum(len(p[2]) // 4 for p in flat)
        at = 0
        while remaining:
            room = self.capacity if remaining >= self.capacity else 1 << (remaining.bit_length() - 1)
            remaining -= room
            pieces = []
            while room:
                doc, start, ids, total = flat[at]
                n = min(room, len(ids) // 4)
                pieces.append((doc, start, ids[:4 * n], total))
                room -= n
                if 4 * n == len(ids):
                    at += 1
                else:
                    flat[at] = (doc, start + n, ids[4 * n:], total)
            self._close(pieces)
        self.open, self.levels[:] = {}, 0

    def taken(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        return pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 7)], names)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack(docs: DataFrame, *, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every task packs the documents it reads, without a shuffle, one after the other: whole
    sequences are cut off a long document and the rest goes where the sum of squared counts of
    partly filled sequences grows least. What is open at a task's end is topped up by cutting, so a
    task leaves no padding. ``capacity`` is a power of two. ``tokenizer`` is a file that every
    executor has. Sequence ids hold the task's number in their high bits.

    Null and empty texts are the end id alone. A null key stays null. Repeated rows are packed one by
    one. A long text is cut, never shortened. An empty table gives no rows. Other columns are not
    looked at.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    end = np.array([END], "<u4").tobytes()
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        packer = Packer(capacity, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                for doc, ids in zip(part.column("doc_id").to_pylist(), own.ids(part.column("text").to_pylist()), strict=True):
                    packer.add(doc, ids + end)
                if len(packer.rows) >= ROWS:
                    yield packer.taken()
        own.forget()
        packer.finish()
        yield packer.taken()

    return rows.mapInArrow(tidy(task), OUT)
