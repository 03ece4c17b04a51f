"""Packing documents into sequences by the sum-of-squares rule.

Documents are tokenised and cut into pieces of at most one window. A full piece is a
sequence of its own. Every other piece goes, as it arrives, to the fill level at which
the sum of squares of the counts of partially filled windows comes out smallest; the
counts are an array by level. That keeps many different levels open, so that most
windows come to close exactly full.

What is still partially filled at the end of a task is completed by cutting: the
emptiest windows are poured into the fullest. The single window left over becomes
sequences whose lengths are powers of two, which need no padding. The same happens
once ``max_open`` windows are open, so a task holds at most that many windows of ids.

Each task packs its own part of the table; ``sequence_id`` holds the task's number.
Nothing is shuffled, and a repeated task gives the same result as long as it reads the
same rows in the same order, as scans of stored tables do.

A null or empty text is a document of the end token alone. Repeated rows are packed
each for itself, a null id is kept. Other columns are left out.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from string import punctuation
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ballast.llm.shared import tidy

WINDOW = 2048
END_ID = 1
MAX_OPEN = 8192
# Words whose ids a Python worker keeps.
KEPT_WORDS = 400_000
OUT_BYTES = 8_000_000
SLICE_BYTES = 4_000_000


def _shown() -> dict[int, str]:
    """How byte-level tokenizers write bytes: visible Latin-1 characters as
    themselves, the others, in order, as the characters from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


SHOWN = _shown()


def prepared(text: str) -> str:
    """What the tokenizer makes of letters before it cuts them into pieces."""
    text = normalize("NFC", text)
    # The tokenizer lower-cases letter by letter; str.lower looks further at final sigmas.
    return text if text.islower() else text.replace("\u03a3", "\u03c3").lower()


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Words(dict):
    """Ids of whole texts, from the ids of their words: the tokenizer never joins
    across a blank. Maps each word seen to its ids as bytes."""

    def __init__(self, tokenizer_path: str, kept: int = KEPT_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.kept = kept
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added) or "(?!)", re.IGNORECASE)
        # Whether words of letters alone are lower-cased and go to the model whole.
        self.lettered = all(
            self.tokenizer.encode(w, add_special_tokens=False).ids
            == [t.id for t in self.model.tokenize(w.lower().encode().decode("latin1").translate(SHOWN))]
            for w in ("Packing", "\u00c9tait", "ni\u00f1o", "\u4e2d\u6587")
        )

    def __missing__(self, word: str) -> bytes:
        plain = word.lower() if word.isascii() else prepared(word)
        if not (self.lettered and word.isalpha() and plain.isalpha()):
            ids = self.of_parts(word)
        elif word.isascii() and plain != word:
            ids = self[plain]  # the tokenizer knows lower case only
        else:
            ids = self.of_letters(plain)
        self[word] = ids
        return ids

    def of_letters(self, plain: str) -> bytes:
        """A word of letters is one piece for the model, which is all that is left
        to run."""
        if not plain.isascii():
            plain = plain.encode().decode("latin1").translate(SHOWN)
        return _bytes([t.id for t in self.model.tokenize(plain)])

    def of_parts(self, word: str) -> bytes:
        """No token holds both a letter or digit and the marks behind it. An added
        token is a piece for itself, in the very letters it is written in."""
        if not self.added.search(word):
            stem = word.rstrip(punctuation)
            if 0 < len(stem) < len(word) and prepared(stem[-1]).isalnum():
                return self[stem] + self[word[len(stem) :]]
            if word.isascii() and word != word.lower():
                return self[word.lower()]
        return _bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def ids(self, texts: pa.Array) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self) > self.kept:
            self.clear()
            self[""] = b""
        blank = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        split = pc.split_pattern(blank.cast(pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        # One string, cut at its blanks, comes over faster than a string a word.
        listed = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary)
        joined = pc.binary_join(listed, pa.scalar(" ", listed.type.value_type))[0].as_py()
        parts = [self[word] for word in joined.split(" ")]
        each = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        pool = np.frombuffer(b"".join(parts), "<u4")
        used = coded.indices.to_numpy()
        lengths = each[used]
        ends = np.cumsum(lengths)
        # Where each word's ids lie in the pool, moved to where they go.
        shift = (np.cumsum(each) - each)[used] - (ends - lengths)
        ids = pool[np.repeat(shift, lengths) + np.arange(len(lengths) and ends[-1])]
        bounds = np.concatenate([[0], ends])[split.offsets.to_numpy()]
        for first, last in zip(bounds[:-1], bounds[1:]):
            yield ids[first:last].tobytes()


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    parts = np.cumsum(sizes) // most
    starts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(sizes)]
    return zip(starts[:-1], starts[1:])


class Levels:
    """Open windows by fill level. A piece is (doc, start, ids as bytes, doc tokens)."""

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.stacks: dict[int, list[list]] = {}
        self.open = 0

    def place(self, piece: tuple) -> list | None:
        """Put the piece where the sum of squares grows least, of equal levels into
        the fullest; returns the window if that fills it."""
        size = len(piece[2]) // 4
        last = self.window - size
        before = self.counts[: last + 1]
        change = 2 * self.counts[size:] + 1 + (1 - 2 * before)
        change[before == 0] = np.iinfo(np.int64).max
        change[0] = 2 * self.counts[size] + 1
        if before[last]:
            change[last] = 1 - 2 * before[last]
        level = last - int(np.argmin(change[::-1]))
        if level:
            pieces = self.stacks[level].pop()
            self.counts[level] -= 1
        else:
            pieces = []
            self.open += 1
        pieces.append(piece)
        if level == last:
            self.open -= 1
            return pieces
        self.stacks.setdefault(level + size, []).append(pieces)
        self.counts[level + size] += 1
        return None

    def flush(self) -> Iterator[list]:
        """All open windows, completed by cutting pieces of the emptiest ones."""
        rest = [
            pieces for level in sorted(self.stacks, reverse=True) for pieces in self.stacks[level]
        ]
        self.counts[:] = 0
        self.stacks, self.open = {}, 0
        low, high = 0, len(rest) - 1
        sizes = [sum(len(p[2]) // 4 for p in pieces) for pieces in rest]
        while low < high:
            need = self.window - sizes[low]
            piece = rest[high].pop()
            size = len(piece[2]) // 4
            if size > need:
                kept, moved = _cut(piece, size - need)
                rest[high].append(kept)
                piece, size = moved, need
            rest[low].append(piece)
            sizes[low] += size
            sizes[high] -= size
            if not rest[high]:
                high -= 1
            if sizes[low] == self.window:
                yield rest[low]
                low += 1
        if low == high:
            yield from _by_powers(rest[low], sizes[low])


def _cut(piece: tuple, at: int) -> tuple[tuple, tuple]:
    doc, start, ids, total = piece
    return (doc, start, ids[: 4 * at], total), (doc, start + at, ids[4 * at :], total)


def _by_powers(pieces: list, size: int) -> Iterator[list]:
    queue = pieces[::-1]
    while size:
        room = 1 << (size.bit_length() - 1)
        size -= room
        taken = []
        while room:
            piece = queue.pop()
            length = len(piece[2]) // 4
            if length > room:
                piece, rest = _cut(piece, room)
                queue.append(rest)
                length = room
            taken.append(piece)
            room -= length
        yield taken


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    max_open: int = MAX_OPEN,
    slice_bytes: int = SLICE_BYTES,
    out_bytes: int = OUT_BYTES,
    kept_words: int = KEPT_WORDS,
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit,
    as binary), doc_tokens, sequence_id, offset. ``tokenizer_path`` must exist on
    every executor. A worker tokenises about ``slice_bytes`` of text at a time, for
    which it takes some thirty times that memory; keeps the ids of about ``kept_words``
    words, some 250 bytes each; and hands on pieces once they hold ``out_bytes`` of ids."""
    source = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint"
    )
    end = np.asarray([end_id], "<u4").tobytes()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, levels = Words(tokenizer_path, kept_words), Levels(window)
        next_sequence = TaskContext.get().partitionId() << 33
        out: list[tuple] = []
        held = 0
        id_type = pa.int64()

        def close(pieces: list) -> None:
            nonlocal next_sequence, held
            offset = 0
            for doc, start, ids, total in pieces:
                length = len(ids) // 4
                out.append((doc, start, length, ids, total, next_sequence, offset))
                offset += length
                held += len(ids)
            next_sequence += 1

        def written() -> pa.RecordBatch:
            nonlocal held
            columns = list(zip(*out)) if out else [()] * 7
            kinds = [id_type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )
            out.clear()
            held = 0
            return batch

        for batch in batches:
            id_type = batch.column(0).type
            for first, last in slices(batch.column(1), slice_bytes):
                names = batch.column(0)[first:last].to_pylist()
                for doc, ids in zip(names, words.ids(batch.column(1)[first:last])):
                    ids += end
                    total = len(ids) // 4
                    full = total - total % window
                    for start in range(0, full, window):
                        close([(doc, start, ids[4 * start : 4 * (start + window)], total)])
                    if full < total:
                        filled = levels.place((doc, full, ids[4 * full :], total))
                        if filled:
                            close(filled)
                        elif levels.open >= max_open:
                            for pieces in levels.flush():
                                close(pieces)
                    if held > out_bytes:
                        yield written()
        words.clear()
        for pieces in levels.flush():
            close(pieces)
            if held > out_bytes:
                yield written()
        yield written()

    return source.mapInArrow(tidy(task), schema)
