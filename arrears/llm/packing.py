"""Packing documents into sequences of equal size, by minimum bin slack (operator 11).

A document is its token ids and an end token. Whole windows of `capacity` ids
are cut off its front; what remains (less than a window) goes to a pool. Each
window takes the longest remaining length and, of the others, the multiset that
comes closest to the capacity. It is found by subset sums as a bitset: bit s of an
integer says that s can be reached; a length present m times is added in portions of 1, 2, 4, ...
copies, and the portions are traced back to counts. A multiset that fills the
window exactly is used as often as the counts allow. If none does, the window is
completed by the first ids of another document, whose rest returns to the pool.
(All that is left is then longer than the slack, else it would have been in the multiset.)

So every window is full, until less than one is left at the end of a task. That
is cut at powers of two, which need no padding.

Each task packs its own documents, in pools of POOL ids; what a pool leaves over stays in the
next one. No text and no id is shuffled; nothing is gathered on the driver. A
task holds a pool, a slice of text and a bounded dictionary: the words between
blanks and line breaks are encoded once and remembered, since the tokenizer's words end there.

Defined results
- NULL or empty text: the end token alone.
- NULL, equal or text ids: passed on; documents are told apart by their rows.
- Repeated rows: each is packed.
- Very long texts are encoded in slices of SLICE characters, cut at a blank or line break, and their
  full windows leave the pool at once.
- Empty table: no rows. Other columns are not read, whatever their names.
- `sequence_id` holds the task's number in its upper bits. Another split of the table into tasks
  gives another packing, with the same guarantees.
"""

from __future__ import annotations

import bisect
import gc
import itertools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CAPACITY = 4096
END = 2
POOL = 1 << 22             # ids packed at once
SLICE = 1 << 22            # characters encoded at once
REMEMBERED = 1 << 19       # words in a task's dictionary
GAP = re.compile("[ \n]")
# Words whose normal form and parts are plain: printable ASCII, Latin letters with a lower case of one
# letter, some punctuation. No | after <, since control strings of the tokenizer have the form <|...|>.
LATIN, MARKS = "À-ÖØ-öø-įĲ-ňŊ-ž", "¡¿«»“”‘’„–—…•€"
PLAIN = rf"^(?:[\x20-\x3b\x3d-\x7e{LATIN}{MARKS}]|<+[\x20-\x3b\x3d-\x7b\x7d\x7e{LATIN}{MARKS}])*<*$"
PARTS = re.compile(rf"'(?:[stmd]|re|ve|ll)|[a-z{LATIN}]+|[0-9]|[^\sa-z0-9{LATIN}]+|\n")
PIECE = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def byte_letters() -> dict[int, str]:
    """The letter by which a byte-level tokenizer writes each byte: its own where it prints, else 256 and on."""
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    other = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(other)) for b in range(256)}


class Ragged:
    """Rows of numbers of any length, one after the other."""

    def __init__(self, kind):
        self.values, self.first, self.size = np.zeros(0, kind), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def append(self, values: np.ndarray, size: np.ndarray):
        self.first = np.append(self.first, len(self.values) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.values = np.append(self.values, values)

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the rows, joined, and the length of each."""
        size = self.size[rows]
        end = np.cumsum(size)
        at = np.arange(int(size.sum())) + np.repeat(self.first[rows] - end + size, size)
        return self.values[at], size


def flat_numbers(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.fromiter(itertools.chain.from_iterable(rows), np.uint32, int(size.sum())), size


def strings(values: pa.Array) -> list:
    return values.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Token ids of texts, word by word, with a dictionary of the words met so far.

    Plain words are split into their parts here, by the tokenizer's rule (lower case, PARTS), and only
    new parts go to the vocabulary's merges, many at once; any other word goes through the whole
    tokenizer. The two give the same ids.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"          # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(model)
        self.letters = {b: c for b, c in byte_letters().items() if b != 10}
        self._forget()

    def _forget(self):
        self.word_number: dict[str, int] = {}
        self.part_number: dict[str, int] = {"\n": 0}
        self.words = Ragged(np.uint32)          # the ids of each word
        self.parts = Ragged(np.uint32)          # the ids of each part; part 0 stands between words
        self.parts.append(np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _learn_parts(self, parts: list[str]):
        written = "\n".join(parts).encode().decode("latin-1").translate(self.letters).split("\n")
        merge, collected = self.tokenizer.model.tokenize, gc.isenabled()
        gc.disable()                            # many small objects, none in a cycle
        try:
            got = [[t.id for t in merge(w)] for w in written]
        finally:
            if collected:
                gc.enable()
        self.parts.append(*flat_numbers(got))
        self.part_number.update(zip(parts, range(len(self.part_number), len(self.part_number) + len(parts))))

    def _learn(self, words: list[str]):
        is_plain = strings(pc.match_substring_regex(pa.array(words), PLAIN))
        plain, odd = ([w for w, p in zip(words, is_plain) if p is kind] for kind in (True, False))
        if plain:
            found = pa.array(PARTS.findall("\n".join(plain).lower() + "\n")).dictionary_encode()
            parts = strings(found.dictionary)
            unknown = [p for p in parts if p not in self.part_number]
            if unknown:
                self._learn_parts(unknown)
            number = np.fromiter(map(self.part_number.__getitem__, parts), np.int64, len(parts))[found.indices.to_numpy()]
            ids, size = self.parts.gather(number)
            self.words.append(ids, np.diff(np.cumsum(size)[number == 0], prepend=0))
        if odd:
            got = self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)
            self.words.append(*flat_numbers([e.ids for e in got]))
        self.word_number.update(zip(plain + odd, range(len(self.word_number), len(self.word_number) + len(words))))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Arrow splits the texts and finds the distinct words."""
        if len(self.word_number) > REMEMBERED:
            self._forget()
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")
        flat = split.values.dictionary_encode()
        words = strings(flat.dictionary)
        unknown = [w for w in words if w not in self.word_number]
        if unknown:
            self._learn(unknown)
        number = np.fromiter(map(self.word_number.__getitem__, words), np.int64, len(words))
        ids, size = self.words.gather(number[flat.indices.to_numpy()])
        bounds = np.append(0, np.cumsum(size))[split.offsets.to_numpy()]
        return np.split(ids, bounds[1:-1])


def slices(texts: list[str | None]):
    """(rows, slices of their texts, which of them end a text) of about SLICE characters at a time."""
    rows, parts, ends, held = [], [], [], 0
    for row, text in enumerate(texts):
        text, at = text or "", 0
        while at == 0 or at < len(text):
            gap = GAP.search(text, at + SLICE)
            end = gap.start() + 1 if gap else len(text)
            rows.append(row)
            parts.append(text[at:end])
            ends.append(end >= len(text))
            held += end - at
            at = max(end, 1)
            if held >= SLICE:
                yield rows, parts, ends
                rows, parts, ends, held = [], [], [], 0
    if rows:
        yield rows, parts, ends


def fullest(counts, capacity: int) -> dict[int, int]:
    """Of (length, copies), lengths in descending order, the multiset whose sum is closest to the capacity, as counts."""
    reach, mask, steps = 1, (1 << capacity + 1) - 1, []
    for length, copies in counts:
        copies, portion = min(copies, capacity // length), 1
        while copies > 0:
            portion = min(portion, copies)
            grown = (reach | reach << length * portion) & mask
            if grown != reach:
                steps.append((length, portion, reach))
                reach = grown
            copies -= portion
            portion *= 2
        if reach >> capacity:
            break
    at, picked = reach.bit_length() - 1, {}
    for length, portion, before in reversed(steps):
        if not before >> at & 1:
            picked[length] = picked.get(length, 0) + portion
            at -= length * portion
    return picked


class Packer:
    """Pieces of the documents of one task, as rows of PIECE after the document's id."""

    def __init__(self, capacity: int, pool_size: int, first_sequence: int):
        self.capacity, self.pool_size, self.sequence = capacity, pool_size, first_sequence
        self.pool: dict[int, list] = {}         # length: [(document, start, ids)]
        self.lengths: list[int] = []            # the pool's, in order
        self.held = 0
        self.rows: list[tuple] = []
        self.begin()

    def begin(self):
        self.document, self.start, self.ids = [None, 0], 0, np.zeros(0, np.uint32)

    def feed(self, ids: np.ndarray):
        """The next ids of the document; whole windows are sequences of their own."""
        self.ids = np.concatenate((self.ids, ids))
        whole = len(self.ids) // self.capacity * self.capacity
        for at in range(0, whole, self.capacity):
            self._place([(self.document, self.start + at, self.ids[at:at + self.capacity])])
        self.start += whole
        self.ids = self.ids[whole:]

    def end(self, doc_id):
        self.document[:] = [doc_id, self.start + len(self.ids)]
        if len(self.ids):
            self._return(self.document, self.start, self.ids.copy())
        self.begin()
        if self.held >= self.pool_size:
            self._fill()

    def finish(self):
        """The last full windows, and the rest as powers of two."""
        self._fill()
        left = [p for n in self.lengths for p in self.pool[n]]
        while self.held:
            room, window = 1 << self.held.bit_length() - 1, []
            self.held -= room
            while room:
                document, start, ids = left.pop()
                if len(ids) > room:
                    left.append((document, start + room, ids[room:]))
                    ids = ids[:room]
                window.append((document, start, ids))
                room -= len(ids)
            self._place(window)
        self.pool, self.lengths = {}, []

    def _place(self, window: list):
        offset = 0
        for document, start, ids in window:
            self.rows.append((document, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def _return(self, document, start, ids):
        if len(ids) not in self.pool:
            bisect.insort(self.lengths, len(ids))
        self.pool.setdefault(len(ids), []).append((document, start, ids))
        self.held += len(ids)

    def _take(self, length: int):
        pieces = self.pool[length]
        piece = pieces.pop()
        if not pieces:
            del self.pool[length]
            del self.lengths[bisect.bisect_left(self.lengths, length)]
        self.held -= length
        return piece

    def _fill(self):
        while self.held >= self.capacity:
            longest = self.lengths[-1]
            room = self.capacity - longest
            smaller = range(bisect.bisect_right(self.lengths, room) - 1, -1, -1)
            lengths = map(self.lengths.__getitem__, smaller)
            picked = fullest(((n, len(self.pool[n]) - (n == longest)) for n in lengths), room)
            picked[longest] = picked.get(longest, 0) + 1
            slack = self.capacity - sum(n * k for n, k in picked.items())
            for _ in range(1 if slack else min(len(self.pool[n]) // k for n, k in picked.items())):
                window = [self._take(n) for n, k in sorted(picked.items(), reverse=True) for _ in range(k)]
                if slack:
                    document, start, ids = self._take(self.lengths[-1])
                    window.append((document, start, ids[:slack]))
                    self._return(document, start + slack, ids[slack:])
                self._place(window)

    def ready(self, names: list[str], id_type) -> pa.RecordBatch:
        """The rows whose documents have been read to their end."""
        document, start, length, crc, sequence, offset = zip(*self.rows)
        self.rows = []
        values = [pa.array([d[0] for d in document], id_type)] + [
            pa.array(v, pa.int64()) for v in (start, length, crc, [d[1] for d in document], sequence, offset)]
        return pa.RecordBatch.from_arrays(values, names)


def pack(docs: DataFrame, model: str, *, id_col="doc_id", text_col="text", capacity: int = CAPACITY, end: int = END,
         pool: int = POOL) -> DataFrame:
    """One row per piece: the document's id and PIECE. `model` is the path of a tokenizers file.

    ids_crc32 is of the piece's ids as little-endian 32-bit numbers; doc_tokens counts the end token.
    """
    with open(model, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())       # a file of fixed size
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    names = ["doc_id", *PIECE]
    schema = T.StructType([T.StructField("doc_id", narrow.schema["doc_id"].dataType)] + [T.StructField(c, T.LongType()) for c in PIECE])

    def run(batches):
        encoder, packer, id_type = Encoder(shared.value), Packer(capacity, pool, TaskContext.get().partitionId() << 32), None
        last = np.array([end], np.uint32)
        for batch in batches:
            ids, id_type = batch.column("doc_id").to_pylist(), batch.column("doc_id").type
            for rows, parts, ends in slices(batch.column("text").to_pylist()):
                for row, tokens, done in zip(rows, encoder.encode(parts), ends):
                    packer.feed(tokens)
                    if done:
                        packer.feed(last)
                        packer.end(ids[row])
            if packer.rows:
                yield packer.ready(names, id_type)
        packer.finish()
        if packer.rows:
            yield packer.ready(names, id_type)

    return narrow.mapInArrow(run, schema)
