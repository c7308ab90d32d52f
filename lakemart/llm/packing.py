"""Harmonic packing of tokenised documents into fixed-length sequences.

A piece whose length lies in (C/(j+1), C/j] belongs to class j, and a sequence
of class j holds exactly j pieces: the reciprocal-capacity classes of Harmonic
bin packing. Every worker (scan partition) fills its classes' sequences alone,
so there is no shuffle and no shared state. Because documents may be cut, a
piece that would leave more than ``slack`` of the capacity unused in its class
gives off a piece of the next class's full share and goes on with the rest.
Whatever is left in unfilled sequences at the end of a partition is strung
together and cut at the capacity; the last rest is cut at powers of two (such
sequences need no padding).

Sequence ids are ``partition << 33 | running number``: a re-run task (lost
executor) reads the same rows and writes the same ids.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Shared, slices, text_bytes

CAPACITY = 2048
END_ID = 1
SLACK = 0.01


def cut(length: int, capacity: int, slack: float) -> list[tuple[int, int]]:
    """(piece length, class) in document order."""
    out = []
    least = capacity * (1 - slack)
    while length >= capacity:
        out.append((capacity, 1))
        length -= capacity
    while length:
        j = capacity // length
        if j * length >= least or length == 1:
            out.append((length, j))
            break
        share = capacity // (j + 1)
        out.append((share, capacity // share))
        length -= share
    return out


class WordIds:
    """Ids of whole texts as little-endian uint32 bytes. Where the vocabulary's
    normaliser and splitter never look across white space (see SPLITS), ids are
    kept per white-space word, and a word of letters goes straight to the merges
    in the form that the normaliser and the byte alphabet give it. The store is
    emptied when full (bounded memory). Other vocabularies encode whole texts."""

    #: The steps before the merges for which words can be encoded alone.
    NORMAL = ["NFC", "Replace", "Lowercase"]
    SPLITS = ["Split", "ByteLevel"]
    #: Control characters that Python's split() takes for white space and the tokenizer doesn't.
    ODD = re.compile("[\x1c-\x1f]")
    #: Letters and the signs behind them: always split by the tokenizer between the two.
    PLAIN = re.compile(r"([^\W\d_]+)([.,:;!?#$%&*]*)\Z")
    #: Letters whose lower case depends on their place or is longer.
    MOODY = re.compile("[\u0130\u03a3]")

    def __init__(self, spec: str, room: int = 500_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(spec)
        self.room = room
        self.words: dict[str, bytes] = {}
        form = json.loads(spec)
        kinds = lambda part, key: [x["type"] for x in (form.get(part) or {}).get(key, [])]
        self.by_word = (kinds("normalizer", "normalizers") == self.NORMAL and form["model"]["type"] == "BPE"
                        and kinds("pre_tokenizer", "pretokenizers") == self.SPLITS
                        and not form["pre_tokenizer"]["pretokenizers"][-1]["add_prefix_space"])
        self.merges = self.tokenizer.model.tokenize
        self.alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def letters(self, w: str) -> bytes:
        """The ids of letters only, in lower case."""
        ids = self.words.get(w)
        if ids is None:
            if not w.isascii():
                w_bytes = self.alphabet(unicodedata.normalize("NFC", w))[0][0]
            else:
                w_bytes = w
            found = [t.id for t in self.merges(w_bytes)]
            ids = self.words[w] = struct.pack(f"<{len(found)}I", *found)
        return ids

    def word(self, w: str) -> bytes:
        m = self.PLAIN.match(w)
        if m and not self.MOODY.search(w) and m[1].isalpha() and (w.isascii() or unicodedata.is_normalized("NFC", w)):
            ids = self.letters(m[1].lower())
            if m[2]:
                signs = self.words.get(m[2])
                if signs is None:
                    signs = self.words[m[2]] = self.encode(m[2])
                ids += signs
        else:
            ids = self.encode(w)
        self.words[w] = ids
        return ids

    def text(self, text: str) -> bytes:
        if not self.by_word or self.ODD.search(text):
            return self.encode(text)
        if len(self.words) > self.room:
            self.words.clear()
        get, word = self.words.get, self.word
        return b"".join([get(w) or word(w) for w in text.split()])


class Packer:
    """The sequences of one worker."""

    def __init__(self, worker: int, capacity: int, slack: float):
        self.capacity, self.slack = capacity, slack
        self.next_id = worker << 33
        self.open: dict[int, list[tuple]] = {}
        self.out: list[tuple] = []

    def emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.out.append((doc, start, n, ids, total, self.next_id, offset))
            offset += n
        self.next_id += 1

    def add(self, doc, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        for n, j in cut(total, self.capacity, self.slack):
            mine = self.open.setdefault(j, [])
            mine.append((doc, start, ids[4 * start:4 * (start + n)], total))
            start += n
            if len(mine) == j:
                self.emit(self.open.pop(j))

    def close(self) -> None:
        rest = [p for j in sorted(self.open) for p in self.open[j]]
        self.open = {}
        left = sum(len(p[2]) // 4 for p in rest)
        row: list[tuple] = []
        room = 0
        for doc, start, ids, total in rest:
            at, n = 0, len(ids) // 4
            while at < n:
                if not room:  # the next sequence: whole, or the largest power of two that the rest fills
                    room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
                k = min(room, n - at)
                row.append((doc, start + at, ids[4 * at:4 * (at + k)], total))
                at += k
                room -= k
                left -= k
                if not room:
                    self.emit(row)
                    row = []

    def take(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, slack: float = SLACK,
         end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start (ids of the document before it), length,
    ids (little-endian uint32), doc_tokens, sequence_id, offset (in the sequence).

    Null and empty texts are the end id alone. Repeated rows are packed once
    each. A null doc_id is kept. Other columns are ignored; an empty table
    gives an empty result. A text of any length is read whole; memory per
    worker is one Arrow slice, the open sequences and the word store."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = Shared(docs.sparkSession, f.read(), WordIds)  # one vocabulary file: fixed size
    doc_type = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", doc_type), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    end = struct.pack("<I", end_id)

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        store = shared.get()
        packer = Packer(TaskContext.get().partitionId(), capacity, slack)

        def rows():
            out = packer.take()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow.types)], schema=arrow)

        for batch in slices(batches, lambda b: text_bytes(b.column(1)), 4 << 20):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packer.add(doc, store.text(text) + end if text else end)
            if packer.out:
                yield rows()
        packer.close()
        if packer.out:
            yield rows()

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def pieces(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """``pack`` with the ids' checksum instead of the ids."""
    return pack(docs, tokenizer_path, **options).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
