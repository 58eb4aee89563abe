"""Packing by power-of-two decomposition: no sequence crosses documents and none is padded.

A document's token ids (its tokenizer's ids and one closing id) are cut into
pieces of the longest sequence length as often as they fit and then into the
powers of two of the rest's binary form, longest first.  Every piece is a
sequence of its own; sequences of equal length form a bucket, from which
batches of equal shape are taken.

Defined cases: a null or empty text is the closing id alone; a null doc_id
stays null; repeated rows are packed as often as they occur; an empty table
gives an empty result.  Texts go through the tokenizer whole.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from .common import as_column, importable

MAX_LENGTH = 2048
CLOSING_ID = 1
#: Words whose ids a worker remembers, the longest word it remembers, and characters of text whose words it learns together.
MEMORY_WORDS = 800_000
MEMORY_CHARS = 40
TOGETHER = 1_000_000
#: ASCII signs without the apostrophe, which may start a run of letters.
_SIGNS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")


class WordIds:
    """Token ids of texts, remembered by word.

    The tokenizer drops white space and never joins what white space parts, so
    a text's ids are its words' ids in a row.  That holds for texts of Latin-1
    letters and ASCII white space, whose lower-casing and composition look at
    one character at a time; any other text goes to the tokenizer whole.
    """

    _other = re.compile("[^\\t\\n\\r\\x20-\\x7e\\u00a1-\\u00ff]")

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.memory: dict[str, bytes] = {}
        # how the tokenizer writes the bytes of letters before its model sees them
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelled = {c: spell(chr(c))[0][0] for c in range(0xA1, 0x100)}

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str) -> bytes:
        """Ids of a lower-case word of letters: it is one run, which normalising and splitting leave as it is."""
        return array("I", [t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.spelled))]).tobytes()

    def _learn(self, words: set[str]) -> None:
        """Put new words' ids into the memory; signs that close a word of letters are a token run of their own."""
        memory = self.memory
        for word in words:
            if word.isalpha():
                memory[word] = self._letters(word)
            elif (stem := word.rstrip(_SIGNS)).isalpha():
                signs = word[len(stem):]
                if stem not in memory:
                    memory[stem] = self._letters(stem)
                if signs not in memory:
                    memory[signs] = self._whole(signs)
                memory[word] = memory[stem] + memory[signs]
            else:
                memory[word] = self._whole(word)

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each whole text."""
        split = [None if self._other.search(t) or "<|" in t else t.lower().split() for t in texts]
        words = set().union(*(w for w in split if w))
        new = words.difference(self.memory)
        if new and len(self.memory) + len(new) > MEMORY_WORDS:
            self.memory.clear()
            new = words
        if new:
            self._learn(new)
        get = {w: self.memory[w] for w in words}.__getitem__
        out = [self._whole(t) if w is None else b"".join(map(get, w)) for t, w in zip(texts, split, strict=True)]
        for w in [w for w in new if len(w) > MEMORY_CHARS]:
            self.memory.pop(w, None)
        return out


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per worker process and tokenizer file."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def _parts(texts: list[str | None]) -> Iterator[list[str]]:
    """The texts in runs of about TOGETHER characters."""
    run, size = [], 0
    for text in texts:
        run.append(text or "")
        size += len(run[-1])
        if size >= TOGETHER:
            yield run
            run, size = [], 0
    if run:
        yield run


def piece_lengths(tokens: int, max_length: int = MAX_LENGTH) -> list[int]:
    """Longest pieces first, then the rest's binary form."""
    whole, rest = divmod(tokens, max_length)
    return [max_length] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         max_length: int = MAX_LENGTH, closing_id: int = CLOSING_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket and, if asked for, ids.

    The only state of a task is its word memory, so nothing is shuffled;
    sequence ids are unique by task and position in it.
    """
    if max_length & (max_length - 1) or max_length < 1:
        raise ValueError("max_length must be a power of two")
    importable(docs.sparkSession)
    own = docs.select(as_column(id_col).alias("doc_id"), as_column(text_col).cast("string").alias("text"))
    closing = np.array([closing_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer_path)
        for batch in batches:
            row, start, length, crc, total, ids = [], [], [], [], [], []
            for i, coded in enumerate(c + closing for part in _parts(batch["text"].to_pylist()) for c in encoder.ids(part)):
                tokens, at = len(coded) // 4, 0
                for n in piece_lengths(tokens, max_length):
                    part = coded[4 * at:4 * (at + n)]
                    row.append(i)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    total.append(tokens)
                    if keep_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                    at += n
            columns = [batch["doc_id"].take(pa.array(row, pa.int32())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = dict(own.dtypes)["doc_id"]
    pieces = own.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if keep_ids else ""))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.monotonically_increasing_id().alias("sequence_id"),
                         F.lit(0).cast("long").alias("offset"), F.log2("length").cast("int").alias("bucket"), *(["ids"] if keep_ids else []))


def bucket_sizes(pieces: DataFrame) -> DataFrame:
    """(bucket, sequences, tokens): what a training run draws equal-shaped batches from."""
    return pieces.groupBy("bucket").agg(F.count("*").alias("sequences"), F.sum("length").alias("tokens"))
