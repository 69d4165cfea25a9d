"""Byte-pair encoding and decoding with a compiled merge automaton.

Cases: a null or empty text has no tokens and decodes to an empty text. Any valid text comes back
unchanged. Each row is encoded on its own, so repeated rows, equal ids, null ids and further columns
need no care; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.merge_automaton import MergeAutomaton, read_vocabulary

# The pattern that splits text into words before byte-level merges.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Letters and digits are those of Unicode 16, which the vocabulary's library knows; `regex` may know more.
LATE = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc"
    "\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4"
    "\ua7dd\ua7e2\ua7f1\uab6c-\uab6d\U000107bb-\U000107bf"
    "\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    "\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    "\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128"
    "\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96"
    "\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed"
    "\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead"
    "\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
REMEMBERED = 400_000  # words and pieces that a worker keeps; then it starts afresh
TOGETHER = 2_000_000  # characters of texts whose new words are encoded in one go
ROWS = 512  # rows of a batch that are worked on at a time
IN_STEP = 64  # longer words are encoded on their own


class Encoder:
    """Splits texts into words and encodes the new ones all at once; remembers what it has encoded."""

    def __init__(self, automaton: MergeAutomaton, special: dict[str, int]):
        self.automaton, self.special = automaton, {s: np.array([k], "<u4").tobytes() for s, k in special.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.split = regex.compile(WORDS).findall
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}  # what stands between single spaces, read with the space before it

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, start, size = [], 0, 0
        for k, text in enumerate(texts):
            size += len(text)
            if size > TOGETHER:
                out += self._together(texts[start : k + 1])
                start, size = k + 1, 0
        return out + self._together(texts[start:])

    def _together(self, texts: list[str]) -> list[bytes]:
        if len(self.pieces) + len(self.words) > REMEMBERED:
            self.pieces, self.words = {}, {}
        new: dict[str, list[str]] = {}
        units = [self._units(text, new) for text in texts]
        wanted = {w for some in units for kind, x in some if kind == "words" for w in x}.union(*new.values())
        self._learn(wanted.difference(self.words))
        for piece, words in new.items():
            self.pieces[piece] = b"".join([self.words[w] for w in words])
        known = {"words": self.words.__getitem__, "pieces": self.pieces.__getitem__, "ids": self.special.__getitem__}
        return [b"".join([b for kind, x in some for b in map(known[kind], x)]) for some in units]

    def _learn(self, words: set[str]) -> None:
        short = [w for w in words if len(w) <= IN_STEP]
        self.words.update(zip(short, self.automaton.encode_many([w.encode() for w in short])))
        for word in words.difference(short):
            self.words[word] = np.array(self.automaton.encode(word.encode()), "<u4").tobytes()

    def _units(self, text: str, new: dict[str, list[str]]) -> list[tuple[str, list[str]]]:
        """What a text consists of, as lists of words, pieces or special tokens; `new` gets unknown pieces."""
        if any(s in text for s in self.special):
            units = []
            for k, part in enumerate(self.cut.split(text)):
                units += [("ids", [part])] if k % 2 else self._plain(part, new)
            return units
        return self._plain(text, new)

    def _plain(self, text: str, new: dict[str, list[str]]) -> list[tuple[str, list[str]]]:
        if not text:
            return []
        if not is_latin(text) and late().search(text):
            return [("words", old_words()(text))]
        first, *rest = text.split(" ")
        unknown = set(rest).difference(self.pieces).difference(new)
        if not first or first[-1].isspace() or any(not p or p[0].isspace() or p[-1].isspace() for p in unknown):
            return [("words", self.split(text))]  # white space of several characters: words depend on neighbours
        for p in unknown:
            if p.isalpha():
                new[p] = [" " + p]
            elif p[-1] in ".,;:!?" and p[:-1].isalpha():
                new[p] = [" " + p[:-1], p[-1]]
            else:
                new[p] = self.split(" " + p)
        return [("words", self.split(first)), ("pieces", rest)]


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@functools.cache
def late() -> regex.Pattern:
    return regex.compile(f"[{LATE}]")


@functools.cache
def old_words():
    """Splits by the pattern with later letters and digits taken as other characters."""
    letter, digit = rf"[\p{{L}}--[{LATE}]]", rf"[\p{{N}}--[{LATE}]]"
    other = rf"[[^{SPACE}\p{{L}}\p{{N}}]||[{LATE}]]"
    return regex.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{digit}+| ?{other}+|\\s+(?!\\S)|\\s+", regex.V1).findall


@functools.lru_cache(maxsize=4)
def compiled(path: str) -> bytes:
    """The automaton of a vocabulary file and its special tokens, packed for the executors."""
    labels, merges, special = read_vocabulary(path)
    return pickle.dumps((MergeAutomaton(labels, merges), special))


LOADED: dict[bytes, Encoder] = {}


def loaded(packed: Broadcast) -> Encoder:
    """The encoder of this worker, which keeps what it has learned from task to task."""
    key = hashlib.sha256(packed.value).digest()
    if key not in LOADED:
        LOADED.clear()
        LOADED[key] = Encoder(*pickle.loads(packed.value))
    return LOADED[key]


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that a worker holds little at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _type(rows: DataFrame) -> str:
    return rows.schema["doc_id"].dataType.simpleString()


def _decoded(label: Callable[[int], bytes], ids: bytes) -> str:
    return b"".join(map(label, unpacked(ids))).decode("utf-8", "replace") if ids else ""


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """One row per row of `docs`: `doc_id` and `ids`, the token ids as packed little-endian uint32.

    Strings of special tokens in a text become these tokens, as the vocabulary's library does it. With
    `decoded` the ids are decoded in the same pass, to `text`.
    """
    # some MB that depend on the vocabulary alone, never on the data
    packed = docs.sparkSession.sparkContext.broadcast(compiled(path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(packed)
        label = encoder.automaton.labels.__getitem__
        for batch in _each(batches):
            ids = encoder.encode_all([t or "" for t in batch.column(1).to_pylist()])
            columns = {"doc_id": batch.column(0), "ids": pa.array(ids, pa.binary())}
            if decoded:
                columns["text"] = pa.array([_decoded(label, i) for i in ids], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(encode, f"doc_id {_type(rows)}, ids binary" + ", text string" * decoded)


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds `text`, the labels of the ids' arcs, joined; bytes that are not UTF-8 become U+FFFD."""
    labels = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(path)[0])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = labels.value.__getitem__
        for batch in _each(batches):
            texts = [_decoded(label, i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(decode, f"doc_id {_type(rows)}, ids binary, text string")


def unpacked(ids: bytes) -> list[int]:
    """The ids of one row as numbers."""
    return np.frombuffer(ids, "<u4").tolist()
