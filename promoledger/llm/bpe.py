"""Byte-level BPE: encoding with a contiguous rank array, and decoding.

A text is cut into words by the vocabulary's pattern. Per word an array of part
boundaries and one of the ranks of adjacent parts are kept; the least rank is
searched, the boundary it names deleted, and the two neighbouring ranks looked up
anew, until no pair has a rank. Long words use the same merges with a heap, since
scanning is quadratic. A task remembers what it has met between
spaces.

Cases: null and empty texts have no ids; the vocabulary's special tokens in a
text become their own id; the whole text is encoded however long; repeated rows
give repeated results; an input column called like an output column is replaced.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoledger.llm.common import table

#: The vocabulary of the query; the path is a parameter everywhere else.
VOCABULARY = "byte_bpe_50k.json"
#: Words up to so many bytes are scanned; above, a heap finds the least rank.
SHORT = 128
#: Words, and pieces between spaces, that a task remembers before it forgets and starts anew.
REMEMBERED = 400_000
#: Texts that are Python objects at a time.
_ROWS = 250
#: Ids spelled out at a time.
_IDS = 1 << 17
# Fixed value: the pattern that cuts a text into words, as the vocabulary defines it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file, read backwards."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def load_vocabulary(path: str) -> tuple[list[int], dict[tuple[int, int], int], dict[str, int], list[bytes]]:
    """Ids of single bytes, (left, right) to rank and merged id in one number, special tokens, and the bytes of every id."""
    import json

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    back = byte_letters()
    own = lambda token: bytes(back[c] for c in token)
    vocabulary = content["model"]["vocab"]
    pairs = {}
    for rank, pair in enumerate(content["model"]["merges"]):
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        pairs[vocabulary[left], vocabulary[right]] = rank << _ID_BITS | vocabulary[left + right]
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    pieces = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
    for token, number in vocabulary.items():
        pieces[number] = own(token)
    for token, number in special.items():
        pieces[number] = token.encode()
    letters = {b: vocabulary[c] for c, b in back.items()}
    return [letters[b] for b in range(256)], pairs, special, pieces


#: A pair's rank above this many bits of the id it merges to.
_ID_BITS = 24
_ID = (1 << _ID_BITS) - 1
NO_RANK = 1 << 60


def merge_short(ids: list[int], pairs: dict[tuple[int, int], int]) -> list[int]:
    """Merge by scanning the contiguous rank array for its minimum (the leftmost of equal ones); ``ids`` is used up."""
    get = pairs.get
    ranks = [get(p, NO_RANK) for p in zip(ids, ids[1:])]
    while ranks:
        least = min(ranks)
        if least == NO_RANK:
            break
        i = ranks.index(least)
        ids[i] = least & _ID
        del ids[i + 1], ranks[i]
        if i < len(ranks):
            ranks[i] = get((ids[i], ids[i + 1]), NO_RANK)
        if i:
            ranks[i - 1] = get((ids[i - 1], ids[i]), NO_RANK)
    return ids


def merge_long(ids: list[int], pairs: dict[tuple[int, int], int]) -> list[int]:
    """The same merges with a heap and linked neighbours, for words beyond ``SHORT`` bytes."""
    ids, count = list(ids), len(ids)
    after, before = list(range(1, count + 1)), list(range(-1, count - 1))
    heap = [(pairs[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in pairs]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        if i >= 0 and after[i] < count and (found := pairs.get((ids[i], ids[after[i]]))) is not None:
            heapq.heappush(heap, (found, i, ids[i], ids[after[i]]))

    while heap:
        rank, i, left, right = heapq.heappop(heap)
        j = after[i]
        if ids[i] != left or j >= count or ids[j] != right:
            continue
        ids[i], ids[j], after[i] = rank & _ID, -1, after[j]
        if after[j] < count:
            before[after[j]] = i
        offer(i), offer(before[i])
    return [number for number in ids if number >= 0]


class Pieces(dict):
    """What stands between two spaces, with the space before it, to its ids as bytes; forgets when it is full."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(" " + piece)
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Turns texts into ids with one vocabulary; remembers pieces."""

    def __init__(self, path: str, pattern: str = PATTERN):
        import regex

        self.bytes, self.pairs, self.special, _ = load_vocabulary(path)
        self.words = regex.compile(pattern).findall
        # Where white space runs over a space, cutting at spaces would cut a word of the pattern.
        self.runs = regex.compile(r"\s \s|\s \Z").search
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.met: dict[str, bytes] = {}
        self.known = Pieces(self.by_words)

    def word(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "replace")
        return (merge_short if len(raw) <= SHORT else merge_long)([self.bytes[b] for b in raw], self.pairs)

    def by_words(self, text: str) -> bytes:
        met, found = self.met, []
        for word in self.words(text):
            ids = met.get(word)
            if ids is None:
                ids = array("i", self.word(word)).tobytes()
                if len(word) <= SHORT:
                    if len(met) >= REMEMBERED:
                        met.clear()
                    met[word] = ids
            found.append(ids)
        return b"".join(found)

    def plain(self, text: str) -> bytes:
        if self.runs(text):
            return self.by_words(text)
        first, *rest = text.split(" ")
        return self.by_words(first) + b"".join(map(self.known.__getitem__, rest))

    def encode(self, text: str) -> np.ndarray:
        parts = self.cut(text) if self.cut and any(s in text for s in self.special) else [text]
        ids = [array("i", [self.special[p]]).tobytes() if p in self.special else self.plain(p) for p in parts if p]
        return np.frombuffer(b"".join(ids), np.int32)


def _slices(batches: Iterator[pa.RecordBatch], left_out: Sequence[str]) -> Iterator[tuple[pa.RecordBatch, list[str], list[pa.Array]]]:
    """Short runs of rows, with the columns that stay: results are handed over before the next run is touched."""
    for batch in batches:
        kept = [n for n in batch.schema.names if n.lower() not in left_out]
        for at in range(0, batch.num_rows, _ROWS):
            rows = batch.slice(at, _ROWS)
            yield rows, kept, [rows.column(n) for n in kept]


def _encode_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str, text_col: str, out: str, left_out: Sequence[str]) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(path, pattern)
    for rows, names, columns in _slices(batches, left_out):
        found = [encoder.encode(text or "") for text in rows.column(text_col).to_pylist()]
        ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
        yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found)))], [*names, out])


def _schema(docs: DataFrame, left_out: Sequence[str], out: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in docs.schema.fields if f.name.lower() not in left_out] + [T.StructField(out, kind)])


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids", pattern: str = PATTERN, drop: Sequence[str] = ()) -> DataFrame:
    """``docs`` with the ids of each whole text, without the columns ``drop``; ``path`` is a file every executor has."""
    left_out = [c.lower() for c in (out, *drop)]
    run = partial(_encode_batches, path=path, pattern=pattern, text_col=text_col, out=out, left_out=left_out)
    return docs.mapInArrow(run, _schema(docs, left_out, out, T.ArrayType(T.IntegerType())))


def _decode_batches(batches: Iterator[pa.RecordBatch], path: str, ids_col: str, out: str, left_out: Sequence[str]) -> Iterator[pa.RecordBatch]:
    pieces = load_vocabulary(path)[3]
    sizes = np.array([len(p) for p in pieces], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    letters = np.frombuffer(b"".join(pieces), np.uint8)

    def spelled(ids: np.ndarray) -> bytes:
        size = sizes[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(begins[ids] - (ends - size), size)
        return letters[at].tobytes()

    def text(ids: np.ndarray) -> str:
        raw = b"".join(spelled(ids[at : at + _IDS]) for at in range(0, len(ids), _IDS))
        return raw.decode("utf-8", "replace")

    none = np.zeros(0, np.int32)
    for rows, names, columns in _slices(batches, left_out):
        texts = [text(row.values.to_numpy() if row.is_valid else none) for row in rows.column(ids_col)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*names, out])


def decode(docs: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text that the ids stand for; bytes that are no UTF-8 become U+FFFD."""
    return docs.mapInArrow(partial(_decode_batches, path=path, ids_col=ids_col, out=out, left_out=[out.lower()]), _schema(docs, [out.lower()], out, T.StringType()))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(spark, sf_dir: str) -> DataFrame:
    """op9: digests of the ids and of the text decoded from them, for every document."""
    path = vocabulary_path()
    encoded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, drop=("text",))
    both = decode(encoded, path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
