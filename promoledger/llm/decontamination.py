"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items.

Texts are normalised byte for byte: A to Z become lower-case and whatever is no
word becomes a space, so a place in the normalised text is a place in the
original. Every run of ten words of an item is a pattern, bordered by spaces;
each whole text runs through the automaton once. A word inside any occurrence is
hit, and runs of hit words come back as spans of the original text.

The automaton lives in memory, so its size is checked: windows of up to ``LIMIT``
characters make one; a larger benchmark is dealt over several of that size, which
see the texts one after the other, and their hits are united.

Cases: null, empty and blank texts have no word; an item of fewer than ten words
is one window, an item of none is no window; an item of null id marks words and
is not among the items; repeated items count once; repeated documents are rows of
their own; an empty benchmark hits nothing; an input column called like an output
column is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoledger.llm.common import table, unused, with_outputs
from promoledger.session import stage
from promoledger.sources.storage import delete_folder

WINDOW = 10
# The pattern of a word, after lower-casing: digits, a to z and all beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Characters of windows in one automaton, which takes some 50 bytes for each.
LIMIT = 4_000_000
#: Bytes of a text that are looked at in one go, about.
_PIECE = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOUND = "n_words long, hits array<struct<first: long, words: long, begin: long, end: long>>, items array<string>"
OUTPUTS = ["n_words", "hits", "items"]


def plain_bytes(text: str | None) -> bytes:
    """The text in UTF-8, A to Z in lower case, with a space for every byte that is in no word."""
    return (text or "").encode("utf-8", "replace").translate(_TABLE)


def _table() -> bytes:
    kept = {c: c for c in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]}
    return bytes(kept.get(c, c + 32 if 0x41 <= c <= 0x5A else 32) for c in range(256))


_TABLE = _table()


def word_pieces(plain: bytes, size: int = _PIECE) -> Iterator[list[bytes]]:
    """The words of a normalised text, of about ``size`` bytes at a time, so that a very long text is never a list of all its words."""
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + size)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def words_of(text: Column) -> Column:
    """The words of a text, in DataFrame functions."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), 0)


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """``item, words, window``: the distinct windows of every item, words joined by one space."""
    found = items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("found")).where(F.size("found") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("found") - (size - 1)))
    cut = found.select("item", "found", F.explode(starts).alias("start"))
    parts = F.slice("found", F.col("start"), F.lit(size))
    return cut.select("item", F.size(parts).alias("words"), F.array_join(parts, " ").alias("window")).distinct()


class Scanner:
    """The automaton of ``(window, words, item)`` rows, and what it finds in a text."""

    def __init__(self, windows: list[tuple[str, int, str | None]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        number: dict[str, int] = {}
        self.items: list[list[str]] = []
        sizes: list[int] = []
        for window, words, item in windows:
            at = number.setdefault(window, len(sizes))
            if at == len(sizes):
                sizes.append(words)
                self.items.append([])
                self.automaton.add_word(f" {window} ".encode().decode("latin-1"), at)
            if item is not None:
                self.items[at].append(item)
        self.sizes = np.array(sizes, np.int64)
        self.longest = max(sizes, default=0)
        if sizes:
            self.automaton.make_automaton()

    def scan(self, plain: bytes) -> tuple[int, np.ndarray, set[int]]:
        """Number of words, (first word, word after the last) of all occurrences, numbers of the windows."""
        seen, tail = 0, []
        runs, numbers = [], set()
        for words in word_pieces(plain):
            both = tail + words
            if self.longest and both:
                line = b" " + b" ".join(both) + b" "
                found = list(self.automaton.iter(line.decode("latin-1")))
                if found:
                    ends, which = np.array(found, np.int64).T
                    borders = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
                    after = np.searchsorted(borders, ends) + seen - len(tail)
                    runs.append(np.unique(np.stack([after - self.sizes[which], after], axis=1), axis=0))
                    numbers.update(which.tolist())
            seen += len(words)
            tail = both[max(0, len(both) - self.longest + 1) :] if self.longest > 1 else []
        return seen, np.concatenate(runs) if runs else np.zeros((0, 2), np.int64), numbers


def merged(runs: np.ndarray) -> np.ndarray:
    """Overlapping and adjoining runs as one, in order."""
    if not len(runs):
        return runs
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    reach = np.maximum.accumulate(runs[:, 1])
    new = np.concatenate([[True], runs[1:, 0] > reach[:-1]])
    return np.stack([runs[new, 0], reach[np.append(np.flatnonzero(new)[1:] - 1, len(runs) - 1)]], axis=1)


def places(plain: bytes, raw: bytes, runs: np.ndarray) -> np.ndarray:
    """Begin and end of runs of words in the original text, in code points."""
    inside = np.frombuffer(plain, np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    bounds = np.stack([edges[0::2][runs[:, 0]], edges[1::2][runs[:, 1] - 1]], axis=1)
    lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    flat = np.concatenate([[0], bounds.ravel()])
    steps = [np.count_nonzero(lead[a:b]) for a, b in zip(flat[:-1], flat[1:], strict=True)]
    return np.cumsum(steps).reshape(-1, 2)


def _scan_udf(windows):
    """Hits of one automaton, united with those that a row has already."""

    @F.arrow_udf(_FOUND)
    def scan(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        scanner = Scanner(windows.value)
        for texts, before in batches:
            n_words, sizes, items, item_sizes = [], [0], [], [0]
            columns: list[list[np.ndarray]] = [[], [], [], []]
            for text, old in zip(texts, before, strict=True):
                text, old = text.as_py(), old.as_py()
                plain = plain_bytes(text)
                words, runs, numbers = scanner.scan(plain)
                names = {name for number in numbers for name in scanner.items[number]}
                if old:
                    names.update(old["items"])
                    runs = np.concatenate([runs, np.array([(h["first"], h["first"] + h["words"]) for h in old["hits"]], np.int64).reshape(-1, 2)])
                runs = merged(runs)
                if len(runs):
                    at = places(plain, text.encode("utf-8", "replace"), runs)
                    for column, values in zip(columns, (runs[:, 0], runs[:, 1] - runs[:, 0], at[:, 0], at[:, 1]), strict=True):
                        column.append(values)
                n_words.append(words)
                sizes.append(sizes[-1] + len(runs))
                items.extend(sorted(names))
                item_sizes.append(len(items))
            hits = pa.StructArray.from_arrays([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in columns], ["first", "words", "begin", "end"])
            lists = [pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), hits), pa.ListArray.from_arrays(pa.array(item_sizes, pa.int32()), pa.array(items, pa.string()))]
            yield pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), *lists], OUTPUTS)

    return scan


def find_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW, limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``n_words``; ``hits``, the runs of hit words (first word, words, begin and end in the text); ``items``, the ids of the items found, sorted as strings."""
    spark = docs.sparkSession
    windows, path = stage(item_windows(items, item_col, item_text_col, size), "windows")
    letters = windows.agg(F.sum(F.length("window") + 2)).first()[0] or 0
    parts = max(1, math.ceil(letters / limit))
    state = unused(docs, "found")
    found, last = docs.withColumn(state, F.lit(None).cast(f"struct<{_FOUND.replace('n_words long', 'n_words: long').replace('hits array', 'hits: array').replace('items array', 'items: array')}>")), None
    for part in range(parts):
        mine = windows.where(F.pmod(F.xxhash64("window", "item"), F.lit(parts)) == part)
        rows = [(r["window"], r["words"], r["item"]) for r in mine.toLocalIterator()]
        found = found.withColumn(state, _scan_udf(spark.sparkContext.broadcast(rows))(F.col(f"`{text_col}`"), F.col(state)))
        if parts > 1:
            (found, now), before = stage(found, "scanned"), last
            last = now
            if before:
                delete_folder(spark, before)
    delete_folder(spark, path)
    kept = [c for c in with_outputs(docs, OUTPUTS)]
    return found.select(*kept, *[F.col(f"{state}.{c}").alias(c) for c in OUTPUTS])


def query(spark, sf_dir: str) -> DataFrame:
    """op11: how much of every document stands in the benchmark."""
    found = find_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, hit: total + hit["words"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


SQL = rf"""
with docs as (
  select row_number() over () as row_id, doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}'), []) as words from documents),
items as (
  select item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') as words from benchmark where text is not null),
windows as (
  select distinct item_id, least(len(words), {WINDOW}) as size, array_to_string(words[start_ + 1:start_ + {WINDOW}], ' ') as win
  from (select item_id, words, unnest(range(0, greatest(1, len(words) - {WINDOW - 1}))) as start_ from items where len(words) > 0)),
places as (select row_id, words, unnest(range(0, len(words))) as start_ from docs),
sizes as (select distinct size from windows),
found as (
  select p.row_id, p.start_, s.size, array_to_string(p.words[p.start_ + 1:p.start_ + s.size], ' ') as win
  from places p join sizes s on p.start_ + s.size <= len(p.words)),
matches as (select f.row_id, f.start_, f.size, w.item_id from found f join windows w using (win)),
hits as (select row_id, count(distinct place) as n_hit from (select row_id, unnest(range(start_, start_ + size)) as place from matches) group by row_id),
named as (select row_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from matches group by row_id)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit, coalesce(n.n_items, 0)::bigint as n_items,
       sha256(coalesce(n.ids, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated
from docs d left join hits h using (row_id) left join named n using (row_id)
"""
