"""BPE encoding and decoding with a pair occurrence index.

The distinct words of a block of rows are laid out as one array of symbols. An
index maps every pair that has a rank to all its positions in that array. Ranks
are then taken in ascending order from a heap of active ranks; all occurrences of
the rank's pair are merged at once, and the pairs that lost or gained a neighbour
have their lists updated. As words do not touch, the lowest rank of the whole
array is at its turn also the lowest of each word that has it, so every word gets
exactly the merges it would get alone.

A block is a bounded number of rows and bytes; words already encoded in the same
task are remembered, up to ``MAX_WORDS``, then forgotten: that bounds memory and
changes no result. There is no shuffle. The vocabulary file is read by the driver
from the path given and travels as a broadcast (its size is that of the file).

Defined cases: a null text counts as empty and has no tokens; special tokens
written out in a text become their ids, as the library does; null ids decode to
empty text; extra columns are not read; an empty table gives an empty result.
Characters that entered Unicode so lately that the tables of Python, ``regex`` and
the library differ (some 1,500, from Unicode 16 on) may be split otherwise.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeferry.llm.common import ship

#: Rows and characters of one block; words remembered by a task.
BLOCK_ROWS, BLOCK_CHARS, MAX_WORDS = 1_000, 3_000_000, 120_000
#: Ids decoded at once.
BLOCK_IDS = 2_000_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it prints, else from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    moved = {b: 256 + i for i, b in enumerate(others)}
    return [chr(moved.get(b, b)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """What encoding needs, as plain arrays that pickle small."""

    tokens: list[str]  # by id
    inner: np.ndarray  # id of a byte inside a word
    final: np.ndarray  # id of a byte that ends a word
    pairs: np.ndarray  # left << 32 | right, sorted
    ranks: np.ndarray  # of those pairs
    left: np.ndarray  # by rank
    right: np.ndarray
    merged: np.ndarray  # by rank
    specials: dict[str, int]
    pattern: str


def load_vocabulary(path: str) -> Vocabulary:
    """Read a tokenizer file of this kind: NFC, white space, lower case; split; byte-level BPE with word ends."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
    steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
    if steps != ["NFC", "Replace", "Lowercase"] or not split["invert"] or spec["decoder"] is not None:
        raise ValueError("a tokenizer file of another kind")
    vocab, suffix = model["vocab"], model["end_of_word_suffix"]
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    names = {i: t for t, i in {**vocab, **specials}.items()}
    left, right, merged = (
        np.array(column, dtype=np.int64)
        for column in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]))
    )
    codes = left << 32 | right
    order = np.argsort(codes, kind="stable")
    symbols = byte_symbols()
    return Vocabulary(
        [names[i] for i in range(len(names))],
        np.array([vocab[s] for s in symbols]),
        np.array([vocab[s + suffix] for s in symbols]),
        codes[order], order, left, right, merged, specials, split["pattern"]["Regex"],
    )


class Encoder:
    """Encodes the words of one task; holds no state that a result depends on."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.words = regex.compile(vocabulary.pattern)
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.specials))) if vocabulary.specials else None
        self.white = regex.compile(r"\s+")
        self.forget()

    def forget(self) -> None:
        self.index = _Numbered()
        self.flat = np.empty(0, dtype=np.int32)
        self.starts = np.empty(0, dtype=np.int64)
        self.lengths = np.empty(0, dtype=np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it has none."""
        code = left << 32 | right
        place = np.minimum(np.searchsorted(self.v.pairs, code), len(self.v.pairs) - 1)
        return np.where(self.v.pairs[place] == code, self.v.ranks[place], -1)

    def merge(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Symbols after all merges; -1 where one was absorbed. ``ends`` marks each word's last."""
        n = len(symbols)
        after = np.where(ends, n, np.arange(1, n + 1)).astype(np.int32)  # n: no neighbour
        before = np.empty(n + 1, dtype=np.int32)
        before[0], before[1:] = -1, np.where(ends, -1, np.arange(n))
        sym = np.append(symbols, -1)
        here = np.flatnonzero(~ends)
        rank = self.rank_of(sym[here], sym[here + 1])
        occurrences: dict[int, list[np.ndarray]] = {}
        self._add(occurrences, rank, here)
        active = list(occurrences)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            at = occurrences.pop(r)
            at = np.sort(np.concatenate(at))
            at = at[np.concatenate([[True], at[1:] != at[:-1]])]
            a, b = self.v.left[r], self.v.right[r]
            next_ = after[at]
            at = at[(sym[at] == a) & (sym[next_] == b)]
            if a == b and len(at) > 1:
                at = _every_other(at, after)
            if not len(at):
                continue
            gone = after[at]
            sym[at], sym[gone] = self.v.merged[r], -1
            beyond = after[gone]
            after[at] = beyond
            inside = beyond < n
            before[beyond[inside]] = at[inside]
            # Neighbours on either side now form new pairs; of touching merges both see the other.
            prior = before[at]
            starts = np.concatenate([prior[prior >= 0], at[inside]])
            if len(starts):
                rank = self.rank_of(sym[starts], sym[after[starts]])
                for new in self._add(occurrences, rank, starts):
                    heapq.heappush(active, new)
        return sym[:n]

    @staticmethod
    def _add(occurrences: dict[int, list[np.ndarray]], rank: np.ndarray, at: np.ndarray) -> list[int]:
        """Enter positions under their ranks; the ranks that were not active before."""
        known = rank >= 0
        rank, at = rank[known], at[known]
        if not len(rank):
            return []
        order = np.argsort(rank, kind="stable")
        rank, at = rank[order], at[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        fresh = []
        for r, part in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
            if r in occurrences:
                occurrences[r].append(part)
            else:
                occurrences[r] = [part]
                fresh.append(r)
        return fresh

    def learn(self, words: list[str]) -> None:
        """Encode words not seen before and remember them."""
        pieces, counts = [], []
        for word in words:
            if word.isalpha():
                pieces.append(word)
                counts.append(1)
                continue
            found = self.words.findall(word)
            pieces += found
            counts.append(len(found))
        coded = [p.encode() for p in pieces]
        raw = np.frombuffer(b"".join(coded), dtype=np.uint8)
        sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        ends = np.zeros(len(raw), dtype=bool)
        ends[np.cumsum(sizes) - 1] = True
        symbols = np.where(ends, self.v.final[raw], self.v.inner[raw])
        merged = self.merge(symbols, ends) if len(symbols) else symbols
        alive = merged >= 0
        piece_of = np.repeat(np.arange(len(coded)), sizes)
        word_of = np.repeat(np.arange(len(words)), counts)
        lengths = np.bincount(word_of[piece_of[alive]], minlength=len(words)) if len(coded) else np.zeros(len(words), int)
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate([self.flat, merged[alive].astype(np.int32)])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])

    def split(self, text: str) -> list[str]:
        """Normalised words between white space; the pattern never crosses it."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            # One character at a time, as the library does: no final sigma.
            text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        else:
            text = text.lower()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space to str.split alone
            return [w for w in self.white.split(text) if w]
        return text.split()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text)."""
        if len(self.index) > MAX_WORDS:
            self.forget()
        number, marked = self.index.__getitem__, len(self.v.tokens)
        rows, known = [], len(self.index)
        for text in texts:
            if self.special and "<" in text and self.special.search(text):
                words, last = [], 0
                for found in self.special.finditer(text):
                    words += map(number, self.split(text[last : found.start()]))
                    words.append(-1 - self.v.specials[found.group()])
                    last = found.end()
                words += map(number, self.split(text[last:]))
            else:
                words = list(map(number, self.split(text)))
            rows.append(np.array(words, dtype=np.int64))
        fresh = list(self.index)[known:] if len(self.index) > known else []
        if fresh:
            self.learn(fresh)
        flat = np.concatenate([self.flat, np.arange(marked, dtype=np.int32)])  # specials stand for themselves
        word = np.concatenate(rows) if rows else np.empty(0, dtype=np.int64)
        plain = word >= 0
        safe = np.where(plain, word, 0)
        if len(self.starts):
            starts = np.where(plain, self.starts[safe], len(self.flat) - 1 - word)
            lengths = np.where(plain, self.lengths[safe], 1)
        else:
            starts, lengths = len(self.flat) - 1 - word, np.ones(len(word), dtype=np.int64)
        closed = np.concatenate([[0], np.cumsum(lengths)])
        ids = flat[np.repeat(starts - closed[:-1], lengths) + np.arange(closed[-1])]
        return ids, closed[np.cumsum([len(r) for r in rows])] if rows else np.empty(0, dtype=np.int64)


class _Numbered(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


def _every_other(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of runs of overlapping occurrences (a pair of equal symbols) the first, third, ... of each run."""
    chained = np.concatenate([[False], after[at[:-1]] == at[1:]])
    run = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
    return at[(np.arange(len(at)) - run) % 2 == 0]


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a block has a bounded number of rows and characters."""
    for batch in batches:
        size = np.cumsum(np.nan_to_num(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)))
        start = 0
        while start < batch.num_rows:
            base = size[start - 1] if start else 0
            stop = int(np.searchsorted(size, base + BLOCK_CHARS, side="right"))
            stop = min(max(stop, start + 1), start + BLOCK_ROWS, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    id_col: str = "doc_id",
    text_col: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """doc_id and ids (array<int>) of every row's whole text.

    With ``decoded`` also ``text``, what those ids decode to, in the same pass.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for block in _blocks(batches):
            ids, closed = encoder.encode([t or "" for t in block.column(1).to_pylist()])
            offsets = pa.array(np.concatenate([[0], closed]).astype(np.int32))
            rows = pa.ListArray.from_arrays(offsets, pa.array(ids))
            if decoded:
                spelled = _spelled(rows, pa.array(encoder.v.tokens, pa.string()))
                yield pa.RecordBatch.from_arrays([block.column(0), rows, spelled], names=["doc_id", "ids", "text"])
            else:
                yield pa.RecordBatch.from_arrays([block.column(0), rows], names=["doc_id", "ids"])
            # Workers live on after their task; what they do not need goes back.
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>" + ", text string" * decoded)


def decode(vocabulary: Vocabulary, spark: SparkSession):
    """A function from a column of ids to the text the library decodes them to."""
    ship(spark)
    shared = spark.sparkContext.broadcast(vocabulary.tokens)

    @F.arrow_udf("string")
    def text(ids: pa.Array) -> pa.Array:
        names = pa.array(shared.value, pa.string())
        size = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))
        out, start = [pa.array([], pa.string())], 0
        while start < len(ids):
            base = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, base + BLOCK_IDS, side="right")))
            out.append(_spelled(ids.slice(start, stop - start), names))
            start = stop
        return pa.concat_arrays(out)

    return text


def _spelled(rows: pa.ListArray, names: pa.Array) -> pa.Array:
    """Tokens of each row of ids, joined by spaces."""
    rows = pc.fill_null(rows, pa.scalar([], rows.type))
    lengths = pc.list_value_length(rows).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(rows.flatten())), " ")
