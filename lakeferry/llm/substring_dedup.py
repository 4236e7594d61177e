"""Passages that repeat: paragraphs, MinHash banding, exact Jaccard, components.

There are two kinds of paragraphs.

A line paragraph is what stands between line breaks, or a whole text without any, of
``WORDS`` words or more. Its shingles of five words get ``BANDS`` keys, each from
``ROWS`` minima: at Jaccard similarity 0.8 two of them share a key with a chance of
0.999. Those that share one are compared exactly, and components of similar ones are
clusters.

Line breaks say little about where a copied passage begins or was edited, so the other
kind is a window of ``WORDS`` words that starts at an anchor: a word whose five-word
shingle has the least hash within some ``SPREAD`` neighbouring starts. Equal stretches of
``WORDS + SPREAD - 1`` (33) words or more surely have a window in common, wherever they
stand; shorter ones down to ``WORDS`` mostly do. A window with an edited word inside
falls below 0.8 (five of its 18 shingles change), so windows are joined on all their
words: a passage that was edited here and there is found by the windows between the
edits, a line paragraph also as a whole.

1. One pass over the texts sends narrow entries (hashes, document, place) to groups of
   bounded expected size. What occurs more than once within a batch of a map task is
   one entry, so that a passage a third of all documents have is an entry per batch and
   no group grows with it; its places there wait aside.
2. A group knows all entries of its hashes: it gives every exact repeat the smallest
   place, and tells which line paragraphs share a key with a different one. The waiting
   places are joined to the smallest ones, rows against few rows.
3. Line paragraphs that share a key are read once more from their documents. Their
   shingle sets are joined on prefixes in order of rarity (``ngram_join.links``), not
   pair by pair within a key, which a million lines from one template would have in
   common; exact Jaccard decides, and components follow.
4. An exact or similar occurrence stays at the smallest place (document, start), in one
   document or in several, and is to go from the others. Overlapping ones of a document
   that share that fate are one span. A similar line paragraph counts from the first to
   the last shingle that one like it has too.

Words and shingles are compared by 64-bit hashes, windows and whole lines by 96 bits, line
paragraphs that share a key are told apart by 64.

Defined cases: lines of fewer than ``WORDS`` words are no paragraph, and texts of
fewer, null and empty ones have none; of windows of one document that overlap the place
kept, all are kept; a run of overlapping equal windows is two places, its first window
and the rest; rows that share an id are one document; rows without an id take no part;
an empty table gives an empty result; extra columns are not read. Positions count
characters of the text. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lakeferry.llm import words
from lakeferry.llm.common import ceil_div, ship, stored
from lakeferry.llm.components import components
from lakeferry.llm.ngram_join import links, prefix_sets
from lakeferry.llm.subwords import sliced

WORDS, SPREAD, SIZE = 22, 12, 5
BANDS, ROWS = 10, 3
CHUNK_BYTES = 500_000
#: Expected entries of one group, and the least number of groups of each kind.
GROUP_ENTRIES, MIN_GROUPS = 1_000_000, 32
#: Documents with a shared key whose ids may be sent to every task; beyond, the texts are shuffled to them.
LISTED_DOCUMENTS = 200_000
_SEEDS = np.random.default_rng(78).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)
_SECOND_BASE = np.uint64(0xD6E8FEB86659FD93)
#: What a row of the groups' result is.
REPEAT, WAITING, LEAST, NEAR = 0, 1, 2, 3


def _sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """``choose`` (minimum or maximum) over every window of ``width``, by doubling."""
    span = 1
    while span * 2 <= width:
        values = choose(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return choose(values[: len(values) - rest], values[rest:]) if rest else values


def _anchors(order: np.ndarray, valid: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Positions that are least in some window of ``SPREAD`` valid starts of their text."""
    n = len(order)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    padded = np.concatenate([order, np.full(SPREAD, _MOST)])
    whole = np.concatenate([valid, np.zeros(SPREAD, dtype=bool)])
    least = _sliding(np.where(whole, padded, _MOST), SPREAD, np.minimum)[:n]
    run = np.cumsum(np.concatenate([[0], whole]))
    full = (run[SPREAD : SPREAD + n] - run[:n]) == SPREAD
    # The greatest minimum of the full windows that hold a position; none is 0.
    met_ = np.where(full, least, np.uint64(0))
    behind = np.concatenate([np.zeros(SPREAD - 1, dtype=np.uint64), met_])
    chosen = valid & (_sliding(behind, SPREAD, np.maximum) == order)
    # Texts with fewer valid starts than a window have one anchor: the least of all.
    count = np.bincount(text[valid], minlength=int(text[-1]) + 1)
    short = valid & (count[text] < SPREAD)
    if short.any():
        at = np.flatnonzero(short)
        first = np.concatenate([[True], text[at][1:] != text[at][:-1]])
        low = np.minimum.reduceat(order[at], np.flatnonzero(first))
        chosen[at] |= order[at] == np.repeat(low, np.diff(np.append(np.flatnonzero(first), len(at))))
    return np.flatnonzero(chosen)


def _run_hashes(code: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64 bits, 32 more) of the words from ``first`` to before ``stop``, wherever they stand."""
    n = len(code)
    out = []
    for base, salt in ((np.uint64(words.BASE), np.uint64(1)), (_SECOND_BASE, np.uint64(2))):
        ascending = np.multiply.accumulate(np.full(n, base))
        inverse = np.multiply.accumulate(np.full(n, np.uint64(pow(int(base), -1, 1 << 64))))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words.mixed(code + salt) * ascending, dtype=np.uint64)])
        size = (stop - first).astype(np.uint64)
        out.append(words.mixed((sums[stop] - sums[first]) * (inverse[first] if n else first.astype(np.uint64)) + size * salt))
    return out[0], (out[1] >> np.uint64(32)).astype(np.uint32)


def _line_keys(grams: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """BANDS keys of every run of words from ``first`` to before ``stop``, by its whole shingle set."""
    keys = np.empty((len(first), BANDS), dtype=np.uint64)
    if not len(first):
        return keys
    edges = np.column_stack([first, stop - SIZE + 1]).ravel()
    padded = np.append(grams, _MOST)
    for band in range(BANDS):
        key = np.full(len(first), np.uint64(band + 1))
        for row in range(ROWS):
            low = np.minimum.reduceat(padded * _SEEDS[band * ROWS + row], edges)[::2]
            key = words.mixed(key * np.uint64(0x9E3779B97F4A7C15) + low)
        keys[:, band] = key
    return keys


def _pieces(texts: pa.Array) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """(number of the first text, words of the piece): lower-cased, in pieces of some ``CHUNK_BYTES``.

    code: hash of each word; grams: of the shingle that begins there; of: its text; from, to:
    its characters; first, stop: the words of each line paragraph.
    """
    space, edge = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    start = 0
    for piece in sliced(texts, CHUNK_BYTES):
        lowered = pc.ascii_lower(pc.fill_null(piece.cast(pa.large_string()), edge))
        padded = pc.binary_join_element_wise(lowered, edge, space)
        _, offsets, raw = padded.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64)[padded.offset : padded.offset + len(padded) + 1]
        data, bounds = np.frombuffer(raw, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]
        begins, finishes, of = words.spans(data, bounds)
        n = len(begins)
        code = words.hashes(data, begins, finishes)
        tailed = np.concatenate([code, np.zeros(SIZE - 1, dtype=np.uint64)])
        grams = words.mixed(sum(tailed[k : n + k] * np.uint64(2 * k + 3) for k in range(SIZE))) if n else code
        letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters before a byte
        base = letters[bounds[of]]
        line = np.cumsum((data == 10) | (data == 13))[begins]
        cut = np.flatnonzero((line[1:] != line[:-1]) | (of[1:] != of[:-1])) + 1
        first, stop = (np.append(0, cut), np.append(cut, n)) if n else (cut, cut)
        long_ = stop - first >= WORDS
        yield start, {
            "code": code, "grams": grams, "of": of, "from": letters[begins] - base, "to": letters[finishes] - base,
            "first": first[long_], "stop": stop[long_], "count": np.bincount(of, minlength=len(bounds) - 1),
        }
        start += len(piece)


def _windows(p: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Windows at anchors; overlapping equal ones of a text are one entry, or two if the run holds its first window again."""
    n = len(p["code"])
    last = np.cumsum(p["count"])[p["of"]] if n else p["of"]
    at = _anchors(words.mixed(p["grams"] ^ np.uint64(0x5BF0_3635)), np.arange(n) + WORDS <= last, p["of"])
    token, check = _run_hashes(p["code"], at, at + WORDS)
    text = p["of"][at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (at[1:] >= at[:-1] + WORDS) | (token[1:] != token[:-1]) | (check[1:] != check[:-1])
    first = np.flatnonzero(new)
    end = np.append(first[1:], len(at))[: len(first)] - 1
    again = np.flatnonzero(at[end] - at[first] >= WORDS)
    whole = np.where(at[end] - at[first] >= WORDS, at[first], at[end]) + WORDS - 1
    chosen = np.concatenate([first, first[again]])
    return {
        "token": token[chosen], "check": check[chosen], "text": text[chosen],
        "start": np.concatenate([p["from"][at[first]], p["from"][at[first[again]] + WORDS]]) if n else at,
        "end": np.concatenate([p["to"][whole], p["to"][at[end[again]] + WORDS - 1]]) if n else at,
    }


def _lines(p: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    first, stop = p["first"], p["stop"]
    token, check = _run_hashes(p["code"], first, stop)
    none = np.empty(0, dtype=np.int64)
    return {
        "token": token, "check": check, "text": p["of"][first] if len(first) else none,
        "start": p["from"][first] if len(first) else none, "end": p["to"][stop - 1] if len(first) else none,
        "keys": _line_keys(p["grams"], first, stop),
    }


#: Columns of the entries of a group, packed, and their types.
_PACKED = {"token": np.uint64, "check": np.uint64, "doc": np.int64, "start": np.int32, "length": np.int32, "settled": np.uint8}


def _packed(part: np.ndarray, cells: dict[str, np.ndarray]) -> pa.RecordBatch | None:
    """One row per part with the entries that belong to it.

    Numbers are written byte by byte (all first bytes, all second bytes, ...), so that
    high bytes, which are mostly nought, are compressed away on the wire.
    """
    if not len(part):
        return None
    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    bounds = np.append(cuts, len(part)).tolist()
    columns = [pa.array(part[cuts], pa.int32())]
    for name, kind in _PACKED.items():
        values = cells[name].astype(kind)[order].view(np.uint8).reshape(len(part), -1)
        columns.append(pa.array([values[a:b].T.tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=["part", *_PACKED])


def _opened(table: pa.Table) -> dict[str, np.ndarray]:
    def column(name: str, kind: type) -> np.ndarray:
        width = np.dtype(kind).itemsize
        planes = (np.frombuffer(x.as_buffer(), dtype=np.uint8).reshape(width, -1) for x in table.column(name))
        return np.concatenate([np.ascontiguousarray(p.T).view(kind)[:, 0] for p in planes])

    cells = {name: column(name, kind) for name, kind in _PACKED.items()}
    return cells | {"end": cells["start"] + cells.pop("length")}


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Whether a row of sorted columns differs from the one before."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _exact_entries(found: dict[str, np.ndarray], groups: int) -> Iterator[pa.RecordBatch]:
    """Entries of windows and lines: what a batch holds twice is one entry, and its places wait in a part of their own.

    Places that overlap the first one of the batch are one with it.
    """
    order = np.lexsort((found["end"], found["start"], found["doc"], found["check"], found["token"]))
    found = {k: v[order] for k, v in found.items()}
    first = np.flatnonzero(_firsts(found["token"], found["check"]))
    low = np.repeat(first, np.diff(np.append(first, len(order))))
    own = (found["doc"] == found["doc"][low]) & (found["start"] < found["end"][low])
    if len(first):
        found["end"][first] = np.maximum.reduceat(np.where(own, found["end"], 0), first)
        own[first] = False
    found = {k: v[~own] for k, v in found.items()}
    found["length"] = found["end"] - found["start"]
    new = _firsts(found["token"], found["check"])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(new)))
    sent = {k: v[first] for k, v in found.items()} | {"settled": times > 1}
    yield _packed((words.mixed(sent["token"]) % np.uint64(groups)).astype(np.int64), sent)
    twice = np.flatnonzero(np.repeat(times > 1, times))
    waiting = {k: v[twice] for k, v in found.items()} | {"settled": np.ones(len(twice))}
    # Dealt out by place, so that the places of one passage do not meet.
    aside = words.mixed(waiting["doc"].view(np.uint64) + waiting["start"].astype(np.uint64)) % np.uint64(groups)
    yield _packed(-1 - aside.astype(np.int64), waiting)


def _near_entries(found: dict[str, np.ndarray], keys: np.ndarray, offset: int, groups: int) -> Iterator[pa.RecordBatch]:
    """Entries of band keys, one per different line paragraph of a batch; a key that several have is settled at once."""
    order = np.lexsort((found["start"], found["doc"], found["token"]))
    kept = order[_firsts(found["token"][order])] if len(order) else order
    key, of = keys[kept].ravel(), np.repeat(kept, BANDS)
    order = np.argsort(key, kind="stable")
    key, of = key[order], of[order]
    first = np.flatnonzero(_firsts(key))
    times = np.diff(np.append(first, len(key)))

    def cells(at: np.ndarray, token: np.ndarray, settled: np.ndarray) -> dict[str, np.ndarray]:
        """``check`` is the paragraph."""
        zero = np.zeros(len(at))
        return {
            "token": token, "check": found["token"][at], "doc": found["doc"][at], "start": found["start"][at],
            "length": zero, "settled": settled,
        }

    # A group tells keys apart by 32 bits; a chance meeting costs a comparison.
    sent = cells(of[first], key[first] & np.uint64(0xFFFFFFFF), times > 1)
    yield _packed(offset + (words.mixed(key[first]) % np.uint64(groups)).astype(np.int64), sent)
    sure = np.unique(of[np.repeat(times > 1, times)])
    yield _packed(offset + groups + found["doc"][sure] % groups, cells(sure, np.zeros(len(sure)), np.ones(len(sure))))


_FOUND = (
    "kind int, token long, check int, doc_id long, start int, `end` int, keep_doc long, keep_start int, keep_end int"
)
_COLUMNS = [c.split()[0].strip("`") for c in _FOUND.split(", ")]


def _rows(kind: int, n: int, **cells: np.ndarray) -> pa.Table:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), *[pa.int32()] * 2, pa.int64(), *[pa.int32()] * 2]
    columns = [pa.array(cells[c], k) if c in cells else pa.nulls(n, k) for c, k in zip(_COLUMNS[1:], kinds[1:])]
    return pa.table([pa.array(np.full(n, kind), pa.int32()), *columns], names=_COLUMNS)


def _place(e: dict[str, np.ndarray], at: np.ndarray, names: tuple[str, str, str]) -> dict[str, np.ndarray]:
    return {name: e[k][at] for name, k in zip(names, ("doc", "start", "end"))}


OWN, KEEP = ("doc_id", "start", "end"), ("keep_doc", "keep_start", "keep_end")


def _meet_exact(e: dict[str, np.ndarray]) -> pa.Table:
    """Repeats of single entries, and the least place of what waits elsewhere."""
    order = np.lexsort((e["end"], e["start"], e["doc"], e["check"], e["token"]))
    e = {k: v[order] for k, v in e.items()}
    new = _firsts(e["token"], e["check"])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(new)))
    low = np.repeat(first, times)
    apart = (e["doc"] != e["doc"][low]) | (e["start"] >= e["end"][low])
    settled = e["settled"] > 0
    shared = np.repeat(np.logical_or.reduceat(apart | settled, first), times)
    at = np.flatnonzero(shared & ~settled)
    tokens = {"token": e["token"].view(np.int64), "check": e["check"].astype(np.uint32).view(np.int32)}
    single = _rows(REPEAT, len(at), **{k: v[at] for k, v in tokens.items()}, **_place(e, at, OWN), **_place(e, low[at], KEEP))
    flagged = first[np.logical_or.reduceat(settled, first)]
    least = _rows(LEAST, len(flagged), **{k: v[flagged] for k, v in tokens.items()}, **_place(e, flagged, KEEP))
    return pa.concat_tables([single, least])


def _near(e: dict[str, np.ndarray], at: np.ndarray) -> pa.Table:
    return _rows(NEAR, len(at), token=e["check"][at].view(np.int64), doc_id=e["doc"][at], start=e["start"][at])


def _meet_near(e: dict[str, np.ndarray]) -> pa.Table:
    """Line paragraphs that share a key with a different one, each once for every place told."""
    order = np.lexsort((e["check"], e["token"]))
    e = {k: v[order] for k, v in e.items()}
    first = np.flatnonzero(_firsts(e["token"]))
    times = np.diff(np.append(first, len(order)))
    differs = (e["check"] != np.repeat(e["check"][first], times)) | (e["settled"] > 0)
    at = np.flatnonzero(np.repeat(np.logical_or.reduceat(differs, first), times))
    at = at[np.lexsort((e["start"][at], e["doc"][at], e["check"][at]))]
    return _near(e, at[_firsts(e["check"][at], e["doc"][at], e["start"][at])] if len(at) else at)


def _meetings(texts: DataFrame, total_bytes: int) -> DataFrame:
    """Exact repeats, places that wait for the least one of theirs, these least ones, and line paragraphs with a shared key."""
    # About one window per forty bytes of text and, at most, ten keys per ``WORDS`` words; a guess only sizes the groups.
    exact = max(MIN_GROUPS, ceil_div(total_bytes, 40 * GROUP_ENTRIES))
    near = max(MIN_GROUPS, ceil_div(total_bytes, 40 * GROUP_ENTRIES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found, lines, keys = [], [], []
            for start, piece in _pieces(batch.column(1)):
                pair = [_windows(piece), _lines(piece)]
                keys.append(pair[1].pop("keys"))
                for cells in pair:
                    cells["doc"] = ids[cells.pop("text") + start].astype(np.int64)
                found += pair
                lines.append(pair[1])
            joined = lambda parts: {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
            if found:
                yield from filter(None, _exact_entries(joined(found), exact))
                yield from filter(None, _near_entries(joined(lines), np.concatenate(keys), exact, near))
            del found, lines, keys
            pa.default_memory_pool().release_unused()

    def meet(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        entries = _opened(table)
        if part < 0:
            tokens = {"token": entries["token"].view(np.int64), "check": entries["check"].astype(np.uint32).view(np.int32)}
            everything = np.arange(len(entries["doc"]))
            return _rows(WAITING, len(everything), **tokens, **_place(entries, everything, OWN))
        if part < exact:
            return _meet_exact(entries)
        if part < exact + near:
            return _meet_near(entries)
        return _near(entries, np.arange(len(entries["doc"])))

    schema = "part int, " + ", ".join(f"{name} binary" for name in _PACKED)
    return texts.mapInArrow(run, schema).groupBy("part").applyInArrow(meet, _FOUND)


_NODE = "node long, doc_id long, start long, `end` long, n long, tokens array<long>, shingles array<long>, steps array<int>"


def _paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, text, wanted: start and node) to the wanted line paragraphs.

    tokens: distinct shingles; shingles: all, in the order of words; steps: characters
    from each word to the next, from the last one to the end.
    """

    def lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(values, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wanted = batch.column(0), batch.column(2)
            for offset, p in _pieces(batch.column(1)):
                first, stop = p["first"], p["stop"]
                if not len(first):
                    continue
                text, start = p["of"][first], p["from"][first]
                token = _run_hashes(p["code"], first, stop)[0].view(np.int64)
                held = {t: {(w["start"], w["node"]) for w in wanted[t + offset].as_py()} for t in np.unique(text).tolist()}
                keep = np.array([(s, k) in held[t] for t, s, k in zip(text.tolist(), start.tolist(), token.tolist())])
                first, stop, text, start, token = (x[keep] for x in (first, stop, text, start, token))
                size = stop - first
                runs = size - SIZE + 1
                inside = np.arange(runs.sum()) + np.repeat(first - np.cumsum(runs) + runs, runs)
                places = np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)
                grams, owner = p["grams"][inside], np.repeat(np.arange(len(first)), runs)
                order = np.lexsort((grams, owner))
                fresh = order[_firsts(grams[order], owner[order])] if len(order) else order
                sets = np.bincount(owner[fresh], minlength=len(first))
                end = p["to"][stop - 1]
                following = np.append(p["from"][1:], 0)[places]
                following[np.cumsum(size) - 1] = end
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(token), ids.take(pa.array(text + offset, pa.int64())), pa.array(start, pa.int64()),
                        pa.array(end, pa.int64()), pa.array(sets, pa.int64()),
                        lists(grams[fresh].view(np.int64), sets, pa.int64()), lists(grams.view(np.int64), runs, pa.int64()),
                        lists(following - p["from"][places], size, pa.int32()),
                    ],
                    names=["node", "doc_id", "start", "end", "n", "tokens", "shingles", "steps"],
                )
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, _NODE)


def _extent(own: str, other: str) -> tuple[Column, Column]:
    """Places of the first and the last shingle of ``own`` that ``other`` has, from 0."""
    backward = F.reverse(own)
    first = F.array_position(own, F.element_at(F.array_intersect(own, other), 1)) - 1
    last = F.size(own) - F.array_position(backward, F.element_at(F.array_intersect(backward, F.col(other)), 1))
    return first, last


def _extents(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, from, to): the first and the last shingle that a similar paragraph has too."""
    one, two = (nodes.select(F.col("node").alias(s), F.col("shingles").alias(f"{s}_shingles")) for s in "ab")
    joined = pairs.join(one, "a").join(two, "b")
    cells = []
    for side, other in ("ab", "ba"):
        first, last = _extent(f"{side}_shingles", f"{other}_shingles")
        cells.append(F.struct(F.col(side).alias("node"), first.cast("int").alias("from"), last.cast("int").alias("to")))
    ends = joined.select(F.explode(F.array(*cells)).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.min("from").alias("from"), F.max("to").alias("to"))


def _similar(texts: DataFrame, places: DataFrame, percent: int) -> DataFrame:
    """Occurrences of similar line paragraphs: doc_id, start, end, keep_doc, kept, cluster.

    ``places``: (node, doc_id, start); equal paragraphs are one node, at their least place.
    """
    least = places.groupBy("node").agg(F.min(F.struct("doc_id", "start")).alias("least"))
    wanted = least.groupBy("least.doc_id").agg(F.collect_list(F.struct("least.start", "node")).alias("wanted"))
    wanted = stored(wanted, "wanted")
    documents, paragraphs = wanted.agg(F.count("*"), F.sum(F.size("wanted"))).first()
    listed = F.broadcast(wanted) if documents <= LISTED_DOCUMENTS else wanted
    nodes = stored(_paragraphs(texts.join(listed, "doc_id").select("doc_id", "text", "wanted")), "paragraphs")
    if nodes.count() > (paragraphs or 0):  # rows that share an id and a text
        nodes = stored(nodes.dropDuplicates(["node"]), "paragraphs")
    pairs = links(stored(prefix_sets(nodes.select("node", "n", "tokens"), percent), "sets"), percent)
    pairs = stored(pairs, "links")
    named = nodes.select("node", "doc_id", "start", "steps").join(components(pairs), "node")
    named = named.join(_extents(pairs, nodes), "node")
    before = lambda k: F.aggregate(F.slice("steps", 1, k), F.lit(0), lambda a, x: a + x)
    named = named.select(
        "label", "doc_id", (F.col("start") + before(F.col("from"))).alias("start"),
        (F.col("start") + before(F.col("to") + SIZE)).alias("end"),
    )
    keep = named.groupBy("label").agg(F.min(F.struct("doc_id", "start", "end")).alias("keep"))
    return named.join(keep, "label").select(
        "doc_id", "start", "end", F.col("keep.doc_id").alias("keep_doc"),
        ((F.col("doc_id") == F.col("keep.doc_id")) & (F.col("start") < F.col("keep.end"))).alias("kept"),
        F.concat(F.lit("n"), F.lower(F.hex("label"))).alias("cluster"),
    )


def _spans(occurrences: DataFrame) -> DataFrame:
    """Overlapping occurrences of a document that share their fate are one span; what is kept ends where something goes."""
    along = W.partitionBy("doc_id", "kept").orderBy("start", "end", "cluster")
    reach = F.max("end").over(along.rowsBetween(W.unboundedPreceding, -1))
    spans = occurrences.withColumn("fresh", F.when(reach >= F.col("start"), 0).otherwise(1))
    spans = spans.withColumn("span", F.sum("fresh").over(along.rowsBetween(W.unboundedPreceding, 0)))
    spans = spans.groupBy("doc_id", "kept", "span").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        F.min("keep_doc").alias("keep_doc_id"), F.min("cluster").alias("cluster_id"),
    )
    by_start = W.partitionBy("doc_id").orderBy("start", "kept")
    gone = F.expr("not kept")
    before = F.max(F.when(gone, F.col("end"))).over(by_start.rowsBetween(W.unboundedPreceding, -1))
    after = F.min(F.when(gone, F.col("start"))).over(by_start.rowsBetween(1, W.unboundedFollowing))
    left = spans.withColumns(
        {
            "from": F.when(F.col("kept"), F.greatest("start", before)).otherwise(F.col("start")),
            "to": F.when(F.col("kept"), F.least("end", after)).otherwise(F.col("end")),
        }
    ).where(F.col("from") < F.col("to"))
    return left.select(
        "doc_id", F.col("from").alias("start"), F.col("to").alias("end"), "kept", "keep_doc_id", "cluster_id"
    )


def repeats(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per span of repeated passages: doc_id, start, end, kept, keep_doc_id, cluster_id.

    ``end`` is exclusive. A span that goes may hold several passages; ``keep_doc_id`` and
    ``cluster_id`` are of the first of them.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.where("doc_id is not null")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    found = stored(_meetings(texts, total), "meetings")
    of = lambda kind: found.where(F.col("kind") == kind)
    least = of(LEAST).select("token", "check", *KEEP)
    waited = of(WAITING).select("token", "check", *OWN).join(least, ["token", "check"])
    exact = of(REPEAT).select("token", "check", *OWN, *KEEP).unionByName(waited)
    kept = (F.col("doc_id") == F.col("keep_doc")) & (F.col("start") < F.col("keep_end"))
    told = exact.select(
        "doc_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "keep_doc",
        kept.alias("kept"), F.concat(F.lit("e"), F.lower(F.hex("token"))).alias("cluster"),
    )
    places = of(NEAR).select(F.col("token").alias("node"), "doc_id", F.col("start").cast("long").alias("start"))
    return _spans(told.unionByName(_similar(texts, places, percent)))
