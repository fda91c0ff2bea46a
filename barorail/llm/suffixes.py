"""Repeated passages by a sparse suffix array over the words of all documents.

Suffixes are kept only where content selects them: in each window of ``length`` words, at the smallest
hash among the runs of ``run`` words that begin in its first ``spread`` places. Equal windows select the same
place, so any two equal windows have kept suffixes that agree in at least ``length - spread + 1`` words.
Kept suffixes are sorted by the hash of that many words, which brings those that agree next to each other.
Where a suffix has such a neighbour it is extended to the left and right to all windows that selected it,
and neighbours are compared window by window. This finds every repeated window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_groups, map_rows, passing, saved, unused
from .hashing import U, mixed, word_codes

#: Suffixes that agree are compared by one task up to so many documents; beyond, by aggregation.
GROUP = 1000
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2**64))


def run_hashes(codes: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """For each size the hashes of all runs of so many words: a polynomial in the word codes."""
    n = len(codes)
    up = np.cumprod(np.full(n, _BASE, U)) * _INVERSE
    down = np.cumprod(np.full(n, _INVERSE, U)) * _BASE
    total = np.concatenate([np.zeros(1, U), np.cumsum(codes * down, dtype=U)])
    return [mixed((total[s:] - total[:-s]) * up[: n - s + 1]) for s in sizes]


def kept_suffixes(codes: np.ndarray, length: int, spread: int, run: int) -> tuple[np.ndarray, ...]:
    """(window hash of every window, place each one selects, suffix hash of every place)."""
    runs, suffixes, windows = run_hashes(codes, [run, length - spread + 1, length])
    starts = np.lib.stride_tricks.sliding_window_view(runs, spread)[: len(windows)]
    return windows, starts.argmin(axis=1) + np.arange(len(windows)), suffixes


def _candidates(docs: DataFrame, length: int, spread: int, run: int) -> DataFrame:
    """key and suffix hash of each kept suffix that agrees with another; and whether with very many."""

    def rows(keys, texts) -> Iterator[tuple]:
        for key, text in zip(keys, texts):
            codes = word_codes(text)
            if len(codes) >= length:
                _, places, suffixes = kept_suffixes(codes, length, spread, run)
                found, times = np.unique(suffixes[np.unique(places)], return_counts=True)
                for suffix, n in zip(found.view(np.int64).tolist(), times.tolist()):
                    yield key, suffix, n

    kind = docs.schema["key"].dataType.simpleString()
    kept = saved(map_rows(docs.select("key", "text"), rows, f"key {kind}, suffix long, times int"), "suffixes")
    met = kept.groupBy("suffix").agg(F.sum("times").alias("times"), F.count("*").alias("docs"))
    met = saved(met.where("times > 1").select("suffix", (F.col("docs") > GROUP).alias("hot")), "repeated")
    return kept.select("key", "suffix").join(met, "suffix")


def _extended(docs: DataFrame, candidates: DataFrame, length: int, spread: int, run: int) -> DataFrame:
    """suffix, hot, key, doc_id, start, windows: consecutive windows from ``start`` that selected a candidate.

    A window that repeats within its document and does not overlap its first place there is a copy
    whatever other documents hold. Of those only the last goes on with the others; the rest come out
    finished, with suffix NULL and their end in ``windows``. So a long periodic text stays short here.
    """

    def rows(keys, ids, texts, found) -> Iterator[tuple]:
        for key, doc_id, text, known in zip(keys, ids, texts, found):
            codes = word_codes(text)
            if len(codes) < length:  # another row with this id had the passage
                continue
            hot = {f["suffix"]: f["hot"] for f in known}
            windows, places, suffixes = kept_suffixes(codes, length, spread, run)
            names = suffixes.view(np.int64)[places]
            wanted = np.isin(names, np.fromiter(hot, np.int64, len(hot)))
            _, first, which = np.unique(windows, return_index=True, return_inverse=True)
            at = np.arange(len(windows))
            last = np.zeros(len(first), np.int64)
            last[which] = at  # the last one written stays
            done = wanted & (at >= first[which] + length) & (at != last[which])
            for start, end in _runs(done):
                yield None, None, key, doc_id, start, [end + length - 1]
            for start, end in _runs(wanted & ~done, places):
                suffix = int(names[start])
                yield suffix, hot[suffix], key, doc_id, start, windows[start:end].view(np.int64).tolist()

    kinds = ", ".join(f"{name} {docs.schema[name].dataType.simpleString()}" for name in ("key", "doc_id"))
    listed = candidates.groupBy("key").agg(F.collect_set(F.struct("suffix", "hot")).alias("known"))
    # Texts are sorted and merged with what is found in them at any size, here and in ``cut_passages``.
    joined = docs.join(listed.hint("merge"), "key").select("key", "doc_id", "text", "known")
    return map_rows(joined, rows, f"suffix long, hot boolean, {kinds}, start int, windows array<bigint>")


def _runs(mask: np.ndarray, places: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs of a mask, cut where ``places`` changes."""
    at = np.flatnonzero(mask)
    if len(at):
        breaks = np.diff(at) > 1
        if places is not None:
            breaks |= np.diff(places[at]) != 0
        cuts = np.flatnonzero(breaks) + 1
        yield from zip(at[np.concatenate([[0], cuts])].tolist(), (at[np.concatenate([cuts - 1, [-1]])] + 1).tolist())


def _compared(extended: DataFrame, length: int) -> DataFrame:
    """key, start, end, copy of runs of repeated windows, by the order of suffixes."""

    def neighbours(suffix, rows) -> Iterator[tuple]:
        held = []
        for key, doc_id, start, windows in rows:
            held += [(w, doc_id is None, doc_id, key, start + i) for i, w in enumerate(windows)]
        held.sort()
        copies, sources = [], []
        at = 0
        while at < len(held):
            window, _, _, key, start = held[at]
            end = at + 1
            while end < len(held) and held[end][0] == window:
                end += 1
            if end - at > 1:
                same = held[at:end]
                copy = [x[3] != key or x[4] >= start + length for x in same]
                copies += [x[3:] for x, c in zip(same, copy) if c]
                if any(copy):
                    sources += [x[3:] for x, c in zip(same, copy) if not c]
            at = end
        for places, is_copy in ((copies, True), (sources, False)):
            for key, start, end in _joined(places):
                yield key, start, end + length, is_copy

    kind = extended.schema["key"].dataType.simpleString()
    rows = extended.where("NOT hot").select("suffix", "key", "doc_id", "start", "windows")
    return map_groups(rows, ["suffix"], neighbours, f"key {kind}, start int, end int, copy boolean")


def _joined(places: list[tuple]) -> Iterator[tuple]:
    """(key, first start, last start) of starts that follow each other."""
    places.sort()
    begin = before = None
    for place in places:
        if before is None or place[0] != before[0] or place[1] > before[1] + 1:
            if before is not None:
                yield begin[0], begin[1], before[1]
            begin = place
        before = place
    if before is not None:
        yield begin[0], begin[1], before[1]


def _compared_hot(extended: DataFrame, length: int) -> DataFrame:
    """The same for suffixes shared by very many documents, without gathering them."""
    hot = extended.where("hot")
    rows = hot.select("suffix", "key", "doc_id", "start", F.posexplode("windows").alias("i", "window"))
    rows = rows.select("suffix", "window", "key", "doc_id", (F.col("start") + F.col("i")).alias("start"))
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "key", "start")
    ends = rows.groupBy("suffix", "window").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = f"last.key <> first.key OR last.start >= first.start + {length}"
    ends = saved(ends.where(repeated).select("suffix", "window", "first"), "hot")
    rows = rows.join(ends, ["suffix", "window"])
    copy = F.expr(f"key <> first.key OR start >= first.start + {length}")
    return rows.select("key", "start", (F.col("start") + F.lit(length)).alias("end"), copy.alias("copy"))


def repeated_passages(
    docs: DataFrame, length: int = 50, spread: int = 25, run: int = 8, by: str = "doc_id"
) -> DataFrame:
    """doc_id, start, end, copy: passages all of whose words stand in repeated windows of ``length`` words.

    Places count words, which stand between ASCII white space; ``end`` is exclusive. A window is repeated
    if it occurs elsewhere, in another document or in the same without overlap. By the order of (doc_id,
    start) its first occurrence is the source; the others are copies. Passages of either kind are joined
    where they touch or overlap; a word may be in both, as the copy of one window and the source of another.

    NULL, empty and shorter texts have no windows; rows with a NULL doc_id are left out; rows with one
    doc_id are one document; other columns are ignored; an empty table gives no rows. ``by`` the row key of
    a ``keyed`` table every row is a document of its own, by the order of (doc_id, row, start) with NULL
    ids last, and the first column of the result is that key.
    """
    if length - spread + 1 < run:
        raise ValueError("spread leaves too few words in common")
    docs = docs.where(F.col(by).isNotNull() & F.col("text").isNotNull())
    docs = docs.select(F.col(by).alias("key"), "doc_id", "text")
    with passing(docs.sparkSession) as keep:
        return keep(_passages(docs, length, spread, run).withColumnRenamed("key", by), "passages")


def _passages(docs: DataFrame, length: int, spread: int, run: int) -> DataFrame:
    """key, start, end, copy of ``docs`` with key, doc_id and text."""
    candidates = _candidates(docs, length, spread, run)
    extended = saved(_extended(docs, candidates, length, spread, run), "extended")
    done = extended.where("suffix IS NULL").select(
        "key", "start", F.col("windows")[0].cast("int").alias("end"), F.lit(True).alias("copy")
    )
    found = done.unionByName(_compared(extended, length)).unionByName(_compared_hot(extended, length))

    def merge(key, spans) -> Iterator[tuple]:
        begin = last = None
        for start, end in sorted(spans):
            if last is not None and start <= last:
                last = max(last, end)
                continue
            if last is not None:
                yield key[0], begin, last, key[1]
            begin, last = start, end
        yield key[0], begin, last, key[1]

    kind = docs.schema["key"].dataType.simpleString()
    return map_groups(found.distinct(), ["key", "copy"], merge, f"key {kind}, start int, end int, copy boolean")


def cut_passages(docs: DataFrame, passages: DataFrame, by: str = "doc_id") -> DataFrame:
    """``docs`` without the copies in ``passages``, each with the white space behind it; n_chars anew.

    A text may become empty; no row is dropped, and texts without copies stay as they are.
    """
    listed = unused(docs.columns, "_cuts")
    cuts = passages.where("copy").groupBy(by).agg(F.collect_list(F.struct("start", "end")).alias(listed))
    joined = docs.join(cuts.hint("merge"), by, "left")
    names = joined.columns
    text_at, cuts_at = names.index("text"), names.index(listed)

    def cut(text: str, spans) -> str:
        places = [m.start() for m in WORD.finditer(text)] + [len(text)]
        out, at = [], 0
        for start, end in sorted((s["start"], s["end"]) for s in spans):
            if end < len(places):  # else the passage is of another row with this id
                out.append(text[at : places[start]])
                at = places[end]
        return "".join(out) + text[at:]

    def rows(*columns) -> Iterator[tuple]:
        for row in zip(*columns):
            row = list(row)
            if row[cuts_at] and row[text_at] is not None:
                row[text_at] = cut(row[text_at], row[cuts_at])
            yield (*row[:cuts_at], *row[cuts_at + 1 :])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema if f.name != listed)
    done = map_rows(joined, rows, schema).select(*docs.columns)
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else done
