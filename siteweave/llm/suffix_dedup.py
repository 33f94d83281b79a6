"""Suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes that also starts elsewhere, by a distributed merge sort.

Sorting every suffix of a corpus would move its text hundreds of times, so suffixes are sampled by content: a window of
LENGTH bytes is represented by its minimizer, the position of the least hash among its first places. Equal windows have
their minimizers at the same offset, so only windows with equal text at the minimizer can be equal, and consecutive windows
with one minimizer form a span. Then:

1. Selection. The hash of the ``PREFIX`` bytes at each minimizer is counted. A minimizer whose hash is alone can't have a
   repeated window; nothing else is decided by hashes.
2. Runs. Each task sorts the suffixes at the minimizers that are left (cut at the end of their span, then what lies before
   the minimizer), joins equal ones, front-codes them and deals the sorted run out by range.
3. Merge. Each range combines its runs by a loser tree that knows, for every candidate, the common prefix with the last
   winner, and compares only what lies behind it. Neighbours that share PREFIX bytes are a group; spans that are equal as a
   whole are repeated as a whole, the others are compared window by window inside the group, on their bytes. A group of
   more than ``LOCAL_SPANS`` different spans is not held: its windows go on as 128-bit hashes and are counted in a shuffle.

What is repeated returns to its row as intervals.

Defined results: null text is empty; texts shorter than LENGTH lose nothing; rows are documents, so repeated rows repeat
each other; overlapping occurrences in one text count; strings are judged on the input; an empty table gives an empty table;
``with_repeats`` puts its two columns in the place of columns that are called so, other columns pass under any names.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.llm.common import packed, row_key, unpacked
from siteweave.recovery import cut

#: Bytes of a repeated string, and bytes at a minimizer that select it; the minimizer is one of the first LENGTH - PREFIX + 1 places.
LENGTH, PREFIX = 200, 64
#: Bytes that are hashed at each place to find minimizers.
GRAM = 16
#: Text is worked on in buffers of about so many bytes, and a longer document in pieces of so many windows.
BUFFER = 2_000_000
#: A task closes its sorted run after so many bytes of suffixes.
RUN_BYTES = 48_000_000
#: Groups with more different spans leave the merging task.
LOCAL_SPANS = 4096
#: A range has about so many bytes of suffixes, so a task's memory doesn't grow with the corpus; its number of ranges does.
RANGE_BYTES, SUFFIX_BYTES = 128_000_000, 300
#: Rows whose suffixes give the bounds of the ranges: at least so many, and so many for each range; suffixes taken from each.
SAMPLE_ROWS, SAMPLE_OF_RANGE, SAMPLE_EACH = 2000, 2, 8
#: Parts of 2 ** 20 that the hashes of rows are told apart by when rows are sampled.
GRAIN = 1 << 20

_BYTES = np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64((1 << 24) - 1)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * np.uint64(0x9E3779B97F4A7C15) + b
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def spans_of(buffer: np.ndarray, length: int = LENGTH, prefix: int = PREFIX, ends: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(first window, last window, minimizer, hash of the prefix) of each span, in order.

    ``ends`` are the ends of the documents in the buffer; no window crosses one. ``prefix`` is a power of two from GRAM up.
    """
    n, width = len(buffer) - length + 1, length - prefix + 1
    if n < 1:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    h, k = _BYTES[buffer], 1
    grams = h
    while k < prefix:
        h = _joined(h[: len(h) - k], h[k:])
        k *= 2
        if k == GRAM:
            grams = h
    key = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    padded = np.full(-(-len(key) // width) * width + width, np.uint64(2**64 - 1))
    padded[: len(key)] = key
    blocks = padded.reshape(-1, width)
    up = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = (np.minimum(down[:n], up[width - 1 : width - 1 + n]) & _PLACE).astype(np.int64)
    if ends is None:
        places = np.arange(n)
    else:
        inside = np.ones(n, bool)
        for end in ends:
            inside[max(0, end - length + 1) : end] = False
        places = np.flatnonzero(inside)
    if not len(places):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    at = least[places]
    turns = np.flatnonzero((np.diff(at) != 0) | (np.diff(places) != 1)) + 1
    first = np.r_[0, turns]
    last = np.r_[turns, len(places)] - 1
    return places[first], places[last], at[first], h[at[first]]


def _documents(texts: Iterator[tuple[int, bytes]], length: int, prefix: int) -> Iterator[tuple[list[int], list[int], bytes, np.ndarray, tuple[np.ndarray, ...]]]:
    """Buffers of whole documents: their keys, starts, text, the document of each span, and the spans."""

    def of(keys: list[int], parts: list[bytes]) -> tuple:
        text = b"".join(parts)
        ends = np.cumsum([len(p) for p in parts])
        found = spans_of(np.frombuffer(text, np.uint8), length, prefix, ends[:-1])
        return keys, [0, *ends[:-1].tolist()], text, np.searchsorted(ends, found[0], "right"), found

    keys, parts, size = [], [], 0
    for key, text in texts:
        if len(text) < length:
            continue
        if len(text) > BUFFER:  # a document of its own, in pieces of windows
            pieces = [spans_of(np.frombuffer(text, np.uint8, min(BUFFER + length - 1, len(text) - s), s), length, prefix) for s in range(0, len(text) - length + 1, BUFFER)]
            found = tuple(np.concatenate([p[k] + (s * BUFFER if k < 3 else np.uint64(0)) for s, p in enumerate(pieces)]) for k in range(4))
            yield [key], [0], text, np.zeros(len(found[0]), np.int64), found
            continue
        keys.append(key)
        parts.append(text)
        size += len(text)
        if size > BUFFER:
            yield of(keys, parts)
            keys, parts, size = [], [], 0
    if keys:
        yield of(keys, parts)


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, bytes]]:
    for rows in batches:
        yield from ((int(k), (t or "").encode()) for k, t in zip(rows["row"], rows["text"], strict=True))


def _ordinals(owner: np.ndarray) -> np.ndarray:
    """The number of each span in its document; owners ascend."""
    return np.arange(len(owner)) - np.searchsorted(owner, owner)


_ENTRY = np.dtype([("hash", "<u8"), ("row", "<i8"), ("nth", "<u4")])
#: An entry of a hash that its buffer has several times; its rows are known already.
_MANY = 0xFFFFFFFF


def select_spans(docs: DataFrame, length: int, prefix: int, parts: int) -> DataFrame:
    """(row, picked): the numbers, as packed uint32, of the spans whose prefix hash occurs again. docs: (row, text)."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for keys, _, _, owner, (_, _, _, hashes) in _documents(_texts(batches), length, prefix):
            rows = np.array(keys, np.int64)[owner]
            nth = _ordinals(owner)
            order = np.argsort(hashes, kind="stable")
            h = hashes[order]
            again = np.r_[False, h[1:] == h[:-1]]
            many = again | np.r_[again[1:], False]
            known = order[many]
            settled = _picked(rows[known], nth[known])
            yield settled.assign(part=settled["row"] % parts, settled=True)
            entries = np.zeros(int((~again).sum()), _ENTRY)
            entries["hash"], entries["row"], entries["nth"] = h[~again], rows[order][~again], np.where(many, _MANY, nth[order])[~again]
            part = (entries["hash"] >> np.uint64(20)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
            held = [(p, entries[order[a:b]].tobytes()) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
            yield pd.DataFrame({"row": 0, "picked": [x for _, x in held], "part": [p for p, _ in held], "settled": False})

    def counted(rows: pd.DataFrame) -> pd.DataFrame:
        settled = rows.loc[rows["settled"], ["row", "picked"]]
        entries = np.concatenate([np.zeros(0, _ENTRY), *[np.frombuffer(x, _ENTRY) for x in rows.loc[~rows["settled"], "picked"]]])
        entries = entries[np.argsort(entries["hash"], kind="stable")]
        again = np.r_[False, entries["hash"][1:] == entries["hash"][:-1]]
        own = entries[(again | np.r_[again[1:], False]) & (entries["nth"] != _MANY)]
        return pd.concat([settled, _picked(own["row"], own["nth"])], ignore_index=True)

    dealt = docs.mapInPandas(hashed, "row long, picked binary, part int, settled boolean")
    return dealt.groupBy("part").applyInPandas(counted, "row long, picked binary")


def _picked(rows: np.ndarray, nth: np.ndarray) -> pd.DataFrame:
    order = np.argsort(rows, kind="stable")
    rows, nth = rows[order], nth[order].astype("<u4")
    cuts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.zeros(0, np.int64)
    return pd.DataFrame({"row": rows[cuts], "picked": [x.tobytes() for x in np.split(nth, cuts[1:])] if len(cuts) else []})


def _selected(batches: Iterator[pd.DataFrame], length: int, prefix: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(row, first window, text from the minimizer to the span's end, text of the span before it) of each selected span."""
    picks: dict[int, np.ndarray] = {}

    def noted() -> Iterator[tuple[int, bytes]]:
        for rows in batches:
            for key, text, packed in zip(rows["row"], rows["text"], rows["picks"], strict=True):
                picks[int(key)] = np.frombuffer(b"".join(packed), "<u4")
                yield int(key), (text or "").encode()

    for keys, starts, text, owner, (first, last, at, _) in _documents(noted(), length, prefix):
        chosen = np.zeros(len(owner), bool)
        bounds = np.searchsorted(owner, np.arange(len(keys) + 1))
        for d, key in enumerate(keys):
            chosen[bounds[d] + picks[key]] = True
        for key in set(keys):  # only these: a long document comes before the short ones that wait in the buffer
            del picks[key]
        for s in np.flatnonzero(chosen).tolist():
            d, f, m = owner[s], int(first[s]), int(at[s])
            yield keys[d], f - starts[d], text[m : int(last[s]) + length], text[f:m]


def pack_run(items: list[tuple[bytes, int, bool, int, int]]) -> bytes:
    """A sorted run of (text, length of its part before the minimizer, repeated?, row, start), front-coded and compressed."""
    common, rests, last = [], [], b""
    for text, *_ in items:
        k = common_prefix(text, last, 0)
        common.append(k)
        rests.append(text[k:])
        last = text
    head = np.zeros(len(items), [("common", "<u2"), ("rest", "<u2"), ("left", "<u2"), ("many", "u1"), ("row", "<i8"), ("start", "<i8")])
    head["common"], head["rest"] = common, [len(r) for r in rests]
    for name, k in (("left", 1), ("many", 2), ("row", 3), ("start", 4)):
        head[name] = [x[k] for x in items]
    columns = b"".join(head[name].tobytes() for name in head.dtype.names)
    return struct.pack("<I", len(items)) + zstandard.ZstdCompressor(3).compress(columns + b"".join(rests))


def unpack_run(packed: bytes) -> Iterator[tuple[int, bytes, tuple[int, bool, int, int]]]:
    """(common prefix with the one before, text, the rest of the item) in order."""
    n = struct.unpack_from("<I", packed)[0]
    raw = zstandard.ZstdDecompressor().decompress(packed[4:])
    at, columns = 0, []
    for kind in ("<u2", "<u2", "<u2", "u1", "<i8", "<i8"):
        size = np.dtype(kind).itemsize * n
        columns.append(np.frombuffer(raw, kind, n, at).tolist())
        at += size
    text = b""
    for common, rest, left, many, row, start in zip(*columns, strict=True):
        text = text[:common] + raw[at : at + rest]
        at += rest
        yield common, text, (left, bool(many), row, start)


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    end = min(len(a), len(b))
    step = 16
    while known < end and a[known : known + step] == b[known : known + step]:
        known = min(end, known + step)
        step = min(2 * step, 256)
    while step > 1 and known < end:
        step //= 2
        if a[known : known + step] == b[known : known + step]:
            known = min(end, known + step)
    return known


def merge_runs(runs: list[Iterator[tuple[int, bytes, tuple]]]) -> Iterator[tuple[int, bytes, tuple]]:
    """(common prefix with the one before, text, item) of all runs in order, by a loser tree.

    Each candidate's common prefix with the last winner is known. Of two candidates the one with the longer such prefix is
    the smaller; only if both are equal are the texts compared, from there on, and the loser remembers how far they agree.
    """
    if not runs:
        return
    size = 1 << (len(runs) - 1).bit_length()
    heads: list[tuple[bytes, tuple] | None] = [None] * size
    agree = [0] * size
    losers = [-1] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's ``agree`` becomes its common prefix with the winner."""
        if heads[a] is None or heads[b] is None:
            return (b, a) if heads[a] is None else (a, b)
        if agree[a] != agree[b]:
            return (a, b) if agree[a] > agree[b] else (b, a)
        x, y = heads[a][0], heads[b][0]
        k = common_prefix(x, y, agree[a])
        if k == len(x) if k == len(x) or k == len(y) else x[k] < y[k]:
            agree[b] = k
            return a, b
        agree[a] = k
        return b, a

    def draw(k: int) -> None:
        got = next(runs[k], None) if k < len(runs) else None
        heads[k] = None if got is None else got[1:]
        agree[k] = 0 if got is None else got[0]

    def build(node: int) -> int:
        if node >= size:
            draw(node - size)
            return node - size
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if size > 1 else (draw(0) or 0)
    while heads[winner] is not None:
        yield agree[winner], *heads[winner]
        draw(winner)  # its front code is its common prefix with the last winner, which was its predecessor
        node = (winner + size) // 2
        while node:
            winner, losers[node] = play(losers[node], winner)
            node //= 2


def _shared_windows(spans: list[bytes], length: int) -> list[np.ndarray]:
    """For each of several different spans: which of its windows another one has too."""
    owner: dict[bytes, int] = {}
    shared: set[bytes] = set()
    for k, span in enumerate(spans):
        for i in range(len(span) - length + 1):
            window = span[i : i + length]
            if owner.setdefault(window, k) != k:
                shared.add(window)
    return [np.array([span[i : i + length] in shared for i in range(len(span) - length + 1)], bool) for span in spans]


class _Groups:
    """Collects a group of neighbours and turns it into intervals."""

    def __init__(self, length: int, local_spans: int = LOCAL_SPANS) -> None:
        self.local_spans = local_spans
        self.length, self.rows, self.bounds, self.windows = length, [], [], []
        self.spans: dict[bytes, list] = {}
        self.crowded = False

    def add(self, text: bytes, left: int, many: bool, row: int, start: int) -> None:
        span = text[len(text) - left :] + text[: len(text) - left] if left else text
        held = self.spans.get(span)
        if held is None:
            if len(self.spans) >= self.local_spans:
                self._send()
            self.spans[span] = [many, (row, start)]
            return
        if not held[0]:
            held[0] = True
            self._mark(*held[1], 0, len(span))
        if not many:
            self._mark(row, start, 0, len(span))

    def _mark(self, row: int, start: int, low: int, high: int) -> None:
        self.rows.append(row)
        self.bounds.append((start + low, start + high))

    def _send(self) -> None:
        """The windows of the spans held, as hashes; ``many`` ones count twice, and need no answer."""
        for span, (many, (row, start)) in self.spans.items():
            hashes = [hashlib.blake2b(span[i : i + self.length], digest_size=16).digest() for i in range(len(span) - self.length + 1)]
            self.windows.append((row, start, many, hashes))
        self.spans.clear()
        self.crowded = True

    def close(self) -> None:
        if self.crowded:
            self._send()
        elif len(self.spans) > 1:
            for (_, (many, (row, start))), hit in zip(self.spans.items(), _shared_windows(list(self.spans), self.length), strict=True):
                if not many and hit.any():
                    edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
                    for low, high in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                        self._mark(row, start, low, high - 1 + self.length)
        self.spans.clear()
        self.crowded = False

    def taken(self) -> pd.DataFrame:
        """(row, bounds, hashes, start, many): intervals as packed int64 pairs, or the windows of a crowded group's span."""
        rows = [(row, struct.pack("<2q", *pair), None, 0, False) for row, pair in zip(self.rows, self.bounds, strict=True)]
        rows += [(row, None, hashes, start, many) for row, start, many, hashes in self.windows]
        self.rows, self.bounds, self.windows = [], [], []
        return pd.DataFrame(rows, columns=["row", "bounds", "hashes", "start", "many"])


_FOUND = "row long, bounds binary, hashes array<binary>, start long, many boolean"


def repeated_intervals(docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX, parts: int | None = None, local_spans: int = LOCAL_SPANS) -> DataFrame:
    """(row, intervals): the repeated bytes of each row that has any, as packed int64 pairs (start, end) in any order."""
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(row_key(F.col("doc_id"), F.col("text"))["a"].alias("row"), "text")
    picked = select_spans(docs, length, prefix, parts).groupBy("row").agg(F.collect_list("picked").alias("picks"))
    picked = cut(picked)

    def sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        taken: dict[int, list[bytes]] = {}
        for row, _, right, _ in _selected(batches, length, prefix):
            taken.setdefault(row, []).append(right[:prefix])
        own = [x for found in taken.values() for x in found[:: max(1, len(found) // SAMPLE_EACH)][:SAMPLE_EACH]]
        yield pd.DataFrame({"bound": own})

    size = picked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.expr("aggregate(picks, 0L, (a, x) -> a + length(x) div 4)")).alias("spans")).first()
    ranges = max(parts, -(-(size["spans"] or 0) * SUFFIX_BYTES // RANGE_BYTES))
    # a share of the rows by their hashes, about as many as the number of ranges asks for; bounds are whole prefixes, so a
    # range is never asked to part suffixes that the merge must see together, and parts all others
    share = -(-max(SAMPLE_ROWS, SAMPLE_OF_RANGE * ranges) * GRAIN // max(1, size["n"]))
    some = lambda df: df.where(F.pmod(F.xxhash64("row", F.lit(11)), F.lit(GRAIN)) < min(share, GRAIN))
    seen = sorted(bytes(x.bound) for x in some(docs).join(some(picked), "row").select("row", "text", "picks").mapInPandas(sampled, "bound binary").collect())
    bounds = sorted({seen[k * len(seen) // ranges] for k in range(1, ranges)}) if seen else []

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[bytes, bytes], list] = {}
        size = 0

        def closed() -> pd.DataFrame:
            direct = [(row, struct.pack("<2q", start, start + len(k[0]) + len(k[1]))) for k, own in held.items() if len(own) > 1 for row, start in own]
            items = sorted(((k[0] + k[1], len(k[1]), len(own) > 1, *own[0]) for k, own in held.items()), key=lambda x: (x[0], x[1]))
            out, low = [(row % ranges, x, row, True) for row, x in direct], 0
            places = [bisect_right(bounds, x[0][:prefix]) for x in items]
            while low < len(items):
                high = bisect_right(places, places[low], low)
                out.append((places[low], pack_run(items[low:high]), 0, False))
                low = high
            held.clear()
            return pd.DataFrame(out, columns=["part", "run", "row", "settled"])

        for row, start, right, left in _selected(batches, length, prefix):
            held.setdefault((right, left), []).append((row, start))
            size += len(right) + len(left)
            if size > RUN_BYTES:
                yield closed()
                size = 0
        yield closed()

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        groups = _Groups(length, local_spans)
        settled = rows.loc[rows["settled"], ["row", "run"]].rename(columns={"run": "bounds"}).assign(hashes=None, start=0, many=False)
        for common, text, item in merge_runs([unpack_run(x) for x in rows.loc[~rows["settled"], "run"]]):
            if common < prefix:
                groups.close()
            groups.add(text, *item)
        groups.close()
        return pd.concat([settled, groups.taken()], ignore_index=True)[["row", "bounds", "hashes", "start", "many"]].astype({"many": bool})

    dealt = docs.join(picked, "row").select("row", "text", "picks").mapInPandas(runs, "part int, run binary, row long, settled boolean")
    found = cut(dealt.groupBy("part").applyInPandas(merged, _FOUND))
    windows = found.where("hashes IS NOT NULL").select("row", "start", "many", F.posexplode("hashes").alias("i", "h"))
    often = windows.groupBy("h").agg(F.sum(F.when(F.col("many"), 2).otherwise(1)).alias("n")).where("n > 1").select("h")
    late = windows.where("NOT many").join(often, "h").select("row", (F.col("start") + F.col("i")).alias("s"))
    late = late.groupBy("row").agg(F.sort_array(F.collect_set("s")).alias("windows"))
    packed = found.where("bounds IS NOT NULL").groupBy("row").agg(F.collect_list("bounds").alias("intervals"))
    return packed.join(late, "row", "full").select("row", F.coalesce("intervals", F.array().cast("array<binary>")).alias("intervals"), F.coalesce("windows", F.array().cast("array<long>")).alias("windows"))


def cut_out(text: str | None, intervals: list[bytes], windows: list[int], length: int) -> tuple[bytes, int, int]:
    """The remaining bytes, how many are gone, and from how many maximal runs."""
    raw = (text or "").encode()
    pairs = np.frombuffer(b"".join(intervals), "<i8").reshape(-1, 2)
    starts = np.asarray(windows, np.int64)
    change = np.zeros(len(raw) + 1, np.int64)
    np.add.at(change, np.r_[pairs[:, 0], starts], 1)
    np.add.at(change, np.r_[pairs[:, 1], starts + length], -1)
    gone = np.cumsum(change[:-1]) > 0
    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
    return kept, int(gone.sum()), int((np.diff(np.r_[0, gone.astype(np.int8)]) == 1).sum())


def with_repeats(docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX, **how: int) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``__intervals`` and ``__windows``, empty where nothing is repeated."""
    found = repeated_intervals(docs, length, prefix, **how)
    held = packed(docs).withColumn("row", row_key(F.col("doc.doc_id"), F.col("doc.text"))["a"]).join(found, "row", "left")
    new = {"__intervals": F.coalesce("intervals", F.array().cast("array<binary>")), "__windows": F.coalesce("windows", F.array().cast("array<long>"))}
    return held.select(*unpacked(docs.columns, list(new)), *[v.alias(k) for k, v in new.items()])


def digest_column(text: Column, intervals: Column, windows: Column, length: int = LENGTH) -> Column:
    """struct(n_bytes, n_removed, n_spans, kept_sha256)."""

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def digests(texts: pd.Series, pairs: pd.Series, starts: pd.Series) -> pd.DataFrame:
        rows = []
        for t, p, s in zip(texts, pairs, starts, strict=True):
            kept, gone, runs = cut_out(t, list(p), s, length)
            rows.append((len(kept) + gone, gone, runs, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"], index=texts.index)

    return digests(text, intervals, windows)


def kept_column(text: Column, intervals: Column, windows: Column, length: int = LENGTH) -> Column:
    """The remaining bytes as binary: a cut may go through a character."""

    @F.pandas_udf("binary")
    def kept(texts: pd.Series, pairs: pd.Series, starts: pd.Series) -> pd.Series:
        return pd.Series([cut_out(t, list(p), s, length)[0] for t, p, s in zip(texts, pairs, starts, strict=True)], index=texts.index, dtype=object)

    return kept(text, intervals, windows)
