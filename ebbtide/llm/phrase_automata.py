"""Recurring passages: every stretch of ``WINDOW`` words whose sequence starts twice or more, found and taken out.

A window is filed under its *anchor*, the smallest hash among its runs of ``ANCHOR`` words. Equal windows have equal
anchors, and neighbouring windows mostly the same one, so a text falls into pieces of consecutive windows with one anchor.
Pieces are dealt to buckets by anchor; all occurrences of a window meet in one bucket, whatever texts they are in.

There, words are numbered exactly. Windows that two places hold are confirmed word by word and joined into passages; an
Aho-Corasick automaton over word numbers is compiled of the bucket's passages, and all pieces that documents sent there
stream through it, which locates every occurrence. So each bucket is one shard of the automata, and a document is
streamed through those shards that can know something of it, not through all.

An anchor that very many places share would fill its bucket. Such anchors are found first (see ``heavy_anchors``); their
windows are filed singly, under the window's own hash, so a bucket gets a heavy window's text once from each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .rows import map_texts, shuffle_partitions, slices
from .words import Texts, joined, mix, packed, windows

_U = np.uint64
WINDOW = 35
ANCHOR = 6
#: An anchor is heavy if it has more than one in so many of all pieces, so there are at most twice as many heavy ones ...
HEAVY = 100_000
#: ... and only if it has more pieces than this.
LIGHT = 1000
#: Pieces of an anchor that a task may keep to itself when heavy anchors are looked for.
UNTOLD = 8
#: Pieces that a task gathers before it sends them on.
FLUSH = 1 << 17
#: Windows that are compared word by word in one go.
COMPARED = 1 << 14
#: How hard pieces are compressed on their way: they are most of what the corpus shuffles.
LEVEL = 5


# ---- pieces of a run of texts ----


def anchored(texts: Texts, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: the first window's first word, the last window's, and the anchor."""
    hashes, firsts = texts.word_hashes, texts.words[2]
    left = np.repeat(firsts[1:], np.diff(firsts)) - np.arange(len(hashes))
    at = np.flatnonzero(left >= window)
    if not len(at):
        return at, at, at.astype(_U)
    width = min(ANCHOR, window)
    value = np.full(len(hashes), ~_U(0))
    begins, keys = windows(hashes, firsts, width)
    value[begins] = keys
    place, span, done = np.arange(len(hashes)), window - width + 1, 1
    while done < span:  # the smallest of ``done`` neighbours, of equal ones the leftmost
        shift = min(done, span - done)
        less = value[shift:] < value[:-shift]
        value[:-shift][less], place[:-shift][less] = value[shift:][less], place[shift:][less]
        done += shift
    anchor = place[at]
    new = np.append(True, (np.diff(at) != 1) | (np.diff(anchor) != 0))
    return at[new], at[np.append(new[1:], True)], value[at[new]]


def pieces(texts: Texts, raw: np.ndarray, starts: np.ndarray, heavy: np.ndarray, window: int):
    """(first word, one past the last, key) of each piece; ``raw`` and ``starts`` are the packed words."""
    first, last, key = anchored(texts, window)
    place = np.searchsorted(heavy, key)
    single = heavy[np.minimum(place, len(heavy) - 1)] == key if len(heavy) else np.zeros(len(key), bool)
    counts = (last - first + 1)[single]
    alone = np.repeat(first[single], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    flat = Texts(raw, np.array([0, len(raw)]))
    first, last = np.concatenate([first[~single], alone]), np.concatenate([last[~single], alone])
    own = flat.hashes(starts[alone], starts[alone + window]) if len(alone) else np.zeros(0, _U)
    return first, last + window, np.concatenate([key[~single], own])


def heavy_anchors(docs: DataFrame, window: int = WINDOW) -> np.ndarray:
    """The anchors that have too many pieces for one bucket, ascending; 2 * HEAVY at most.

    A task tells of an anchor if it has more than its part of that many, and more than UNTOLD; what it keeps to itself is
    too little to matter, so the sums of what is told find every anchor that has one in HEAVY of all pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held, total = np.zeros(0, _U), np.zeros(0, np.int64), [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            own = np.concatenate([keys, *held])
            weight = np.concatenate([counts, np.ones(len(own) - len(keys), np.int64)])
            names, at = np.unique(own, return_inverse=True)
            return names, np.bincount(at, weights=weight, minlength=len(names)).astype(np.int64)

        for batch in batches:
            for part in slices(batch, 0):
                held.append(anchored(Texts.of(part.column(0)), window)[2])
                total += len(held[-1])
                if sum(map(len, held)) > FLUSH:
                    (keys, counts), held = merged(), []
        keys, counts = merged()
        told = counts > max(UNTOLD, total // (2 * HEAVY))
        anchor, n = np.append(keys[told].view(np.int64), 0), np.append(counts[told], total)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n)) == len(n) - 1), pa.array(anchor), pa.array(n)], ["whole", "anchor", "n"])

    told = materialize(docs.select("text").mapInArrow(run, "whole boolean, anchor long, n long"), "anchors")
    total = told.filter("whole").agg(F.sum("n")).first()[0] or 0
    sums = told.filter("not whole").groupBy("anchor").agg(F.sum("n").alias("n"))
    rows = sums.filter(F.col("n") > max(LIGHT, total // (2 * HEAVY))).select("anchor").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(_U))


# ---- pieces on their way to the buckets ----


def _send(heavy: np.ndarray, window: int, buckets: int):
    """In tasks: the pieces of the documents, each distinct one once, packed by bucket with its places."""

    def cut(part: pa.RecordBatch) -> tuple[bytes, dict[str, np.ndarray]]:
        ids = np.stack([part.column(0).to_numpy(), part.column(1).to_numpy()])
        names, rows, times = np.unique(ids, axis=1, return_index=True, return_counts=True)  # equal texts go once
        texts = Texts.of(part.column(2).take(pa.array(rows)))
        raw, starts = packed(texts)
        first, last, key = pieces(texts, raw, starts, heavy, window)
        owner = np.searchsorted(texts.words[2], first, side="right") - 1
        flat = Texts(raw, np.array([0, len(raw)]))
        return raw.tobytes(), {
            "key": mix(key), "digest": flat.hashes(starts[first], starts[last]), "begin": starts[first], "end": starts[last],
            "k1": names[0][owner], "k2": names[1][owner], "first": first - texts.words[2][owner], "n": times[owner],
        }

    def flush(raws: list[bytes], found: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        shift = np.cumsum([0, *map(len, raws)])
        for by, part in zip(shift, found):
            part["begin"], part["end"] = part["begin"] + by, part["end"] + by
        raw, x = b"".join(raws), {k: np.concatenate([part[k] for part in found]) for k in found[0]}
        bucket = ((x["key"] >> _U(32)) % _U(buckets)).astype(np.int64)
        order = np.lexsort((x["digest"], x["key"], bucket))
        x, bucket = {k: v[order] for k, v in x.items()}, bucket[order]
        new = np.append(True, (np.diff(x["key"]) != 0) | (np.diff(x["digest"]) != 0))[: len(bucket)]
        own = np.flatnonzero(new)
        times = np.diff(np.append(own, len(bucket)))
        used, cuts = np.unique(bucket, return_index=True)
        entries = []
        pack = zstandard.ZstdCompressor(level=LEVEL)
        for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
            p, q = np.searchsorted(own, (a, b))
            at = own[p:q]
            begin, end = x["begin"][at], x["end"][at]
            head = [
                np.array([q - p, b - a], "<u4"), (x["key"][at] & _U(0xFFFFFFFF)).astype("<u4"), (end - begin).astype("<u4"),
                times[p:q].astype("<u4"), x["k1"][a:b].astype("<i8"), x["k2"][a:b].astype("<i4"),
                x["first"][a:b].astype("<u4"), x["n"][a:b].astype("<u4"),
            ]
            body = [raw[s:e] for s, e in zip(begin.tolist(), end.tolist())]
            entries.append(pack.compress(b"".join([*(h.tobytes() for h in head), *body])))
        return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(entries, pa.binary())], ["bucket", "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raws, found, held = [], [], 0
        for batch in batches:
            for part in slices(batch, 2):
                raw, own = cut(part)
                raws.append(raw)
                found.append(own)
                held += len(own["key"])
                if held > FLUSH:
                    yield flush(raws, found)
                    raws, found, held = [], [], 0
        if held:
            yield flush(raws, found)

    return run


def _unpack(entries: bytes) -> tuple[dict[str, np.ndarray], bytes]:
    data = zstandard.ZstdDecompressor().decompress(entries)
    p, o = np.frombuffer(data, "<u4", 2).astype(int)
    out, at = {}, 8
    for name, kind, count in (
        ("key", "<u4", p), ("length", "<u4", p), ("times", "<u4", p), ("k1", "<i8", o), ("k2", "<i4", o), ("first", "<u4", o), ("n", "<u4", o),
    ):
        out[name] = np.frombuffer(data, kind, count, at)
        at += out[name].nbytes
    return out, data[at:]


# ---- a bucket: confirm passages, compile their automaton, locate them ----


def confirmed(words: np.ndarray, firsts: np.ndarray, weight: np.ndarray, window: int) -> np.ndarray:
    """Where windows begin that stand at two places or more. Piece i has the words firsts[i]:firsts[i + 1] and stands for
    weight[i] places."""
    at, keys = windows(mix(words.astype(_U)), firsts, window)
    order = np.argsort(keys, kind="stable")
    at, keys = at[order], keys[order]
    alike = np.flatnonzero(keys[1:] == keys[:-1]) + 1
    for a in range(0, len(alike), COMPARED):  # equal hashes: the words decide
        part = alike[a : a + COMPARED]
        x, y = at[part][:, None] + np.arange(window), at[part - 1][:, None] + np.arange(window)
        alike[a : a + COMPARED] = np.where((words[x] == words[y]).all(axis=1), part, -1)
    opens = np.ones(len(at), bool)
    opens[alike[alike >= 0]] = False
    group = np.cumsum(opens) - 1
    places = np.bincount(group, weights=weight[np.searchsorted(firsts, at, side="right") - 1])
    return np.sort(at[places[group] >= 2]) if len(at) else at


def automaton(words: np.ndarray, passages: list[tuple[int, int]]) -> ahocorasick.Automaton:
    """The passages words[a:b], each under its length."""
    out = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for a, b in passages:
        out.add_word(tuple(words[a:b].tolist()), b - a)
    out.make_automaton()
    return out


def located(words: np.ndarray, firsts: np.ndarray, weight: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in a passage that stands at two places or more."""
    at = confirmed(words, firsts, weight, window)
    if not len(at):
        return np.zeros(len(words), bool)
    piece = np.searchsorted(firsts, at, side="right") - 1
    new = np.append(True, (np.diff(at) != 1) | (np.diff(piece) != 0))
    begins, ends = at[new], at[np.append(new[1:], True)] + window
    known = automaton(words, list(zip(begins.tolist(), ends.tolist())))
    hits, sizes = [], []
    for begin, end in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        for last, size in known.iter(tuple(words[begin:end].tolist())):
            hits.append(begin + last + 1)
            sizes.append(size)
    ends = np.array(hits, np.int64)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, ends - np.array(sizes, np.int64), 1)
    np.subtract.at(edge, ends, 1)
    return np.cumsum(edge[:-1]) > 0


_SPANS = pa.schema([("k1", pa.int64()), ("k2", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())])


def _shard(entries: list[bytes], window: int) -> pa.RecordBatch:
    """The places (text, first word, one past the last) of a bucket's recurring passages."""
    parts = [_unpack(e) for e in entries]
    x = {k: np.concatenate([p[k] for p, _ in parts]) for k in parts[0][0]}
    text = b"".join(body for _, body in parts)
    # each distinct piece once, with the number of its places
    edges = np.append(0, np.cumsum(x["length"].astype(np.int64)))
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(x["length"]), [None, pa.py_buffer(edges), pa.py_buffer(text)])
    named = whole.dictionary_encode()
    name = named.indices.to_numpy().astype(np.int64)
    of_place = np.repeat(name, x["times"])
    weight = np.bincount(of_place, weights=x["n"]).astype(np.int64)
    key = np.zeros(len(weight), np.uint32)
    key[name] = x["key"]
    _, group = np.unique(key, return_inverse=True)
    may = np.flatnonzero(np.bincount(group, weights=weight)[group] >= 2)
    nothing = pa.RecordBatch.from_arrays([pa.array([], f.type) for f in _SPANS], schema=_SPANS)
    if not len(may):
        return nothing
    chosen = named.dictionary.take(pa.array(may))
    raw = np.frombuffer(b"".join(chosen.to_pylist()), np.uint8)
    stops = np.flatnonzero(raw == 0x20) + 1  # every word ends with one space
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(stops), [None, pa.py_buffer(np.append(0, stops)), pa.py_buffer(raw)]
    ).dictionary_encode()
    lengths = np.diff(np.frombuffer(chosen.buffers()[1], np.int64)[chosen.offset : chosen.offset + len(chosen) + 1])
    firsts = np.searchsorted(stops, np.append(0, np.cumsum(lengths)), side="right")
    inside = located(words.indices.to_numpy().astype(np.int64), firsts, weight[may], window)
    piece = np.repeat(np.arange(len(may)), np.diff(firsts))
    edge = np.append(True, piece[1:] != piece[:-1])
    opens = np.flatnonzero(inside & (edge | ~np.append(False, inside[:-1])))
    closes = np.flatnonzero(inside & np.append(edge[1:] | ~inside[1:], True)) + 1
    # every place of a piece has the piece's spans
    row = np.full(len(weight), -1)
    row[may] = np.arange(len(may))
    spans_of = np.searchsorted(piece[opens], np.arange(len(may) + 1))
    place_row = row[of_place]
    some = np.flatnonzero(place_row >= 0)
    counts = np.diff(spans_of)[place_row[some]]
    place = np.repeat(some, counts)
    span = np.repeat(spans_of[place_row[some]], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    base = x["first"][place].astype(np.int64) - firsts[piece[opens[span]]]
    k1, k2, begin, end = x["k1"][place], x["k2"][place], base + opens[span], base + closes[span]
    order = np.lexsort((end, begin, k2, k1))
    k1, k2, begin, end = k1[order], k2[order], begin[order], end[order]
    new = np.append(True, (np.diff(k1) != 0) | (np.diff(k2) != 0) | (np.diff(begin) != 0) | (np.diff(end) != 0))[: len(order)]
    columns = [pa.array(v[new], f.type) for v, f in zip((k1, k2, begin, end), _SPANS)]
    return pa.RecordBatch.from_arrays(columns, schema=_SPANS)


def _locate(window: int):
    """In tasks, over rows in order of their buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for own, entries in zip(batch.column(0).to_pylist(), batch.column(1)):
                if own != bucket and held:
                    yield _shard(held, window)
                    held = []
                bucket = own
                held.append(entries.as_py())
        if held:
            yield _shard(held, window)

    return run


# ---- the corpus ----


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2 (what is found depends on the text alone, so a text's hash names it), text."""
    k2 = F.shiftright(F.xxhash64(F.lit("text"), docs["text"]), 32).cast("int")
    return docs.select("doc_id", F.xxhash64(docs["text"]).alias("k1"), k2.alias("k2"), "text")


def passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Spans (k1, k2, begin, end) of words in windows that recur; k1 and k2 are the hashes of the text, see ``_keyed``.

    Spans of one text may touch or overlap; a span is told once, however many rows have its text.
    """
    partitions = shuffle_partitions(docs.sparkSession)
    heavy = docs.sparkSession.sparkContext.broadcast(heavy_anchors(docs, window))
    buckets = 4 * partitions

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _send(heavy.value, window, buckets)(batches)

    sent = _keyed(docs).select("k1", "k2", "text").mapInArrow(send, "bucket int, entries binary")
    dealt = sent.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_locate(window), "k1 long, k2 int, begin int, end int")


def _taken_out(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = Texts.of(batch.column(2))
    firsts = texts.words[2]
    lists = batch.column(1)
    counts = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    counts = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, counts)
    flat = lists.flatten()
    base = np.repeat(firsts[:-1], counts)
    edge = np.zeros(int(firsts[-1]) + 1, np.int64)
    np.add.at(edge, base + flat.field(0).to_numpy(), 1)
    np.subtract.at(edge, base + flat.field(1).to_numpy(), 1)
    stays = np.cumsum(edge[:-1]) == 0
    kept = np.diff(np.append(0, np.cumsum(stays))[firsts])
    columns = [
        batch.column(0),
        pa.array(np.diff(firsts), pa.int64()),
        pa.array(np.diff(firsts) - kept, pa.int64()),
        joined(texts, stays),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_removed, and kept_text, the words left, joined by spaces.

    A word goes if a window of that many words that covers it starts anywhere else too, in the same text or another row;
    windows are judged on the input. ``docs`` needs ``doc_id`` and ``text``; other columns play no part. A null or empty text
    has no words. A text with fewer words than a window keeps all, also when it is there twice; a longer one that is
    there twice, under one doc_id or two, loses all of them both times. A null doc_id stays null; an empty
    table gives an empty one. Texts are looked at whole.
    """
    span = F.struct("begin", "end")
    spans = materialize(passages(docs, window), "spans").groupBy("k1", "k2").agg(F.collect_list(span).alias("spans"))
    rows = _keyed(docs).join(spans, ["k1", "k2"], "left").select("doc_id", "spans", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, ["doc_id", "spans", "text"], _taken_out, f"doc_id {kind}, n_words long, n_removed long, kept_text string")


def sql(window: int = WINDOW) -> str:
    """The rows of the query, by every window's text. Meant for small tables."""
    return rf"""
WITH base AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT rid, i, hash(list_slice(ws, i, i + {window - 1})) AS short, sha256(array_to_string(list_slice(ws, i, i + {window - 1}), ' ')) AS whole
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - {window - 2})) AS i FROM base)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY short, whole) AS n FROM starts) WHERE n > 1),
gone AS (SELECT DISTINCT rid, i + k AS i FROM (SELECT rid, i, unnest(range({window})) AS k FROM again)),
words AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM base),
kept AS (SELECT rid, string_agg(w, ' ' ORDER BY i) AS text, count(*) AS n FROM words ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM base LEFT JOIN kept USING (rid)
"""
