"""Similarity join of documents on their word shingles, by partition-and-enumerate signatures.

Two sets whose Jaccard similarity is at least 0.8 differ in at most a quarter of the smaller one's size. The domain of
features is hashed into first-level partitions, about one for each two differences, and each of those into two halves.
Among enough partitions there is one with at most one difference, so one of its halves is equal in both sets: the
enumerated subsets (one half of two) are the signatures, and similar sets share one. How many partitions there are
goes by the band of sizes; a set near the upper edge of its band signs for the next band as well.

Two refinements keep the join exact and small. A signature of an empty half would join everything, so only halves
with features count: a partition is *solid* if both halves have some, and a set signs its partitions in order until
it has enough solid ones to outnumber its possible differences. Of two similar sets, the one that stops first has
an equal half among those, which the other signs too. A set that runs out of solid partitions signs all it has, and
again under another hash of the domain, until it has enough; two such sets meet under the first hash that suits one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import components
from .rows import map_texts, shuffle_partitions, slices
from .words import Texts, mix, windows

_U = np.uint64
SHINGLE = 5
PERCENT = 80
#: First-level partitions for each one needed, since some are not solid.
MARGIN = 1.15
#: Bins of the count vectors by which a pair's differences are bounded from below: (largest set, bins of a short
#: vector, bins of the long one). Sets with more features need more bins to be told apart.
BINS = ((1024, 64, 256), (4096, 256, 256), (None, 1024, 1024))
#: Signatures that a task gathers before it sends them on.
FLUSH = 1 << 18
#: Candidate pairs that a task gathers before it sends them on.
HELD = 1 << 19
#: As many new ones are gathered before they are held against what it has, or as many as it has.
FRESH = 1 << 14
#: Bits of a sketch for each feature, at least; up to twice as many.
SKETCH_BITS = 1.5
#: Bits of the shortest sketch, as a power of two: little beside the rest of its row.
SHORTEST = 9
#: A pair whose sketches differ by less than this share of what is allowed is taken for similar until its sets are read.
SURE_PERCENT = 75
#: Members of a signature that are compared at a time.
BLOCK = 2048
#: Rounds in which each class is compared with one partner, before all that is left is compared: each looks at one in so
#: many signatures. Similar sets share about half of theirs; the last round looks at all, so that little is left.
ROUNDS = (8, 8, 1)
#: Tasks that share the signatures with one smallest class, which may be many.
SPREAD = 8
#: Classes of a component that are compared with one another in one go, about.
TILE = 128
#: Features that are counted at a time when sets are compared.
WIDE = 4096


# ---- sets and signatures of a run of texts ----


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, end to end, and where each text's begin.

    A-Z are lower-cased. A text of fewer words has its whole sequence as its one shingle; one without words has none.
    """
    texts = Texts.of(column, lower=True)
    n = len(column)
    firsts = texts.words[2]
    counts = np.diff(firsts)
    at, keys = windows(texts.word_hashes, firsts, size)
    owner = np.repeat(np.arange(n), counts)[at]
    for k in range(1, size):  # texts of exactly k words
        short_at, short_keys = windows(texts.word_hashes, firsts, k)
        short_owner = np.repeat(np.arange(n), counts)[short_at]
        own = counts[short_owner] == k
        owner, keys = np.append(owner, short_owner[own]), np.append(keys, short_keys[own])
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])
    owner, keys = owner[first], keys[first]
    return keys, np.searchsorted(owner, np.arange(n + 1))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def classes(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """An id for each set: equal sets have equal ids."""
    a, b = _sums(mix(keys), bounds), _sums(mix(keys ^ _U(0x5851F42D4C957F2D)), bounds)
    return mix(a ^ mix(b + np.diff(bounds).astype(_U))).view(np.int64)


def _bins(size: np.ndarray, which: int) -> np.ndarray:
    out = np.full(len(size), BINS[-1][which])
    for row in BINS[-2::-1]:
        out[size <= row[0]] = row[which]
    return out


def count_vectors(keys: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """For each set how many features fall into each of its bins, 255 at most.

    Bins are runs of a hash's values, so neighbouring ones add up to those of a shorter vector. Two sets differ by
    the distance of their vectors at least, since sums and caps never move vectors further apart.
    """
    sizes = np.diff(bounds)
    bins = _bins(sizes, 2)
    begin = np.append(0, np.cumsum(bins))
    place = (mix(keys + _U(77)) >> _U(32)) * np.repeat(bins, sizes).astype(_U) >> _U(32)
    counts = np.bincount(np.repeat(begin[:-1], sizes) + place.astype(np.int64), minlength=int(begin[-1]))
    packed = np.minimum(counts, 255).astype(np.uint8).tobytes()
    return [packed[x:y] for x, y in zip(begin[:-1], begin[1:])]


def _level(vectors: list[bytes], bins: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of that many bins or more, shortened to them, and for each vector its row there (-1: none)."""
    lengths = np.fromiter(map(len, vectors), np.int64, len(vectors))
    row = np.cumsum(lengths >= bins) - 1
    out = np.zeros((int((lengths >= bins).sum()), bins), np.int16)
    for own in np.unique(lengths[lengths >= bins]):
        which = np.flatnonzero(lengths == own)
        raw = np.frombuffer(b"".join(vectors[i] for i in which), np.uint8).reshape(len(which), bins, -1)
        out[row[which]] = np.minimum(raw.sum(axis=2), 255)
    return out, np.where(lengths >= bins, row, -1)


def odd_sketches(keys: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """For each set a bit for each value of a hash: whether an odd number of its features have that value.

    Two sets' sketches differ in no more bits than the sets in features: what both have cancels out. A sketch of half
    the bits is its two halves, one laid over the other. There are so many bits that few differences hide.
    """
    sizes = np.diff(bounds)
    bits = 1 << np.maximum(SHORTEST, np.frexp(np.maximum(sizes, 1) * float(SKETCH_BITS) - 1)[1].astype(np.int64))
    begin = np.append(0, np.cumsum(bits))
    place = mix(keys + _U(177)) & np.repeat(bits - 1, sizes).astype(_U)
    counts = np.bincount(np.repeat(begin[:-1], sizes) + place.astype(np.int64), minlength=int(begin[-1]))
    packed = np.packbits((counts & 1).astype(bool), bitorder="little").tobytes()
    return [packed[x:y] for x, y in zip((begin[:-1] >> 3).tolist(), (begin[1:] >> 3).tolist())]


class Sketches:
    """Sketches of many sets, by length; each also laid over to half its length, since similar sets' lengths differ by a
    factor of two at most."""

    def __init__(self, sketches: list[bytes]) -> None:
        self.length = np.fromiter(map(len, sketches), np.int64, len(sketches))
        self.of: dict[int, np.ndarray] = {}
        self.row = np.zeros((2, len(sketches)), np.int64)  # of a sketch as it is, and of its half
        raw, halves = {}, {}
        for own in np.unique(self.length).tolist():
            which = np.flatnonzero(self.length == own)
            raw[own] = which, np.frombuffer(b"".join([sketches[i] for i in which]), _U).reshape(len(which), -1)
            if own > 8:
                halves[own // 2] = which, raw[own][1][:, : own // 16] ^ raw[own][1][:, own // 16 :]
        for own in {*raw, *halves}:
            rows, done = [], 0
            for side, part in enumerate((raw, halves)):
                if own in part:
                    which, words = part[own]
                    self.row[side, which] = done + np.arange(len(which))
                    rows.append(words)
                    done += len(which)
            self.of[own] = np.concatenate(rows)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """In how many bits the sketches a[i] and b[i] differ; their lengths differ by a factor of two at most."""
        low = np.minimum(self.length[a], self.length[b])
        out = np.zeros(len(a), np.int64)
        for own in np.unique(low).tolist():
            at = np.flatnonzero(low == own)
            x, y = a[at], b[at]
            words = self.of[own]
            differ = words[self.row[(self.length[x] > own).astype(int), x]] ^ words[self.row[(self.length[y] > own).astype(int), y]]
            out[at] = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
        return out


def differences(size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The most features by which a similar set can differ from one of that size."""
    return size * (100 - percent) // percent


def solid_needed(size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Of so many solid partitions one has a difference at most."""
    return (differences(size, percent) + 2) // 2


def signatures(keys: np.ndarray, bounds: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(number of the set, signature). Sets that can only be similar to their equals have none."""
    sizes = np.diff(bounds)
    band = np.frexp(sizes.astype(float))[1] - 1  # sizes from 2**band on, below 2**(band + 1)
    out_set, out_signature = [], []
    alone = differences(sizes, percent) == 0
    reaches = sizes * 100 // percent >= 2.0 ** (band + 1)
    for guest in (0, 1):
        left = np.flatnonzero(~alone & (reaches | (guest == 0)))
        seed = 0
        while len(left):
            own = np.concatenate([np.zeros(0, np.int64), *(np.arange(bounds[i], bounds[i + 1]) for i in left)])
            position = np.repeat(np.arange(len(left)), sizes[left])
            in_band = band[left] + guest
            upper = 2 ** (in_band + 1) - 1
            parts = (MARGIN * solid_needed(upper, percent)).astype(np.int64) + 1
            h = mix(keys[own] ^ mix(_U(seed * 64 + 1) + in_band[position].astype(_U)))
            part = ((h >> _U(33)) * parts[position].astype(_U) >> _U(31)).astype(np.int64)
            half = (h & _U(1)).astype(np.int64)
            where = (position * (int(parts.max()) + 1) + part) * 2 + half
            order = np.argsort(where, kind="stable")
            where, value = where[order], mix(h[order])
            begins = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
            digest = np.add.reduceat(value, begins)
            where = where[begins]
            # a partition is solid if both its halves are there; they stand next to each other
            pair = where >> 1
            second = np.append(False, pair[1:] == pair[:-1])
            of = pair // (int(parts.max()) + 1)
            # halves up to and including the partition with which a set has enough
            running = np.cumsum(second)
            first_of = np.searchsorted(of, np.arange(len(left)))
            before = np.append(0, running)[first_of]
            so_far = running - before[of]
            need = solid_needed(sizes[left], percent)
            done = so_far - second  # solid partitions of the set that end before this half
            keep = done < need[of]
            tag = mix(where.astype(_U) - (of * (int(parts.max()) + 1) * 2).astype(_U) + (_U(seed * 64) + in_band[of].astype(_U) << _U(32)))
            out_set.append(left[of[keep]])
            out_signature.append(mix(digest[keep] ^ tag[keep]))
            enough = np.append(running, 0)[np.append(first_of[1:], len(of)) - 1] - before >= need
            left, seed = left[~enough], seed + 1
    if not out_set:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    return np.concatenate(out_set), np.concatenate(out_signature)


# ---- the steps over the corpus ----


def _once(names: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Each of the texts once, by their hashes: the texts, where each first stands, and which one stands where."""
    _, first, back = np.unique(names.to_numpy(), return_index=True, return_inverse=True)
    return texts.take(pa.array(first)), first, back


def prints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, cls (equal for equal sets, null for empty ones), name (a hash of the text); and with the first
    of a run's equals, counts and sketch."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, _, back = _once(batch.column(1), batch.column(2))
        keys, bounds = shingle_sets(texts, size)
        n, cls = np.diff(bounds), classes(keys, bounds)
        vectors = {"counts": count_vectors(keys, bounds), "sketch": odd_sketches(keys, bounds)}
        _, first = np.unique(cls[back], return_index=True)
        shown = np.zeros(len(back), bool)
        shown[first] = True
        columns = [
            batch.column(0),
            pa.array(n[back], pa.int64()),
            pa.array(cls[back], pa.int64(), mask=n[back] == 0),
            batch.column(1),
            *[pa.array([v[k] if s and n[k] else None for k, s in zip(back, shown)], pa.binary()) for v in vectors.values()],
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "cls", "name", *vectors])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles long, cls long, name long, counts binary, sketch binary"
    return map_texts(docs, [docs["doc_id"], F.xxhash64(docs["text"]), docs["text"]], work, schema)


_MATCHES = pa.schema(
    [("bucket", pa.int32()), ("kind", pa.int32()), ("signature", pa.int64()), ("cls", pa.int64()), ("entries", pa.binary())]
)
MEMBER, ENTRIES = 0, 1


def _groups(signature: np.ndarray, cls: np.ndarray, buckets: int) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """Who shares a signature with another class, dealt by signature; and each signature once, with its smallest class."""
    order = np.lexsort((cls, signature))
    signature, cls = signature[order], cls[order]
    new = np.append(True, (signature[1:] != signature[:-1]) | (cls[1:] != cls[:-1]))[: len(signature)]
    signature, cls = signature[new], cls[new]
    opens = np.append(True, signature[1:] != signature[:-1])[: len(signature)]
    begins, group = np.flatnonzero(opens), np.cumsum(opens) - 1
    shared = np.bincount(group, minlength=len(begins))[group] > 1
    k = int(shared.sum())
    columns = [
        pa.array((mix(signature[shared]) % _U(buckets)).astype(np.int32)),
        pa.array(np.full(k, MEMBER, np.int32)),
        pa.array(signature[shared].view(np.int64)),
        pa.array(cls[shared]),
        pa.nulls(k, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_MATCHES), signature[begins], cls[begins]


def _sign(size: int, percent: int, buckets: int):
    """In tasks: signatures of the documents, grouped as far as the task sees them, the rest packed by bucket."""

    def flush(cls: list[np.ndarray], found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not cls:
            return
        members, signature, smallest = _groups(np.concatenate(found), np.concatenate(cls), buckets)
        yield members
        bucket = (signature >> _U(48)).astype(np.int64) * buckets >> 16
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        used = np.flatnonzero(np.diff(cuts))
        entries = []
        for k in used:
            own, ids = signature[cuts[k] : cuts[k + 1]], smallest[cuts[k] : cuts[k + 1]]
            names, place = np.unique(ids, return_inverse=True)
            place = place.astype("<u2" if len(names) <= 65536 else "<u4")
            head = np.array([len(own), len(names)], "<u4").tobytes()
            low, high = (own & _U(0xFFFFFFFF)).astype("<u4"), (own >> _U(32)).astype("<u4")
            # the signatures ascend, so their upper halves are steps of which most fit into two bytes
            step = np.diff(high, prepend=0)
            wide = np.flatnonzero(step >= 65535)
            step16 = np.minimum(step, 65535).astype("<u2")
            head += np.array([len(wide)], "<u4").tobytes()
            parts = (low, step16, step[wide].astype("<u4"), names.astype("<i8"), place)
            entries.append(b"".join([head, *(x.tobytes() for x in parts)]))
        n = len(used)
        nothing = pa.array(np.zeros(n, np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(np.full(n, ENTRIES, np.int32)), nothing, nothing, pa.array(entries, pa.binary())],
            schema=_MATCHES,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, found, held = [], [], 0
        for batch in batches:
            for part in slices(batch, 1):
                keys, bounds = shingle_sets(_once(part.column(0), part.column(1))[0], size)
                ids = classes(keys, bounds)
                _, first = np.unique(ids, return_index=True)  # equal sets sign alike: once will do
                chosen = np.zeros(len(ids), bool)
                chosen[first] = True
                mine, signature = signatures(keys, bounds, percent)
                once = chosen[mine]
                cls.append(ids[mine[once]])
                found.append(signature[once])
                held += int(once.sum())
                if held > FLUSH:
                    yield from flush(cls, found)
                    cls, found, held = [], [], 0
        yield from flush(cls, found)

    return run


def _unpack(entries: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, k, w = np.frombuffer(entries, "<u4", 3).astype(int)
    at = 12
    low = np.frombuffer(entries, "<u4", n, at)
    step = np.frombuffer(entries, "<u2", n, at := at + 4 * n).astype(np.int64)
    wide = np.frombuffer(entries, "<u4", w, at := at + 2 * n)
    step[step == 65535] = wide
    names = np.frombuffer(entries, "<i8", k, at := at + 4 * w)
    place = np.frombuffer(entries, "<u2" if k <= 65536 else "<u4", n, at + 8 * k)
    return np.cumsum(step).astype(_U) << _U(32) | low.astype(_U), names[place]


def _match(buckets: int):
    """In tasks, after the exchange: signatures that documents of different tasks share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            kinds = batch.column(1).to_numpy()
            yield batch.filter(pa.array(kinds != ENTRIES))
            packed = batch.filter(pa.array(kinds == ENTRIES))
            for bucket, entries in zip(packed.column(0).to_pylist(), packed.column(4).to_pylist()):
                held.setdefault(bucket, []).append(entries)
        while held:  # a task has several buckets, which share nothing; unpacked they take several times the room
            signature, cls = zip(*map(_unpack, held.popitem()[1]))
            yield _groups(np.concatenate(signature), np.concatenate(cls), buckets)[0]

    return run


def shared_signatures(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(signature, cls) for the classes that share a signature with another one; a row may come twice."""
    partitions = shuffle_partitions(docs.sparkSession)
    buckets = 4 * partitions
    schema = "bucket int, kind int, signature long, cls long, entries binary"
    signed = docs.select(F.xxhash64("text"), "text").mapInArrow(_sign(size, percent, buckets), schema)
    return signed.repartition(partitions, "bucket").mapInArrow(_match(buckets), schema).select("signature", "cls")


def _room(a: list[bytes], b: list[bytes], total: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs (a[i], b[i]) with these sums of sizes can be similar, by their long vectors."""
    can = np.ones(len(a), bool)
    for bins in sorted({row[2] for row in BINS}):
        (x, at_x), (y, at_y) = _level(a, bins), _level(b, bins)
        known = np.flatnonzero((at_x >= 0) & (at_y >= 0))
        apart = np.abs(x[at_x[known]] - y[at_y[known]]).sum(axis=1, dtype=np.int64)
        can[known] &= (100 + percent) * apart <= (100 - percent) * total[known]
    return can


def _sift(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            can = _room(batch.column("ca").to_pylist(), batch.column("cb").to_pylist(), total, percent)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(can))

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist())):
                x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                yes[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(yes))

    return run


def _sets(docs: DataFrame, vectors: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(cls, set) of the classes in ``ids``, written once. Only texts that stand for one of them are looked at."""
    names = vectors.join(ids.distinct(), "cls", "left_semi").select("name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                keys, bounds = shingle_sets(_once(part.column(0), part.column(1))[0], size)
                cls, first = np.unique(classes(keys, bounds), return_index=True)
                sets = [keys[bounds[i] : bounds[i + 1]].tobytes() for i in first]
                yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(sets, pa.binary())], ["cls", "set"])

    named = docs.select(F.xxhash64("text").alias("name"), "text").join(materialize(names, "names"), "name", "left_semi")
    found = named.mapInArrow(run, "cls long, set binary")
    return materialize(found.groupBy("cls").agg(F.first("set").alias("set")), "sets")


def _verify(docs: DataFrame, vectors: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of ``pairs`` of classes whose whole sets are similar.

    The long count vectors leave few others, so that sets are made, and moved, for little more than what links.
    """
    va = vectors.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("counts").alias("ca"))
    vb = vectors.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("counts").alias("cb"))
    sifted = pairs.distinct().join(va, "a").join(vb, "b").mapInArrow(_sift(percent), "a long, b long")
    sifted = materialize(sifted, "pairs")
    sets = _sets(docs, vectors, sifted.select(F.col("a").alias("cls")).union(sifted.select("b")), size)
    sa = sets.select(F.col("cls").alias("a"), F.col("set").alias("sa"))
    sb = sets.select(F.col("cls").alias("b"), F.col("set").alias("sb"))
    both = sifted.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb")
    return materialize(both.mapInArrow(_linked(percent), "a long, b long"), "links")


def _candidates(percent: int, best: bool):
    """In tasks, over the members of signatures in order of size: pairs from different components that may be similar.

    With ``best``, for each class one pair only, as (a, b, score, goal): of those that look similar the one with the
    smallest component, so that a group of similar classes gathers around one of them, else the likeliest. Otherwise
    all pairs, each once.
    """

    def pairs_of(rows: pa.RecordBatch) -> np.ndarray:
        cls, component, n, side = (rows.column(k).to_numpy() for k in ("cls", "component", "n", "side"))
        sketches = Sketches(rows.column("sketch").to_pylist())
        key = np.stack([rows.column(k).to_numpy().astype(np.int64) for k in ("signature", "i", "j")])
        opens = np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))
        ends = np.append(np.flatnonzero(opens)[1:], len(cls))[np.cumsum(opens) - 1]
        found = []
        left, step = np.arange(len(cls)), 0
        while len(left):  # each row with the next one of its block, then with the one after that, and so on
            step += 1
            left = left[left + step < ends[left]]
            other = left + step
            near = n[other] * percent <= n[left] * 100  # those further on are larger still
            left, other = left[near], other[near]
            # side 0: within a block; 1 and 2: the rows and columns of two blocks
            can = (component[left] != component[other]) & ((side[left] == 0) | (side[left] != side[other]))
            a, b = left[can], other[can]
            allowed = (100 - percent) * (n[a] + n[b])
            apart = (100 + percent) * sketches.apart(a, b)
            can = apart <= allowed
            a, b, apart, allowed = a[can], b[can], apart[can], allowed[can]
            sure = 100 * apart <= SURE_PERCENT * allowed
            score = np.where(sure, 0, 1 + apart * 1_000_000 // np.maximum(allowed, 1))
            goals = [np.where(sure, component[k], 0) for k in (b, a)]
            if best:
                found.append(np.stack([np.append(cls[a], cls[b]), np.append(cls[b], cls[a]), np.append(score, score), np.concatenate(goals)]))
            else:
                low, high = np.minimum(cls[a], cls[b]), np.maximum(cls[a], cls[b])
                found.append(np.stack([low, high, score, np.zeros_like(score)]))
        return np.concatenate([np.zeros((4, 0), np.int64), *found], axis=1)

    def reduced(found: list[np.ndarray]) -> np.ndarray:
        """Each class once with its best pair, or each pair once."""
        a, b, score, goal = both = np.concatenate([np.zeros((4, 0), np.int64), *found], axis=1)
        both = both[:, np.lexsort((b, goal, score, a) if best else (score, b, a))]
        first = np.append(True, both[0, 1:] != both[0, :-1])[: len(a)]
        if not best:
            first[1:] |= both[1, 1:] != both[1, :-1]
        return both[:, first]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row_batch(found: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["a", "b", "score", "goal"])

        rest: list[pa.RecordBatch] = []  # a block may go on in the next batch
        held = np.zeros((4, 0), np.int64)  # what several signatures of the task tell is told once
        fresh: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([*rest, batch]).combine_chunks().to_batches()[0]
            last = np.ones(rows.num_rows, bool)
            for k in ("signature", "i", "j"):
                last &= rows.column(k).to_numpy() == rows.column(k)[-1].as_py()
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if cut:
                fresh.append(pairs_of(rows.slice(0, cut)))
            rest = [rows.slice(cut)]
            if sum(x.shape[1] for x in fresh) > max(held.shape[1], FRESH):
                held, fresh = reduced([held, *fresh]), []
            if held.shape[1] > HELD:
                yield row_batch(held)
                held = held[:, :0]
        yield row_batch(reduced([held, *fresh, *map(pairs_of, rest)]))

    return run


def _blocks(members: DataFrame, sketches: DataFrame, component: DataFrame, turn: int | None) -> DataFrame:
    """Members of signatures that are not yet connected, cut into blocks. The sketches join last, since they are most
    of a row.

    With ``turn``, a block is compared within itself, and each turn deals the members anew. Without, all pairs from different
    components meet: of each signature, members outside its largest component (i below ``minor``) meet one another
    and those in it, which do not meet, so that few stragglers cost little however large the rest is.

    Similar classes share many signatures. Signatures with the same smallest class go to SPREAD tasks, each of which tells
    a pair once for all of its own.
    """
    named = members.join(component, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    parts = named.groupBy("signature", "component").agg(F.count(F.lit(1)).alias("_n"), F.min("cls").alias("_first"))
    split = parts.groupBy("signature").agg(
        F.min("_first").alias("first"), F.sum("_n").alias("_all"), F.max("_n").alias("_most"), F.max_by("component", "_n").alias("major"), F.count(F.lit(1)).alias("_parts")
    )

    def cuts(rows: Column) -> Column:
        return F.ceil(rows / BLOCK).cast("int")

    split = split.filter("_parts > 1").select(
        "signature", "first", "major", cuts(F.col("_all")).alias("blocks"), cuts(F.col("_all") - F.col("_most")).alias("minor"), cuts(F.col("_most")).alias("rest")
    )
    dealt = named.join(split, "signature")
    if turn is not None:
        own = F.pmod(F.xxhash64("cls", F.lit(turn)), F.col("blocks")).cast("int")
        dealt = dealt.select("first", "signature", "cls", "component", own.alias("i"), own.alias("j"), F.lit(0).alias("side"))
    else:
        of_rest = F.col("component") == F.col("major")
        own = F.pmod(F.xxhash64("cls"), F.when(of_rest, F.col("rest")).otherwise(F.col("minor"))).cast("int")
        own = F.when(of_rest, own + F.col("minor")).otherwise(own)
        others = F.sequence(F.lit(0), F.when(of_rest, F.col("minor")).otherwise(F.col("minor") + F.col("rest")) - 1)
        meets = F.transform(
            others,
            lambda j: F.struct(
                F.least(F.col("own"), j).alias("i"),
                F.greatest(F.col("own"), j).alias("j"),
                F.when(F.col("own") == j, 0).when(F.col("own") < j, 1).otherwise(2).alias("side"),
            ),
        )
        dealt = dealt.withColumn("own", own).withColumn("meets", F.explode(meets)).select("first", "signature", "cls", "component", "meets.*")
    placed = dealt.join(sketches, "cls").repartition("first", F.pmod(F.xxhash64("signature"), F.lit(SPREAD)), "i", "j")
    placed = placed.sortWithinPartitions("signature", "i", "j", "n")
    return placed.drop("first")


def _prepared(docs: DataFrame, known: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of the classes: (cls, n, counts, name), (cls, n, sketch) and (signature, cls)."""
    firsts = {"n": "n_shingles", "counts": "counts", "name": "name", "sketch": "sketch"}
    row = F.first(F.struct(*[F.col(c).alias(k) for k, c in firsts.items()]))
    of_class = materialize(known.filter("counts is not null").groupBy("cls").agg(row.alias("row")).select("cls", "row.*"), "vectors")
    members = materialize(shared_signatures(docs, size, percent).distinct(), "members")
    members = materialize(_distinct_groups(members), "groups")
    return of_class.drop("sketch"), of_class.select("cls", "n", "sketch"), members


def _distinct_groups(members: DataFrame) -> DataFrame:
    """Of signatures that the same classes share, one: two similar sets share dozens, which all say the same."""
    group = [F.sum(F.xxhash64(*seed, "cls").cast("decimal(38,0)")).alias(f"_of{k}") for k, seed in enumerate(((), (F.lit(1),)))]
    groups = members.groupBy("signature").agg(F.count(F.lit(1)).alias("_n"), *group)
    one = groups.groupBy("_n", "_of0", "_of1").agg(F.min("signature").alias("signature")).select("signature")
    return members.join(one, "signature", "left_semi")


def link_classes(docs: DataFrame, prepared: tuple[DataFrame, DataFrame, DataFrame], size: int, percent: int) -> DataFrame:
    """Links (a, b) between classes: enough of them that classes are connected if and only if similar pairs connect them.

    In each of a few rounds a class is compared with one partner from another component that shares a signature with it,
    of the signatures that the round looks at: what looks similar gathers around one class, so a large group of copies becomes
    connected by about a comparison for each copy and not for each pair. Then all pairs that share a signature and still lie in different components are
    compared. A pair is left out only if sketches show that it cannot be similar.
    """
    vectors, sketches, members = prepared
    found = "a long, b long, score long, goal long"
    component = docs.sparkSession.createDataFrame([], "cls long, component long")
    links: list[DataFrame] = []
    for turn, share in enumerate(ROUNDS):
        some = members.filter(F.pmod(F.xxhash64("signature"), F.lit(share)) == turn % share)
        best = _blocks(some, sketches, component, turn).mapInArrow(_candidates(percent, best=True), found)
        best = best.groupBy("a").agg(F.min(F.struct("score", "goal", "b"))["b"].alias("b"))
        pairs = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        links.append(_verify(docs, vectors, pairs, size, percent))
        component = components(_union(links)).select(F.col("id").alias("cls"), "component")
    left = _blocks(members, sketches, component, None).mapInArrow(_candidates(percent, best=False), found).select("a", "b")
    links.append(_verify(docs, vectors, left, size, percent))
    return _union(links)


def _similar(sets: list[bytes], percent: int) -> np.ndarray:
    """Which of the sets are similar to which: a matrix."""
    held = [np.frombuffer(x, _U) for x in sets]
    n = np.array([len(x) for x in held])
    _, feature, times = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
    owner, shared = np.repeat(np.arange(len(held)), n), times[feature] > 1
    place = (np.cumsum(times > 1) - 1)[feature[shared]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[shared][order], place[order]
    common = np.zeros((len(held), len(held)))
    for begin in range(0, int((times > 1).sum()), WIDE):
        part = slice(*np.searchsorted(place, (begin, begin + WIDE)))
        has = np.zeros((len(held), WIDE), np.float32)
        has[owner[part], place[part] - begin] = 1
        common += has @ has.T
    return 100 * common >= percent * (n[:, None] + n[None, :] - common)


def _met(percent: int):
    """In tasks, over the sets of tiles that meet: every similar pair of classes."""

    def pairs_of(rows: pa.RecordBatch) -> pa.RecordBatch:
        cls, side = rows.column("cls").to_numpy(), rows.column("side").to_numpy()
        # side 0: within a tile; 1 and 2: the rows and columns of two tiles
        yes = _similar(rows.column("set").to_pylist(), percent) & ((side[:, None] == 0) | (side[:, None] != side))
        x, y = np.nonzero(np.triu(yes, 1))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(cls[x], cls[y])), pa.array(np.maximum(cls[x], cls[y]))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []  # a meeting may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([*rest, batch]).combine_chunks().to_batches()[0]
            key = np.stack([rows.column(k).to_numpy().astype(np.int64) for k in ("component", "i", "j")])
            begins = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
            for x, y in zip(begins, begins[1:]):
                yield pairs_of(rows.slice(x, y - x))
            rest = [rows.slice(begins[-1])]
        for rows in rest:
            yield pairs_of(rows)

    return run


def all_links(docs: DataFrame, vectors: DataFrame, members: DataFrame, component: DataFrame, size: int, percent: int) -> DataFrame:
    """Every similar pair (a, b) of classes, once, where ``component`` (cls, component) tells what similar pairs connect.

    Similar classes lie in one component and share a signature. A component is cut into tiles by a hash of the class;
    tiles that share a signature meet, and the whole sets of both are compared there, so that a set is moved once
    for each meeting of its tile and not for each pair.
    """
    blocks = component.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("blocks"))
    tile = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    dealt = materialize(component.join(blocks, "component").select("cls", "component", "blocks", tile.alias("tile")), "tiles")
    seen = members.join(dealt.filter("blocks > 1"), "cls").select("component", "signature", "tile").distinct()
    seen = materialize(seen, "seen")
    across = seen.withColumnRenamed("tile", "i").join(seen.withColumnRenamed("tile", "j"), ["component", "signature"])
    across = across.filter("i <= j").select("component", "i", "j").distinct()
    alone = dealt.filter("blocks = 1").select("component", F.lit(0).alias("i"), F.lit(0).alias("j")).distinct()
    sides = F.when(
        F.col("i") == F.col("j"), F.array(F.struct(F.col("i").alias("tile"), F.lit(0).alias("side")))
    ).otherwise(
        F.array(F.struct(F.col("i").alias("tile"), F.lit(1).alias("side")), F.struct(F.col("j").alias("tile"), F.lit(2).alias("side")))
    )
    meets = across.union(alone).withColumn("own", F.explode(sides)).select("component", "i", "j", "own.*")
    sets = _sets(docs, vectors, dealt.select("cls"), size)
    met = meets.join(dealt.select("cls", "component", "tile"), ["component", "tile"]).drop("tile").join(sets, "cls")
    key = ["component", "i", "j"]
    met = met.repartition(*key).sortWithinPartitions(*key).select(*key, "side", "cls", "set")
    return materialize(met.mapInArrow(_met(percent), "a long, b long"), "all-links")


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.union(frame)
    return first


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, the smallest doc_id reachable by links.

    Documents link if 100 * common >= percent * all of their distinct shingles. ``docs`` needs ``doc_id`` and
    ``text``; other columns play no part. A null or empty text, or one without words, links with nothing; a repeated
    row is its own equal, so the result has it as often; a row without doc_id has a component if an equal or similar
    document has an id. An empty table gives an empty one. Texts of any length are taken whole.
    """
    known, _, of_class = _joined(docs, size, percent)
    return _with_component(known, of_class).drop("name")


def _joined(
    docs: DataFrame, size: int, percent: int
) -> tuple[DataFrame, tuple[DataFrame, DataFrame, DataFrame], DataFrame]:
    """The prints, what ``_prepared`` gives, and (cls, component) of the classes that are similar to others."""
    known = materialize(prints(docs, size), "prints")
    prepared = _prepared(docs, known, size, percent)
    links = link_classes(docs, prepared, size, percent)
    return known.drop("counts", "sketch"), prepared, components(links).withColumnRenamed("id", "cls")


def _with_component(known: DataFrame, of_class: DataFrame, *also: str) -> DataFrame:
    """doc_id, n_shingles, component_id, further columns of ``known``, and ``component`` where that is asked for."""
    firsts = known.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("first"))
    firsts = materialize(firsts, "firsts")
    named = firsts.join(of_class, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "component").select("cls", "component_id", *also)
    rest = [c for c in known.columns if c not in ("doc_id", "n_shingles", "cls")]
    return known.join(named, "cls", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), *rest, *also
    )


def counted_links(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``near_duplicates`` with ``n_links``: how many other rows of ``docs`` a row is equal or similar to.

    All similar pairs of classes are told (see ``all_links``), so the work grows with their number; equal rows
    are counted and not paired. Nulls, empty texts and repeated rows are as there: without words a row has no links.
    """
    known, (vectors, _, members), of_class = _joined(docs, size, percent)
    of_class = materialize(of_class, "components")
    pairs = all_links(docs, vectors, members, of_class, size, percent)
    rows = materialize(known.filter("cls is not null").groupBy("cls").agg(F.count(F.lit(1)).alias("_rows")), "rows")
    both = pairs.union(pairs.select("b", "a"))
    others = both.join(rows.withColumnRenamed("cls", "b"), "b").groupBy("a").agg(F.sum("_rows").alias("_others"))
    counted = rows.join(others.withColumnRenamed("a", "cls"), "cls", "left")
    counted = counted.select("cls", (F.col("_rows") - 1 + F.coalesce("_others", F.lit(0))).alias("n_links"))
    known = known.join(counted, "cls", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
    return _with_component(known, of_class).drop("name")


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Of each component one document, with all its columns: the one with the smallest doc_id, and of different texts
    under one doc_id that with the smallest hash. Texts of different components all stay, whatever their doc_id; a row
    that is there several times is kept once. Rows without doc_id cannot be told apart, and stay."""
    known, _, of_class = _joined(docs, size, percent)
    named = _with_component(known, of_class, "component").filter("component is not null AND doc_id is not null")
    chosen = named.groupBy("component").agg(F.min(F.struct("doc_id", "name")).alias("row")).select("row.*")
    wordless = known.filter("cls is null AND doc_id is not null").select("doc_id", "name")
    chosen = materialize(chosen.union(wordless).distinct().withColumnRenamed("name", "_name"), "kept")
    once = docs.withColumn("_name", F.xxhash64("text")).join(chosen, ["doc_id", "_name"], "left_semi")
    once = once.dropDuplicates(["doc_id", "_name"])
    return once.select(docs.columns).union(docs.filter("doc_id is null"))
