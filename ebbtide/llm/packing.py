"""Best-fit packing of tokenised documents into sequences of bounded length, by a linear grouping scheme.

Lengths are whole numbers up to the capacity, so the histogram of lengths is a table of at most ``capacity`` rows
however large the corpus is, and the whole packing can be planned on it in counts: runs of equal sequences instead of
sequences. Spark then numbers the pieces of each length and looks up where the run puts piece number so-and-so.
"""

from __future__ import annotations

import functools
import re
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import map_texts, number_rows

#: Sizes to which large lengths are rounded, and the share of the capacity above which a length is large.
GROUPS = 96
LARGE = 1 / 8
#: The configurations are optimised to within this share of the linear program's bound.
GAP = 0.001


# ---- the plan, on the histogram of lengths ----


def grouped(counts: dict[int, int], groups: int) -> list[tuple[int, list[list[int]]]]:
    """Groups of equal cardinality of the lengths in descending order: (largest length, [[length, count], ...])."""
    total, out, seen = sum(counts.values()), [], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if len(out) < 1 + seen * groups // total:
                out.append((length, []))
            ends = -(-len(out) * total // groups)
            take = min(left, max(1, ends - seen))
            out[-1][1].append([length, take])
            seen, left = seen + take, left - take
    return out


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within the capacity that is worth most (an unbounded knapsack)."""
    worth, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    useful = np.flatnonzero(values > 1e-12)
    sizes_used, values_used = sizes[useful], values[useful]
    for room in range(1, capacity + 1):
        worth[room] = worth[room - 1]
        fits = np.searchsorted(sizes_used, room, side="right")
        if fits:
            found = worth[room - sizes_used[:fits]] + values_used[:fits]
            k = int(found.argmax())
            if found[k] > worth[room]:
                worth[room], last[room] = found[k], useful[k]
    out, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            out[last[room]] += 1
            room -= sizes[last[room]]
    return float(worth[capacity]), out


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations of few sizes, and how often to use each, that cover ``demand`` with few sequences.

    The linear program of the cutting stock problem, by column generation. ``sizes`` ascend and differ.
    """
    n = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse, use = np.diag(1 / np.diag(basis)), demand / np.diag(basis)
    bound = 0.0
    for step in range(40 * n):
        prices = inverse.sum(axis=0)
        worth, column = best_configuration(sizes, prices, capacity)
        bound = max(bound, float(prices @ demand) / max(worth, 1.0))
        if worth <= 1 + 1e-9 or use.sum() <= bound * (1 + GAP):
            break
        direction = inverse @ column
        positive = direction > 1e-9
        if not positive.any():
            break
        ratios = np.full(n, np.inf)
        ratios[positive] = use[positive] / direction[positive]
        leaves = int(ratios.argmin())
        use = np.maximum(use - ratios[leaves] * direction, 0)
        use[leaves] = ratios[leaves]
        pivot = inverse[leaves] / direction[leaves]
        inverse -= np.outer(direction, pivot)
        inverse[leaves] = pivot
        basis[:, leaves] = column
        if step % 200 == 199:
            inverse = np.linalg.inv(basis)
            use = np.maximum(inverse @ demand, 0)
    return [(basis[:, j].astype(int), float(use[j])) for j in range(n)]


class Runs:
    """Runs of equal sequences: how many, what they hold as (length, times), and the room left."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.runs: list[list] = []  # [count, [(length, times), ...], room]
        self.by_room: dict[int, list[int]] = defaultdict(list)
        self.rooms: list[int] = []

    def add(self, count: int, held: list[tuple[int, int]], room: int) -> None:
        if count:
            self.runs.append([count, held, room])
            if not self.by_room[room]:
                self.rooms.insert(bisect_left(self.rooms, room), room)
            self.by_room[room].append(len(self.runs) - 1)

    def _take(self, room: int) -> list:
        of = self.by_room[room]
        run = self.runs[of.pop()]
        if not of:
            self.rooms.pop(bisect_left(self.rooms, room))
        taken = list(run)
        run[0] = 0
        return taken

    def best_fit(self, length: int, count: int) -> None:
        """Each of ``count`` pieces goes to the fullest sequence that can take it; new ones are opened at need."""
        while count:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                self.add(-(-count // (self.capacity // length)), [], self.capacity)
                continue
            sequences, held, room = self._take(self.rooms[at])
            times = min(room // length, count)
            used = min(sequences, count // times)
            self.add(used, [*held, (length, times)], room - times * length)
            self.add(sequences - used, held, room)
            count -= used * times


def plan(counts: dict[int, int], capacity: int, groups: int = GROUPS) -> list[tuple[int, list[tuple[int, int]]]]:
    """Runs of equal sequences, (how many, [(length, times), ...]), that hold ``counts`` pieces of each length.

    1. Large lengths are sorted, cut into groups of equal cardinality and rounded up to the largest of the group.
    2. Configurations of the few rounded sizes are optimised, and used a whole number of times.
    3. Actual lengths take the places of the rounded ones.
    4. What is left, and then the small lengths, go by best fit into the room that is left.
    """
    runs = Runs(capacity)
    runs.add(counts.get(capacity, 0), [(capacity, 1)], 0)
    large = {n: c for n, c in counts.items() if LARGE * capacity < n < capacity and c}
    if large:
        by_size: dict[int, list[list[int]]] = {}
        for size, members in grouped(large, groups):
            by_size.setdefault(size, []).extend(members)
        sizes = np.array(sorted(by_size))
        queues = [by_size[s] for s in sizes]
        demand = np.array([sum(c for _, c in q) for q in queues], float)
        left = demand.astype(int)
        chosen = sorted(configurations(sizes, demand, capacity), key=lambda x: -x[1])
        for configuration, use in chosen:
            need = configuration > 0
            if not need.any():
                continue
            times = int(min(use + 1e-6, (left[need] // configuration[need]).min()))
            left -= times * configuration
            slots = [k for k in np.flatnonzero(need) for _ in range(configuration[k])]
            while times > 0:
                # a queue that several slots draw on gives each of them its next stretch of equal lengths
                heads = [(k, slots.count(k), queues[k][0]) for k in dict.fromkeys(slots)]
                step = min(times, *(head[1] // many for _, many, head in heads))
                if step:
                    held = [(head[0], many) for _, many, head in heads]
                    for _, many, head in heads:
                        head[1] -= step * many
                else:  # a stretch ends within one sequence
                    step, taken = 1, []
                    for k in slots:
                        taken.append((queues[k][0][0], 1))
                        queues[k][0][1] -= 1
                        while queues[k] and not queues[k][0][1]:
                            queues[k].pop(0)
                    held = taken
                for k in dict.fromkeys(slots):
                    while queues[k] and not queues[k][0][1]:
                        queues[k].pop(0)
                runs.add(step, held, capacity - sum(n * t for n, t in held))
                times -= step
        rest: dict[int, int] = defaultdict(int)
        for queue in queues:
            for length, count in queue:
                rest[length] += count
        for length in sorted(rest, reverse=True):
            runs.best_fit(length, rest[length])
    for length in sorted((n for n in counts if n <= LARGE * capacity), reverse=True):
        runs.best_fit(length, counts[length])
    return [(count, held) for count, held, _ in runs.runs if count and held]


def places(runs: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """For each length, what piece number ``low`` to ``high`` of it gets: (low, high, sequence, offset, times).

    Piece number k goes to ``sequence + (k - low) // times``, at ``offset + (k - low) % times * length``.
    """
    out: dict[int, list] = defaultdict(list)
    given: dict[int, int] = defaultdict(int)
    sequence = 0
    for count, held in runs:
        offset = 0
        for length, times in held:
            low = given[length]
            given[length] = low + count * times
            out[length].append((low, given[length], sequence, offset, times))
            offset += length * times
        sequence += count
    return out


# ---- tokens, in tasks ----

LONG_RUN = 50_000


def byte_signs(alphabet: list[str]) -> list[str]:
    """The sign of each byte in a byte-level vocabulary: itself if it is in the alphabet, else the next from 256 on."""
    own, spare = set(alphabet), iter(range(256, 512))
    return [chr(b) if chr(b) in own else chr(next(spare)) for b in range(256)]


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str, added: bool = False) -> Callable[[str], list[int]]:
    """The ids of a text by the byte-level vocabulary in a ``tokenizers`` file, without adding special tokens.

    That library takes four times as long. Its vocabulary is in merge order, so its ids are ranks, and ``tiktoken``
    gives the same ids by them (the tests compare the two). With ``added``, the file's added tokens in a text are
    found first and have their own ids, as that library does it; else their strings are ordinary text. A text with a run
    of more than LONG_RUN separators is encoded by that library: over several hundred thousand, ``tiktoken``'s pattern
    goes back too far and fails.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    special = {token.content: i for i, token in tokenizer.get_added_tokens_decoder().items()}
    byte_of = {sign: byte for byte, sign in enumerate(byte_signs(pre_tokenizers.ByteLevel.alphabet()))}
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in vocabulary.items() if t not in special}
    encoding = tiktoken.Encoding(
        "byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special if added else {}
    )
    fast = functools.partial(encoding.encode, allowed_special="all") if added else encoding.encode_ordinary
    tokenizer.encode_special_tokens = not added

    def encode(text: str) -> list[int]:
        if len(text) > LONG_RUN and max(map(len, re.findall(r"\s+", text)), default=0) > LONG_RUN:
            return tokenizer.encode(text, add_special_tokens=False).ids
        return fast(text)

    return encode


def token_pieces(
    docs: DataFrame, path: str, capacity: int, end_id: int, keep_ids: bool = False, added: bool = False
) -> DataFrame:
    """One row for each piece of each document: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A document's ids are those of its text (null: empty) and then ``end_id``. One of more than ``capacity`` ids is cut
    into pieces of ``capacity``, of which the first is the shorter one.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[], [], [], [], [], []]
        encode = byte_bpe(path, added)
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = np.array([*encode(text or ""), end_id], "<u4").tobytes()
            n, start, piece = len(ids) // 4, 0, 0
            length = (n - 1) % capacity + 1
            while start < n:
                own = ids[4 * start : 4 * (start + length)]
                for to, value in zip(out, (doc_id, piece, start, length, zlib.crc32(own), own)):
                    to.append(value)
                start, piece, length = start + length, piece + 1, capacity
        types = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        columns = [pa.array(x, t) for x, t in zip(out, types)]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        return pa.RecordBatch.from_arrays(columns[: 5 + keep_ids], names[: 5 + keep_ids])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return map_texts(docs, [docs["doc_id"], docs["text"]], work, schema)


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = 1024,
    end_id: int = 2,
    groups: int = GROUPS,
    keep_ids: bool = False,
    added: bool = False,
) -> DataFrame:
    """The pieces of ``docs`` with ``sequence_id`` and ``offset``: which sequence holds a piece, from which place on.

    ``docs`` needs ``doc_id`` and ``text``; other columns, whatever their names, play no part. A null or empty text is
    one piece that holds ``end_id`` alone. A repeated row is packed as often as it occurs; a null ``doc_id`` stays
    null. An empty table gives an empty one. Texts of any length are tokenised whole, one in memory at a time.
    With ``keep_ids``, ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers. With ``added``, added
    tokens of the tokenizer's file that stand in a text have their own ids, as its library gives them.
    """
    spark = docs.sparkSession
    pieces = number_rows(
        token_pieces(docs, path, capacity, end_id, keep_ids, added), ["length"], ["doc_id", "piece"], "_number", "pieces"
    )
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = places(plan(histogram, capacity, groups))
    runs = spark.createDataFrame(
        [(length, [tuple(r) for r in rows]) for length, rows in found.items()],
        "_length long, _runs array<struct<low: long, high: long, sequence: long, offset: long, times: long>>",
    )
    # at most ``capacity`` rows, of a few runs each: their number follows from the capacity and not from the corpus
    own = F.filter("_runs", lambda r: (r["low"] <= F.col("_number")) & (F.col("_number") < r["high"]))[0]
    at = F.col("_number") - F.col("_run.low")
    return (
        pieces.join(F.broadcast(runs), pieces["length"] == runs["_length"])
        .withColumn("_run", own)
        .withColumn("sequence_id", F.col("_run.sequence") + F.floor(at / F.col("_run.times")))
        .withColumn("offset", F.col("_run.offset") + at % F.col("_run.times") * F.col("length"))
        .drop("_length", "_runs", "_run", "_number")
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from ``pack(..., keep_ids=True)``: sequence_id, n_ids, ids, doc_ids in order."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(ordered.alias("_held")).select(
        "sequence_id",
        F.aggregate("_held", F.lit(0), lambda n, x: n + (F.octet_length(x["ids"]) / 4).cast("int")).alias("n_ids"),
        F.aggregate("_held", F.lit(b""), lambda ids, x: F.concat(ids, x["ids"])).alias("ids"),
        F.transform("_held", lambda x: x["doc_id"]).alias("doc_ids"),
    )
