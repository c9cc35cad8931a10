"""URL filter: rules by host and path, and for the rest two character language models.

URLs that a rule accepts or rejects train a smoothed variable-order Markov model each. A URL without a rule is judged by
the difference of its log-likelihoods, by character, against a threshold that is calibrated on the same URLs: the
model that scores one half of them has been counted on the other half.

The n-grams are counted themselves, in stored tables that grow with what the URLs hold; every URL counts. A character's
probability follows from the few bytes before it, its window: so each distinct window is scored once, order by order,
by joins that meet a row at most 256 times, and a URL's score is the sum over its windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .rows import slices

# The rules: fixed values.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
ORDERS = 5
#: What a context's count is held against when orders are interpolated.
STRENGTH = 4.0
#: Windows that a task gathers before it sends their sums on.
HELD = 1 << 20
#: A score's histogram has so many bins, over differences from -SPAN to SPAN a character.
BINS, SPAN = 4000, 20.0


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rules() -> list[Rule]:
    return [Rule(*r) for r in RULES]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, with A-Z lower-cased, and the path; both empty without a ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"\A([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def rule_of(host: Column, path: Column, of: list[Rule]) -> Column:
    """The longest rule that fits, as (name, verdict); null if none does. Of equally long ones, that of the longer host."""
    out = F.lit(None).cast("struct<name: string, verdict: string>")
    for rule in sorted(of, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


# ---- the models ----


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each URL's bytes after an opening and before a closing sign, end to end, and where each begins."""
    texts = [b"\x02" + t.encode() + b"\x03" for t in pc.fill_null(column, "").to_pylist()]
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _windows(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the URL, window) of all characters but the opening signs.

    A window is the character, the ORDERS - 1 bytes before it (not past the opening sign) and, above those, how many
    bytes there are before it: as a number that no other window has.
    """
    url = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place = np.arange(len(data)) - bounds[url]
    key = np.zeros(len(data), np.int64)
    for back in range(ORDERS):
        byte = np.concatenate([np.zeros(back, np.uint8), data[: len(data) - back]])[: len(data)].astype(np.int64)
        key |= np.where(place >= back, byte << (8 * back), 0)
    key |= np.minimum(place, ORDERS - 1) << (8 * ORDERS)
    return url[place > 0], key[place > 0]


def _each(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row of keys once, with its sum."""
    order = np.lexsort(keys.T[::-1])
    keys, n = keys[order], n[order]
    begins = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))[: len(keys)])
    return keys[begins], np.add.reduceat(n, begins) if len(begins) else n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In tasks: (part, key, n), the sums over the task's URLs."""

    def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys[:, 0].astype(np.int32)), pa.array(keys[:, 1]), pa.array(n)], ["part", "key", "n"])

    held, sums = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
    for batch in batches:
        for part in slices(batch, 1):
            if not part.num_rows:
                continue
            url, key = _windows(*_bytes(part.column(1)))
            own = np.stack([part.column(0).to_numpy().astype(np.int64)[url], key], axis=1)
            held, sums = _each(np.concatenate([held, own]), np.concatenate([sums, np.ones(len(own), np.int64)]))
            if len(held) > HELD:
                yield rows(held, sums)
                held, sums = held[:0], sums[:0]
    yield rows(held, sums)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In tasks: (row, key, n), each window of a URL once."""
    for batch in batches:
        for part in slices(batch, 1):
            if not part.num_rows:
                continue
            url, key = _windows(*_bytes(part.column(1)))
            each, n = _each(np.stack([part.column(0).to_numpy()[url], key], axis=1), np.ones(len(key), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(each[:, 0]), pa.array(each[:, 1]), pa.array(n)], ["row", "key", "n"])


def grams(urls: DataFrame) -> list[DataFrame]:
    """For each order (key, n_0 to n_3): how often URLs given as (part = 2 * half + rejected, url) hold an n-gram.

    The keys are windows shortened to the order. URLs of part -1 are not counted, but their n-grams are there.
    """
    of = [F.coalesce(F.sum(F.when(F.col("part") == p, F.col("n"))), F.lit(0)).cast("long").alias(f"n_{p}") for p in range(4)]
    found = urls.mapInArrow(_counted, "part int, key long, n long")
    out = [materialize(found.groupBy("key").agg(*of), "grams")]
    for order in range(ORDERS - 2, -1, -1):
        shorter = out[0].select(shortened(F.col("key"), order).alias("key"), *[f"n_{p}" for p in range(4)])
        out.insert(0, materialize(shorter.groupBy("key").agg(*[F.sum(f"n_{p}").alias(f"n_{p}") for p in range(4)]), "grams"))
    return out


def shortened(key: Column, order: int) -> Column:
    """The window with at most ``order`` bytes before its character."""
    before = F.least(F.shiftright(key, 8 * ORDERS), F.lit(order).cast("long"))
    return key.bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1)).bitwiseOR(F.shiftleft(before, 8 * ORDERS))


def counts(urls: DataFrame) -> np.ndarray:
    """Counts [half, rejected, context or n-gram, order, number of it], gathered: for few URLs, as in checks."""
    tables = []
    for order in grams(urls):
        n = np.array([r[1:] for r in order.collect()], float).reshape(-1, 4)
        context = np.array([r[1:] for r in _contexts(order).collect()], float).reshape(-1, 4)
        tables.append((context, n))
    out = np.zeros((4, 2, ORDERS, max((len(n) for _, n in tables), default=0)))
    for order, both in enumerate(tables):
        for kind, n in enumerate(both):
            out[:, kind, order, : len(n)] = n.T
    return out.reshape(2, 2, 2, ORDERS, -1)


def _context(key: Column) -> Column:
    return F.shiftright(key, 8)


def _contexts(order: DataFrame) -> DataFrame:
    """(context, c_0 to c_3): how often each context of the order stands before a character."""
    return order.groupBy(_context(F.col("key")).alias("context")).agg(*[F.sum(f"n_{p}").alias(f"c_{p}") for p in range(4)])


def window_scores(tables: list[DataFrame]) -> DataFrame:
    """(key, by_0, by_1, by_both): log-likelihood as accepted less that as rejected, by the counts of a half or of both.

    Log-probabilities by interpolation from the lowest order up, in the manner of Witten and Bell: the weight of an
    order grows with how often its context has been seen.
    """
    models = {f"{half}_{kind}": parts for kind in (0, 1) for half, parts in (("0", [kind]), ("1", [2 + kind]), ("both", [kind, 2 + kind]))}
    lower = None
    for k, order in enumerate(tables):
        out = order.withColumn("context", _context(F.col("key"))).join(_contexts(order), "context")
        if lower is not None:
            last = lower.select(F.col("key").alias("_shorter"), *[F.col(f"p_{m}").alias(f"q_{m}") for m in models])
            out = out.join(last, shortened(F.col("key"), k - 1) == F.col("_shorter"))
        chances = []
        for m, parts in models.items():
            both, seen = (sum((F.col(f"{x}_{p}") for p in parts[1:]), F.col(f"{x}_{parts[0]}")) for x in "nc")
            less = F.col(f"q_{m}") if lower is not None else F.lit(1 / 256)
            chances.append(((both + F.lit(STRENGTH) * less) / (seen + F.lit(STRENGTH))).alias(f"p_{m}"))
        lower = materialize(out.select("key", *chances), "chances")
    return lower.select("key", *[F.log(F.col(f"p_{h}_0") / F.col(f"p_{h}_1")).alias(f"by_{h}") for h in ("0", "1", "both")])


def scores(urls: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """Of (row, url): row, by_0, by_1, by_both, each over the URL's number of characters."""
    spread = urls.select("row", "url").mapInArrow(_spread, "row long, key long, n long")
    scored = spread.join(materialize(window_scores(tables), "scores"), "key")
    return scored.groupBy("row").agg(*[(F.sum(F.col("n") * F.col(c)) / F.sum("n")).alias(c) for c in ("by_0", "by_1", "by_both")])


def calibrate(known: DataFrame) -> float:
    """Of (part, by_0, by_1): the difference that parts accepted from rejected URLs best: each kind counts for a half.

    Half the URLs are scored by the models of the other half. Only a histogram of scores is gathered.
    """
    score = F.when(F.col("part") >= 2, F.col("by_0")).otherwise(F.col("by_1"))
    bin_ = F.least(F.greatest(F.floor((score + SPAN) * BINS / (2 * SPAN)), F.lit(0)), F.lit(BINS - 1)).cast("int")
    rows = known.select((F.col("part") % 2).alias("kind"), bin_.alias("bin")).groupBy("kind", "bin").agg(F.count(F.lit(1)).alias("n")).toArrow()
    found = np.zeros((2, BINS))
    found[rows.column("kind").to_numpy(), rows.column("bin").to_numpy()] = rows.column("n").to_numpy()
    if not found.sum(axis=1).all():  # with one kind alone there is nothing to part
        return 0.0
    share = found / found.sum(axis=1, keepdims=True)
    # error of each cut: accepted ones below it, rejected ones at or above it
    error = np.append(0, np.cumsum(share[0])) + 1 - np.append(0, np.cumsum(share[1]))
    best = np.flatnonzero(error <= error.min() + 1e-12)
    return float(best[len(best) // 2]) * 2 * SPAN / BINS - SPAN


def judge(pages: DataFrame, of: list[Rule] | None = None) -> DataFrame:
    """One row for each row of ``pages``: page_id, host, path, rule, verdict (allow or block), score.

    ``pages`` needs page_id and url; other columns play no part. The verdict is that of the longest rule that fits;
    a URL that none fits is allowed if the models' difference reaches the calibrated threshold. ``score`` is that
    difference less the threshold. A null URL is an empty one, without host and path, judged by the models as any
    other. Repeated rows count, and are judged, as often as they occur. Without URLs of both kinds to learn from the
    threshold is 0, so without any all are allowed. An empty table gives an empty one.
    """
    of = rules() if of is None else of
    host, path = host_and_path(pages["url"])
    named = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    named = named.withColumn("_rule", rule_of(F.col("host"), F.col("path"), of))
    half = F.pmod(F.xxhash64("url"), F.lit(2))
    part = (2 * half + F.when(F.col("_rule.verdict") == "block", 1).otherwise(0)).cast("int")
    part = F.when(F.col("_rule").isNull(), -1).otherwise(part).cast("int")
    # read once from the pages, whose other columns are much larger; numbered as written
    named = materialize(named.select("*", part.alias("part"), F.monotonically_increasing_id().alias("row")), "urls")
    scored = materialize(scores(named, grams(named.select("part", "url"))), "url-scores")
    scored = materialize(named.join(scored, "row"), "scored")
    score = F.col("by_both") - F.lit(calibrate(scored.filter("part >= 0")))
    by_model = F.when(score >= 0, "allow").otherwise("block")
    return scored.select(
        "page_id",
        "host",
        "path",
        F.col("_rule.name").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), by_model).alias("verdict"),
        score.alias("score"),
    )
