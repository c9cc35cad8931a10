"""Merkle manifest of a document table: a digest for every row, one for the whole, and a proof for each row.

Rows of a language form a tree of ``FANOUT`` children a node; the roots of the languages form another one. Of a tree's
levels only every ``STRIDE``-th is stored. A proof needs the levels between as well: they are made anew, for one aligned
subtree at a time, from the stored nodes below it, their siblings go into the proofs of that subtree, and they are gone.
All of it is columns and grouped aggregates; a group is one aligned subtree, FANOUT ** STRIDE rows at most.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .checking_sql import crc32
from .rows import shuffle_partitions

FANOUT = 8
#: Levels from one stored level to the next.
STRIDE = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "struct<left:string,right:string>"


def _h(parts: Column) -> Column:
    """The digest of an array of strings, laid end to end."""
    return F.sha2(F.array_join(parts, ""), 256)


def leaf(fields: dict[str, Column]) -> Column:
    """The digest of a row: each value as ``bytes:value``, a null as ``-``."""
    told = []
    for value in fields.values():
        value = value.cast("string")
        told.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*told), 256)


def ordered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``idx``, the place of a row in its group from 0 on, and ``n``, the group's rows; written once.

    Rows are dealt by ranges of (group, order, place in the input), so a group of any size, or of equal rows only, is cut
    into many tasks. A task numbers its own rows; where it begins follows from the rows of each task.
    """
    parts = shuffle_partitions(df.sparkSession)
    dealt = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(parts, group, *order, "_row")
    dealt = materialize(dealt.withColumn("_part", F.spark_partition_id()), name)
    counts = dealt.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"), F.sum("_n").over(whole).alias("n")
    )
    within = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order, "_row")) - 1
    numbered = dealt.withColumn("_within", within).join(counts, [group, "_part"])
    return numbered.withColumn("idx", F.col("_first") + F.col("_within")).drop("_row", "_part", "_first", "_within")


def _parents(nodes: Column) -> Column:
    runs = F.sequence(F.lit(0), ((F.size(nodes) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda run: _h(F.slice(nodes, run * FANOUT + 1, F.lit(FANOUT))))


def _levels(blocks: DataFrame) -> DataFrame:
    """``blocks`` (members with a hash, n) with the levels of the subtree, ``_l0`` to the next stored one, and the
    number of nodes that the tree has on each, ``_n0`` and on. A tree that has come down to one node stays at it."""
    out = blocks.withColumn("_l0", F.col("members.hash")).withColumn("_n0", F.col("n"))
    for k in range(STRIDE):
        out = out.withColumn(f"_l{k + 1}", F.when(F.col(f"_n{k}") > 1, _parents(F.col(f"_l{k}"))).otherwise(F.col(f"_l{k}")))
        out = out.withColumn(f"_n{k + 1}", F.ceil(F.col(f"_n{k}") / FANOUT))
    return out


def _blocks(nodes: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The aligned subtrees over stored ``nodes`` (grp, idx, n, hash), with their levels."""
    size = FANOUT**STRIDE
    block = F.floor(F.col("idx") / size).alias("block")
    members = F.sort_array(F.collect_list(F.struct("idx", "hash", *extra))).alias("members")
    return _levels(nodes.groupBy("grp", block).agg(F.first("n").alias("n"), members))


def store(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The stored levels over ``nodes`` (grp, idx, n, hash) and what else they have; the last one has a row a tree."""
    stored = [nodes]
    while (stored[-1].agg(F.max("n")).first()[0] or 0) > 1:
        up = _blocks(stored[-1]).select(
            "grp", F.col("block").alias("idx"), F.col(f"_n{STRIDE}").alias("n"), F.col(f"_l{STRIDE}")[0].alias("hash")
        )
        stored.append(materialize(up, f"{name}-{STRIDE * len(stored)}"))
    return stored


@dataclass(frozen=True)
class Manifest:
    """Stored levels. ``trees``: of each language, from rows (grp, idx, n, hash, and the row's own columns) to subroots;
    ``top``: from the subroots to the root."""

    trees: list[DataFrame]
    top: list[DataFrame]

    @property
    def root(self) -> DataFrame:
        """One row, the root; none for an empty table."""
        return self.top[-1].select(F.col("hash").alias("root"))


def build(leaves: DataFrame) -> Manifest:
    """The manifest of ``leaves``: doc_id, lang, hash, and columns that rows of the proofs shall carry.

    A language's rows stand by doc_id (null first), equal ids by their digests, so that the root does not depend on the
    order of the input. Languages stand by their bytes, null first.
    """
    group = F.coalesce(F.concat(F.lit("+"), F.col("lang")), F.lit(""))  # keeps the order, and null before the empty one
    rows = ordered(leaves.withColumn("grp", group).drop("lang"), "grp", ["doc_id", "hash"], "merkle-rows")
    trees = store(materialize(rows, "merkle-0"), "merkle")
    roots = trees[-1].select(F.col("grp").alias("tree"), "hash", F.lit("").alias("grp"))
    top = store(materialize(ordered(roots, "grp", ["tree"], "merkle-roots"), "merkle-top-0"), "merkle-top")
    return Manifest(trees, top)


def _down(nodes: DataFrame, above: DataFrame, extra: tuple[str, ...], known: tuple[str, ...]) -> DataFrame:
    """``path`` of each of the stored ``nodes``: what stands left and right of it, level by level, up to the root.

    ``above`` (grp, idx, path) holds the paths of the next stored level, ``known`` what else it hands down.
    """
    up = above.select("grp", F.col("idx").alias("block"), F.col("path").alias("_up"), *known)
    member = F.posexplode("members").alias("_j", "_m")
    rows = _blocks(nodes, extra).join(up, ["grp", "block"]).select("*", member)
    steps = []
    for k in range(STRIDE):
        place = F.floor(F.col("_j") / FANOUT**k).cast("int")
        run = (place / FANOUT).cast("int") * FANOUT
        left = F.slice(F.col(f"_l{k}"), run + 1, place - run)
        right = F.slice(F.col(f"_l{k}"), place + 2, run + FANOUT - 1 - place)
        step = F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))
        steps.append(F.when(F.col(f"_n{k}") > 1, step))
    own = F.filter(F.array(*steps), lambda x: x.isNotNull())
    path = F.concat(own, F.col("_up")).alias("path")
    return rows.select("grp", F.col("_m.idx").alias("idx"), F.col("_m.hash").alias("hash"), path, *known, *[f"_m.{c}" for c in extra])


def proofs(manifest: Manifest, carried: tuple[str, ...]) -> DataFrame:
    """For each row: ``carried`` columns, hash, ``path`` (of left and right siblings), subroot and root."""
    nothing = F.array().cast(f"array<{_STEP}>")
    now = manifest.top[-1].select("grp", "idx", nothing.alias("path"), F.col("hash").alias("root"))
    for nodes in manifest.top[-2:0:-1]:
        now = _down(nodes, now, (), ("root",))
    if len(manifest.top) > 1:
        now = _down(manifest.top[0], now, ("tree",), ("root",))
    else:
        now = now.join(manifest.top[0].select("grp", "idx", "hash", "tree"), ["grp", "idx"])
    now = now.select(F.col("tree").alias("grp"), F.lit(0).cast("long").alias("idx"), "path", F.col("hash").alias("subroot"), "root")
    for nodes in manifest.trees[-2:0:-1]:
        now = materialize(_down(nodes, now, (), ("subroot", "root")), "merkle-paths")
    if len(manifest.trees) > 1:
        return _down(manifest.trees[0], now, carried, ("subroot", "root"))
    return now.join(manifest.trees[0].select("grp", "idx", "hash", *carried), ["grp", "idx"])


def siblings(path: Column) -> Column:
    """The digest of a proof: of all its siblings, from the row's up, left to right."""
    return _h(F.transform(path, lambda step: F.concat(step["left"], step["right"])))


def fold(found: Column, path: Column) -> Column:
    """The root that the digest ``found`` and a proof's siblings give."""
    return F.aggregate(path, found, lambda below, step: F.sha2(F.concat(step["left"], below, step["right"]), 256))


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def audit(docs: DataFrame, tampered: dict[str, Column] | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, leaf, subroot, root, proof_sha256 and the ``path`` itself, then
    folded_root, which the row as it is found gives with the proof of the row as it was, and verified.

    ``docs`` needs the columns of FIELDS, others play no part. ``tampered`` replaces some of them by what is found.
    A null has a digest of its own, other than the empty text's; a null doc_id or language stands first. A row that is
    there twice has two leaves side by side, with the proof of each. An empty table has no rows and no root.
    """
    fields = {c: docs[c] for c in FIELDS}
    found = leaf({**fields, **(tampered or {})})
    leaves = docs.select("doc_id", "lang", leaf(fields).alias("hash"), found.alias("found"))
    rows = proofs(build(leaves), ("doc_id", "found"))
    rows = rows.withColumn("folded_root", fold(F.col("found"), F.col("path")))
    return rows.select(
        "doc_id", F.col("hash").alias("leaf"), "subroot", "root", siblings(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "path",
    )


def sql(levels: int = 12) -> str:
    """The rows of the query, for trees of up to ``levels`` levels: every level kept, every node hashed."""

    def tree(prefix: str, leaves: str, count: int) -> str:
        out = [f"{prefix}0 AS ({leaves})"]
        for k in range(count):
            # nodes of one run stand together: their digest goes up, and each gets the others as its siblings
            out.append(
                f"{prefix}r{k} AS (SELECT grp, idx // {FANOUT} AS run, any_value(n) AS n, list(hash ORDER BY idx) AS hashes "
                f"FROM {prefix}{k} GROUP BY grp, run)"
            )
            out.append(
                f"{prefix}{k + 1} AS (SELECT grp, run AS idx, CASE WHEN n > 1 THEN sha256(array_to_string(hashes, '')) ELSE hashes[1] END "
                f"AS hash, CAST(ceil(n / {FANOUT}) AS BIGINT) AS n FROM {prefix}r{k})"
            )
        return ",\n".join(out)

    def climb(prefix: str, start: str, count: int) -> str:
        out = [f"{prefix}p0 AS ({start})"]
        for k in range(count):
            left = f"array_to_string(r.hashes[1:p.spot % {FANOUT}], '')"
            right = f"array_to_string(r.hashes[p.spot % {FANOUT} + 2:], '')"
            out.append(
                f"{prefix}p{k + 1} AS (SELECT p.* EXCLUDE (spot, said, folded), p.spot // {FANOUT} AS spot, "
                f"CASE WHEN r.n > 1 THEN said || {left} || {right} ELSE said END AS said, "
                f"CASE WHEN r.n > 1 THEN sha256({left} || folded || {right}) ELSE folded END AS folded "
                f"FROM {prefix}p{k} p JOIN {prefix}r{k} r ON r.grp = p.grp AND r.run = p.spot // {FANOUT})"
            )
        return ",\n".join(out)

    def digest(**other: str) -> str:
        parts = []
        for c in FIELDS:
            value = f"CAST({other.get(c, c)} AS VARCHAR)"
            parts.append(f"coalesce(strlen({value}) || ':' || {value}, '-')")
        return f"sha256({' || '.join(parts)})"

    crc = crc32("doc_id")
    low = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""
WITH told AS (SELECT doc_id, coalesce('+' || lang, '') AS grp, {digest()} AS hash,
    CASE WHEN {crc} % 3 = 0 THEN {digest(text=low)} ELSE {digest()} END AS found FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, hash) - 1 AS idx,
    count(*) OVER (PARTITION BY grp) AS n FROM told),
{tree("a", "SELECT grp, idx, hash, n FROM placed", levels)},
subroots AS (SELECT grp AS tree, hash, 0 AS grp, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n FROM a{levels}),
{tree("b", "SELECT grp, idx, hash, n FROM subroots", levels)},
{climb("a", "SELECT doc_id, grp, hash, idx AS spot, '' AS said, found AS folded FROM placed", levels)},
{climb("b", f"SELECT p.doc_id, s.grp, p.hash, s.hash AS subroot, s.idx AS spot, said, folded FROM ap{levels} p JOIN subroots s ON s.tree = p.grp", levels)}
SELECT doc_id, p.hash AS leaf, subroot, b.hash AS root, sha256(said) AS proof_sha256, folded AS folded_root, folded = b.hash AS verified
FROM bp{levels} p JOIN b{levels} b ON b.grp = p.grp
"""
