"""Merkle manifest of a dataset: hash trees by group, proofs and their verification."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsmart.llm.places import placed
from subsmart.llm.resampling import CRC_TABLE, crc_sql
from subsmart.llm.tables import read, stored
from subsmart.operators.spread import sized

FANOUT = 8
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts; null parts are left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def leaf_hash(values: Sequence[Column]) -> Column:
    """The digest of values as text: ``-`` for null, else their UTF-8 byte count, ``:``, value.

    The counts keep values apart, so different rows never have one text.
    """
    texts = [value.cast("string") for value in values]
    return digest(
        *(F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts)
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` leads to, hashed with the siblings of each level of ``proof``."""
    return F.aggregate(proof, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, level by level, left to right."""
    return digest(F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), ""))


@dataclass(frozen=True)
class Trees:
    """Hash trees of groups, level by level from the leaves.

    ``pivots[k]`` has a row per parent of level ``k + 1`` (``tree``, ``pos``, ``n`` nodes of its
    tree and level) with its children in the columns ``c0``, ``c1`` and so on and their
    ``hash``. ``tops[k]`` has the trees whose only node stands at level ``k``: ``tree``,
    ``item``. An item is a struct with a field ``hash``.
    """

    pivots: list[DataFrame]
    tops: list[DataFrame]
    fanout: int

    def roots(self) -> DataFrame:
        """``tree`` and ``hash`` of every tree."""
        parts = [top.select("tree", "item.hash") for top in self.tops]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def nodes(self) -> DataFrame:
        """The inner nodes: ``tree``, ``level``, ``pos``, ``hash``."""
        levels = [
            pivot.select("tree", F.lit(k).alias("level"), "pos", "hash") for k, pivot in enumerate(self.pivots, 1)
        ]
        out = levels[0] if levels else self.tops[0].select("tree", F.lit(0).alias("level"), F.lit(0).cast("long").alias("pos"), "item.hash").limit(0)
        for level in levels[1:]:
            out = out.unionByName(level)
        return out

    def leaves(self, above: DataFrame) -> DataFrame:
        """``item`` and ``proof`` of every leaf, with the columns of ``above``.

        ``above`` has a row per ``tree`` with the ``proof`` of its top. From the top down,
        each child's proof is its siblings, which are the other slots of its row, and its
        parent's proof.
        """
        extra = [c for c in above.columns if c not in ("tree", "proof")]
        above = sized(above).frame
        found = None
        for k in range(len(self.tops) - 1, -1, -1):
            here = self.tops[k].join(above, "tree").select(
                "tree", F.lit(0).cast("long").alias("pos"), "item", "proof", *extra
            )
            if found is not None:
                parents = found.select("tree", "pos", "proof", *extra)
                here = here.unionByName(self._children(self.pivots[k].join(parents, ["tree", "pos"]), extra))
            # The last level is as large as the table and is passed on as it comes.
            found = stored(here) if k else here
        return found.select("item", "proof", *extra)

    def _children(self, rows: DataFrame, extra: list[str]) -> DataFrame:
        slots = [f"c{i}" for i in range(self.fanout)]
        hashes = [F.col(f"{slot}.hash") for slot in slots]
        child = [
            F.struct(
                (F.col("pos") * self.fanout + i).alias("pos"),
                F.col(slot).alias("item"),
                F.struct(
                    F.concat_ws("", *hashes[:i]).alias("before"), F.concat_ws("", *hashes[i + 1 :]).alias("after")
                ).alias("step"),
            )
            for i, slot in enumerate(slots)
        ]
        present = F.filter(F.array(*child), lambda x: x["item"].isNotNull())
        return rows.select("tree", "proof", *extra, F.inline(present)).select(
            "tree", "pos", "item", F.concat(F.array("step"), "proof").alias("proof"), *extra
        )


def grow(nodes: DataFrame, fanout: int = FANOUT) -> Trees:
    """Trees over ``nodes`` (``tree``, ``pos``, ``n``, ``item``), ``fanout`` children to a parent.

    Conditional aggregates spread the children of a parent into its slot columns. Each
    level has a row per parent, so a hot tree is as many groups as it has parents, and
    levels shrink by ``fanout``; their number follows from the largest tree.
    """
    size = nodes.agg(F.max("n")).first()[0] or 0
    pivots, tops = [], [nodes.filter("n = 1").select("tree", "item")]
    while size > 1:
        slot = F.pmod("pos", F.lit(fanout))
        pivot = stored(
            nodes.filter("n > 1")
            .groupBy(
                "tree",
                F.floor(F.col("pos") / fanout).alias("_parent"),
                F.ceil(F.col("n") / fanout).alias("_n"),
            )
            .agg(*(F.max(F.when(slot == i, F.col("item"))).alias(f"c{i}") for i in range(fanout)))
            .select(
                "tree",
                F.col("_parent").alias("pos"),
                F.col("_n").alias("n"),
                *(f"c{i}" for i in range(fanout)),
                digest(*(F.col(f"c{i}.hash") for i in range(fanout))).alias("hash"),
            )
        )
        pivots.append(pivot)
        nodes = pivot.select("tree", "pos", "n", F.struct("hash").alias("item"))
        tops.append(nodes.filter("n = 1").select("tree", "item"))
        size = -(-size // fanout)
    return Trees(pivots, tops, fanout)


@dataclass(frozen=True)
class Manifest:
    """``groups``: the trees of the groups; ``top``: the tree over their roots, by group."""

    groups: Trees
    top: Trees

    def subroots(self) -> DataFrame:
        """``tree``, ``subroot``, ``root`` and ``proof`` (from subroot to root) of every group."""
        root = self.top.roots().select("tree", F.col("hash").alias("root"))
        empty = F.array().cast("array<struct<before:string,after:string>>")
        found = self.top.leaves(root.withColumn("proof", empty))
        return found.select("item.tree", F.col("item.hash").alias("subroot"), "root", "proof")

    def proofs(self) -> DataFrame:
        """Every leaf's carried columns, ``leaf``, ``subroot``, ``root`` and ``proof`` up to the root."""
        found = self.groups.leaves(stored(self.subroots()))
        return found.select("item.*", "subroot", "root", "proof").withColumnRenamed("hash", "leaf")


def build(
    docs: DataFrame,
    columns: Sequence[str] = LEAF_COLUMNS,
    group: str = "lang",
    order: str = "doc_id",
    fanout: int = FANOUT,
    carry: dict[str, Column] | None = None,
) -> Manifest:
    """The manifest of ``docs``: a hash tree per ``group`` and one over their roots.

    A row's leaf is the digest of its ``columns``. In each group leaves ascend by ``order``
    (nulls first, then by leaf). Groups are ordered bytewise, null first. ``carry`` names
    further values to keep with a leaf, besides ``order`` itself.

    Whole rows are read once, where they lie; only digests and carried values move. They
    are sorted into ranges to find their places, so a group may hold any share of rows.

    Null texts are one dash, empty ones ``0:``. Rows that repeat are leaves of their own,
    side by side. A table without rows has no root and no proofs. Columns beyond
    ``columns`` take no part.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    extra = {order: F.col(order), **(carry or {})}
    leaves = stored(
        docs.select(
            key.alias("tree"),
            leaf_hash([F.col(c) for c in columns]).alias("hash"),
            *(value.alias(f"_carried_{name}") for name, value in extra.items()),
        ).withColumn("_row", F.monotonically_increasing_id())
    )
    along = [F.col(c).asc_nulls_first() for c in ("tree", f"_carried_{order}", "hash", "_row")]
    item = F.struct("hash", *(F.col(f"_carried_{name}").alias(name) for name in extra))
    nodes = placed(leaves, along, "tree").select("tree", "pos", "n", item.alias("item"))
    groups = grow(nodes, fanout)
    subroots = placed(groups.roots(), [F.col("tree").asc()])
    top = grow(
        subroots.select(F.lit("").alias("tree"), "pos", "n", F.struct("hash", "tree").alias("item")), fanout
    )
    return Manifest(groups, top)


def op12_manifest(spark, sf_dir) -> DataFrame:
    """Leaves, roots and proofs of all documents, and which of the tampered ones are found out."""
    docs = read(spark, sf_dir, "documents")
    lowered = F.translate(F.col("text"), UPPER, LOWER)
    values = [lowered if name == "text" else F.col(name) for name in LEAF_COLUMNS]
    touched = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    found = build(docs, carry={"tampered": F.when(touched, leaf_hash(values))}).proofs()
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


_FIELDS = ", ".join(
    f"coalesce(octet_length(encode({x}::varchar))::varchar || ':' || {x}::varchar, '-')"
    for x in ("doc_id", "source", "lang", "n_chars", "TEXT")
)

ORACLE = f"""
with recursive {CRC_TABLE}, leaves as (
  select doc_id, coalesce('=' || lang, '') as tree, sha256(concat({_FIELDS.replace("TEXT", "text")})) as hash,
    case when {crc_sql("doc_id::varchar")} % 3 = 0 then
      sha256(concat({_FIELDS.replace("TEXT", f"translate(text, '{UPPER}', '{LOWER}')")})) end as tampered
  from documents, crc_table
), placed as (
  select *, row_number() over (partition by tree order by doc_id nulls first, hash) - 1 as pos, count(*) over (partition by tree) as n from leaves
), nodes as (
  select tree, 0 as level, pos, n, hash from placed
  union all
  select tree, level + 1, pos // 8, any_value((n + 7) // 8), sha256(string_agg(hash, '' order by pos))
  from nodes where n > 1 group by tree, level, pos // 8
), subroots as (
  select tree, hash as subroot, row_number() over (order by encode(tree)) - 1 as pos, count(*) over () as n from nodes where n = 1
), tops as (
  select 0 as level, pos, n, subroot as hash from subroots
  union all
  select level + 1, pos // 8, any_value((n + 7) // 8), sha256(string_agg(hash, '' order by pos))
  from tops where n > 1 group by level, pos // 8
), steps as (
  select p.tree, p.pos, 0 as part, c.level, string_agg(c.hash, '' order by c.pos) filter (c.pos < p.pos // (8 ** c.level)::bigint) as before,
    string_agg(c.hash, '' order by c.pos) filter (c.pos > p.pos // (8 ** c.level)::bigint) as after
  from placed p join nodes c on c.tree = p.tree and c.n > 1 and c.pos // 8 = p.pos // (8 ** (c.level + 1))::bigint
  group by p.tree, p.pos, c.level
  union all
  select p.tree, p.pos, 1, c.level, string_agg(c.hash, '' order by c.pos) filter (c.pos < s.pos // (8 ** c.level)::bigint),
    string_agg(c.hash, '' order by c.pos) filter (c.pos > s.pos // (8 ** c.level)::bigint)
  from placed p join subroots s using (tree) join tops c on c.n > 1 and c.pos // 8 = s.pos // (8 ** (c.level + 1))::bigint
  group by p.tree, p.pos, c.level
), numbered as (
  select tree, pos, coalesce(before, '') as before, coalesce(after, '') as after,
    row_number() over (partition by tree, pos order by part, level) as step from steps
), folds as (
  select tree, pos, 1 as step, coalesce(tampered, hash) as node from placed
  union all
  select f.tree, f.pos, f.step + 1, sha256(s.before || f.node || s.after)
  from folds f join numbered s on s.tree = f.tree and s.pos = f.pos and s.step = f.step
), proofs as (
  select tree, pos, sha256(string_agg(before || after, '' order by step)) as proof_sha256 from numbered group by tree, pos
), ends as (
  select tree, pos, arg_max(node, step) as folded_root from folds group by tree, pos
)
select doc_id, p.hash as leaf, subroot, t.hash as root, coalesce(proof_sha256, sha256('')) as proof_sha256, folded_root, folded_root = t.hash as verified
from placed p join subroots s using (tree) join ends e on e.tree = p.tree and e.pos = p.pos
  left join proofs f on f.tree = p.tree and f.pos = p.pos join tops t on t.n = 1
"""
