"""Prefix trie of conversations by parallel tree contraction (operator 12).

A node is a distinct sequence of a conversation's first d turns (role, text);
the root is the empty one.  It is named by 128 bits: the exclusive or of two
64-bit hashes of each turn's digest and place, so a node's name is its
parent's with one turn more, and whole prefixes are never carried.

Subtree totals come from contracting the tree in join rounds.  *Rake* takes
away all leaves and adds their totals to their parents (grouped by parent, so
a parent of any number of leaves is pre-aggregated).  *Compress* then takes
away all chains of nodes with one child: pointer doubling gives each chain
node the chain's end and the sum of what lies between, in a number of rounds
that grows with the logarithm of the chain.  Each pair halves the leaves at
least.  When the root has been raked, the contracted chains are expanded again,
the last first: a chain node's total is its sum plus that of its chain's end.

Scale: everything is a join or an aggregate on node names; each round is
a written table in the shared folder.  Turns are put in order by a window
a conversation; conversations of more than ``long_from`` turns are ordered by
a range-partitioned numbering and their prefixes summed in blocks of that
many turns, so none is one task's work.  The ids of a node's members that end there are
joined in blocks of 1,024 consecutive ids before one pass hashes a
node's blocks as a stream.

Defined results: a null role or text is empty; a null conv_id names no
conversation, its rows are left out; turns are ordered with null first, equal
turns by role, then text, and repeated rows are turns of their own; an empty
table has no nodes; columns other than the four are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relprep.llm.common import written
from relprep.operators.keys import with_identity

#: Turns of another conversation that a conversation may begin with, at most (fixed by the contract).
HEAD = 5
#: Ids joined at a time for a node's hash: 2 ** BLOCK_BITS.
BLOCK_BITS = 10


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest, n_chars) of the rows that belong to a conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    return rows.select("conv_id", "turn", "role", "text", digest.alias("digest"), F.char_length("text").cast("long").alias("n_chars"))


#: Spark's ascending order has null first.
_ORDER = ["turn", "role", "text"]


def _names(digest: Column, place: Column) -> tuple[Column, Column]:
    """Two hashes of a turn at its place (from 0)."""
    place = place.cast("long")
    return F.xxhash64(digest, place), F.xxhash64(place, digest)


def heads(turns: DataFrame, every: int) -> DataFrame:
    """(base, head): the first HEAD turns, as an array, of each conversation that others may begin with."""
    own = turns.where(F.col("conv_id") % every == 0)
    first = own.withColumn("i", F.row_number().over(Window.partitionBy("conv_id").orderBy(*_ORDER))).where(F.col("i") <= HEAD)
    return first.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("i", "digest", "n_chars"))).alias("head"))


def prefixes(turns: DataFrame, every: int = 100, long_from: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations' prefixes and the conversations.

    A conversation c begins with the first h turns of c - c % every, h = crc32(c) % 6,
    and goes on with its own turns after its first h.  Returns
    (conv_id, depth, a, b, pa, pb, n_chars), one row a prefix with at least one
    turn, and (conv_id, n), n the number of rebuilt turns.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own")).withColumn("h", h)
    based = sizes.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(heads(turns, every), "base", "left")
    head = F.slice(F.coalesce("head", F.expr("cast(array() as array<struct<i: int, digest: binary, n_chars: bigint>>)")), 1, F.col("h").cast("int"))
    info = based.withColumn("head", head).withColumn("n_head", F.size("head").cast("long"))
    info = info.withColumn("n", F.col("n_head") + F.greatest(F.lit(0), F.col("n_own") - F.col("h")))

    # The head's running names: at most HEAD of them, folded from the front.
    def step(so_far: Column, t: Column) -> Column:
        a, b = _names(t["digest"], F.size(so_far))
        pa, pb = F.coalesce(F.get(so_far, F.size(so_far) - 1)["a"], F.lit(0)), F.coalesce(F.get(so_far, F.size(so_far) - 1)["b"], F.lit(0))
        node = F.struct(pa.bitwiseXOR(a).alias("a"), pb.bitwiseXOR(b).alias("b"), pa.alias("pa"), pb.alias("pb"), t["n_chars"].alias("n_chars"))
        return F.concat(so_far, F.array(node))

    empty = F.expr("cast(array() as array<struct<a: bigint, b: bigint, pa: bigint, pb: bigint, n_chars: bigint>>)")
    info = written(info.withColumn("head", F.aggregate("head", empty, step)), "conversations")

    last = F.get("head", F.size("head") - 1)
    start = info.select("conv_id", "n_own", "h", "n_head", F.coalesce(last["a"], F.lit(0)).alias("a0"), F.coalesce(last["b"], F.lit(0)).alias("b0"))
    rest = start.where("n_own > h")
    place = F.col("n_head") + F.col("i") - F.col("h")

    def named(own: DataFrame, by: list[str]) -> DataFrame:
        """Running names of the turns from the h-th on, within ``by``."""
        a, b = _names(F.col("digest"), place)
        so_far = Window.partitionBy(*by).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        own = own.where("i >= h").withColumn("ha", a).withColumn("hb", b)
        return own.withColumn("xa", F.bit_xor("ha").over(so_far)).withColumn("xb", F.bit_xor("hb").over(so_far))

    def rows(own: DataFrame) -> DataFrame:
        a, b = F.col("a0").bitwiseXOR(F.col("xa")), F.col("b0").bitwiseXOR(F.col("xb"))
        return own.select("conv_id", (place + 1).alias("depth"), a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("ha")).alias("pa"), b.bitwiseXOR(F.col("hb")).alias("pb"), "n_chars")

    usual = turns.join(rest.where(F.col("n_own") <= long_from), "conv_id")
    usual = usual.withColumn("i", F.row_number().over(Window.partitionBy("conv_id").orderBy(*_ORDER)) - 1)
    parts = [rows(named(usual, ["conv_id"]))]

    large = rest.where(F.col("n_own") > long_from)
    if not large.isEmpty():
        numbered = with_identity(turns.join(large.select("conv_id"), "conv_id", "left_semi"), ["conv_id", "turn", "role", "text"], "at")
        first = numbered.groupBy("conv_id").agg(F.min("at").alias("first"))
        placed = numbered.select("conv_id", "at", "digest", "n_chars").join(first, "conv_id").join(large, "conv_id").withColumn("i", F.col("at") - F.col("first"))
        placed = placed.withColumn("block", F.floor(F.col("i") / long_from))
        inner = written(named(placed, ["conv_id", "block"]), "long-turns")
        before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = inner.groupBy("conv_id", "block").agg(F.bit_xor("ha").alias("ba"), F.bit_xor("hb").alias("bb"))
        blocks = blocks.select("conv_id", "block", F.coalesce(F.bit_xor("ba").over(before), F.lit(0)).alias("ba"), F.coalesce(F.bit_xor("bb").over(before), F.lit(0)).alias("bb"))
        whole = inner.join(blocks, ["conv_id", "block"])
        parts.append(rows(whole.withColumn("xa", F.col("xa").bitwiseXOR(F.col("ba"))).withColumn("xb", F.col("xb").bitwiseXOR(F.col("bb")))))

    own_head = info.select("conv_id", F.posexplode("head").alias("p", "node"))
    out = own_head.select("conv_id", (F.col("p") + 1).cast("long").alias("depth"), "node.a", "node.b", "node.pa", "node.pb", "node.n_chars")
    for part in parts:
        out = out.unionByName(part)
    return written(out, "prefixes"), info.select("conv_id", "n")


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """(a, b, *values): each value of ``tree`` (a, b, pa, pb, kids, *values) summed over the node's subtree.

    ``kids`` is the number of children; the root's pa and pb are null.
    """
    name, parent, end = ["a", "b"], ["pa", "pb"], ["ea", "eb"]
    added = [f"{v}_added" for v in values]
    live, totals, chains = written(tree.select(*name, *parent, "kids", *values), "trie-0"), [], []
    phase = 0
    while True:
        phase += 1
        # Rake: leaves are done, their parents take their totals.
        leaf = live.where("kids = 0")
        totals.append(leaf.select(*name, *values))
        given = leaf.where("pa IS NOT NULL").groupBy(*[F.col(p).alias(n) for p, n in zip(parent, name)]).agg(F.count(F.lit(1)).alias("gone"), *[F.sum(v).alias(x) for v, x in zip(values, added)])
        inner = live.where("kids > 0").join(given, name, "left")
        inner = inner.select(*name, *parent, (F.col("kids") - F.coalesce("gone", F.lit(0))).alias("kids"), *[(F.col(v) + F.coalesce(x, F.lit(0))).alias(v) for v, x in zip(values, added)])
        inner = written(inner, f"rake-{phase}")
        if inner.isEmpty():
            break
        # Compress: a node with one child points at it; pointers are doubled until all reach their chain's end.
        is_link = (F.col("kids") == 1) & F.col("pa").isNotNull()
        links = inner.where(is_link)
        child = inner.where("pa IS NOT NULL").groupBy(*[F.col(p).alias(n) for p, n in zip(parent, name)])
        child = child.agg(F.min(F.struct("a", "b", "kids")).alias("c")).select(*name, F.col("c.a").alias("ea"), F.col("c.b").alias("eb"), (F.col("c.kids") == 1).alias("open"))
        first = chain = written(links.select(*name, *values).join(child, name), f"chain-{phase}-0")
        jump = 0
        while not chain.where("open").isEmpty():
            jump += 1
            ahead = chain.select(F.col("a").alias("ea"), F.col("b").alias("eb"), F.col("ea").alias("fa"), F.col("eb").alias("fb"), F.col("open").alias("more"), *[F.col(v).alias(x) for v, x in zip(values, added)])
            moved = chain.where("open").join(ahead, end)
            moved = moved.select(*name, *[(F.col(v) + F.col(x)).alias(v) for v, x in zip(values, added)], F.col("fa").alias("ea"), F.col("fb").alias("eb"), F.col("more").alias("open"))
            chain = written(chain.where("NOT open").unionByName(moved), f"chain-{phase}-{jump}")
        chains.append(chain)
        # A chain's top hands its parent the chain's sum, and the chain's end to be its child.
        other = inner.where(~is_link)
        below = first.where("open").select(F.col("ea").alias("a"), F.col("eb").alias("b"))
        tops = links.select(*name, *parent).join(below, name, "left_anti").join(chain, name)
        ends = tops.select(F.col("ea").alias("a"), F.col("eb").alias("b"), F.col("pa").alias("ua"), F.col("pb").alias("ub"))
        sums = tops.groupBy(*[F.col(p).alias(n) for p, n in zip(parent, name)]).agg(*[F.sum(v).alias(x) for v, x in zip(values, added)])
        live = other.join(ends, name, "left").join(sums, name, "left")
        live = live.select(*name, F.coalesce("ua", "pa").alias("pa"), F.coalesce("ub", "pb").alias("pb"), "kids", *[(F.col(v) + F.coalesce(x, F.lit(0))).alias(v) for v, x in zip(values, added)])
        live = written(live, f"trie-{phase}")

    known = totals[0]
    for t in totals[1:]:
        known = known.unionByName(t)
    for k, chain in reversed(list(enumerate(chains))):
        reached = known.select(F.col("a").alias("ea"), F.col("b").alias("eb"), *[F.col(v).alias(x) for v, x in zip(values, added)])
        opened = chain.join(reached, end).select(*name, *[(F.col(v) + F.col(x)).alias(v) for v, x in zip(values, added)])
        known = known.unionByName(written(opened, f"expand-{k}"))
    return known


def _hash_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's blocks, which follow one another, as a stream."""
    name, state = None, None
    for batch in batches:
        out = []
        for a, b, ids in zip(batch["a"].tolist(), batch["b"].tolist(), batch["ids"].tolist()):
            if (a, b) == name:
                state.update(b",")
            else:
                if name is not None:
                    out.append((*name, state.hexdigest()))
                name, state = (a, b), hashlib.sha256()
            state.update(ids.encode())
        yield pd.DataFrame(out, columns=["a", "b", "ends_sha256"])
    if name is not None:
        yield pd.DataFrame([(*name, state.hexdigest())], columns=["a", "b", "ends_sha256"])


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of the members (a, b, conv_id) that end at each node."""
    blocks = ends.groupBy("a", "b", F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    return blocks.repartition("a", "b").sortWithinPartitions("a", "b", "block").select("a", "b", "ids").mapInPandas(_hash_blocks, "a long, b long, ends_sha256 string")


def trie(conversations: DataFrame, every: int = 100, long_from: int = 100_000) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, convs = prefixes(turns_of(conversations), every, long_from)
    nodes = rows.groupBy("a", "b").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *[F.min(c).alias(c) for c in ("depth", "pa", "pb", "n_chars")])
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("a"), zero.alias("b"), "conv_id", "n_convs", zero.alias("depth"), none.alias("pa"), none.alias("pb"), zero.alias("n_chars"))
    kids = nodes.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("kids"))
    nodes = written(nodes.unionByName(root).join(kids, ["a", "b"], "left").withColumn("kids", F.coalesce("kids", zero)), "nodes")

    tree = nodes.select("a", "b", "pa", "pb", "kids", F.when(F.col("kids") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens"))
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"])

    last = rows.join(convs, "conv_id").where("depth = n").select("a", "b", "conv_id")
    last = last.unionByName(convs.where("n = 0").select(zero.alias("a"), zero.alias("b"), "conv_id"))
    # The root, which may have more children than any other node, is met as a scalar.
    above = nodes.where("depth > 0").select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    deep = nodes.where("depth > 1").select("a", "b", "pa", "pb").join(above, ["pa", "pb"]).select("a", "b", "parent_conv_id")
    first = nodes.where("depth = 0").select("conv_id").scalar()
    parents = deep.unionByName(nodes.where("depth <= 1").select("a", "b", F.when(F.col("depth") == 1, first).alias("parent_conv_id")))
    out = nodes.join(totals, ["a", "b"]).join(parents, ["a", "b"]).join(ends_hashes(last), ["a", "b"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.col("kids").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
