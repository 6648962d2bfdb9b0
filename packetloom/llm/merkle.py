"""Merkle manifest of a data set: a digest tree per group, a root over the groups, a proof per row.

Rows lie in superblocks of ``arity ** depth`` consecutive leaves.  Each superblock reduces to one outer
node, outer nodes form superblocks of their own until one per group is left, and the groups' nodes
form the tree of trees.  On the way back the nodes of a superblock and the outer path above it
are cogrouped, so one task reduces its part again, joins its proofs to the outer ones and folds them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import join_small, ship
from packetloom.session import cut_lineage

ARITY, DEPTH = 2, 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
OWN = "*"   # stands for the node itself in one step of a proof; hex digits never hold it


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values: list[Column]) -> Column:
    """SHA-256 over the values, each as ``-`` (null) or its number of UTF-8 bytes, ``:``, itself."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """A written table with ``pos`` (place in its tree by ``order``, from 0) and ``n`` (size of the tree).

    Rows are dealt by ranges of (tree, order), so a tree may be any share of them; a row's place is
    the count before its range plus its place inside.  Equal rows are told apart by where they lie.
    """
    keys = ["tree", *order, "at"]
    spread = nodes.withColumn("at", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = cut_lineage(spread.withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "dealt")
    sizes = dealt.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("c"), F.min("nth").alias("low"))
    tree = Window.partitionBy("tree")
    before = F.sum("c").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("c")
    starts = cut_lineage(sizes.select(F.col("tree").alias("t"), F.col("part").alias("p"), (before - F.col("low")).alias("shift"), F.sum("c").over(tree).alias("n")), "tree_parts")
    joined = join_small(dealt, starts, (F.col("tree") == F.col("t")) & (F.col("part") == F.col("p")), "inner", 128)
    return joined.withColumn("pos", F.col("nth") + F.col("shift")).drop("at", "part", "nth", "t", "p", "shift")


def rounds(n: int, arity: int, depth: int) -> int:
    """How often the nodes of a superblock are reduced in a tree of ``n`` nodes."""
    k = 0
    while n > 1 and k < depth:
        n, k = -(-n // arity), k + 1
    return k


def reduce_levels(digests: list[str], arity: int, k: int) -> list[list[str]]:
    levels = [digests]
    for _ in range(k):
        last = levels[-1]
        levels.append([digest("".join(last[i: i + arity])) for i in range(0, len(last), arity)])
    return levels


def own_steps(levels: list[list[str]], place: int, arity: int) -> list[str]:
    """Per level the run of a node, with ``OWN`` for the node itself."""
    out = []
    for nodes in levels[:-1]:
        begin = place - place % arity
        run = nodes[begin: begin + arity]
        run[place - begin] = OWN
        out.append("".join(run))
        place //= arity
    return out


def fold(node: str, steps: list[str]) -> str:
    for step in steps:
        node = digest(step.replace(OWN, node))
    return node


def climb(nodes: DataFrame, arity: int, depth: int) -> list[DataFrame]:
    """``tree, pos, n, digest`` of each level of superblocks, up to one node per tree."""
    size = arity ** depth

    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["n"].iloc[0])
        root = reduce_levels(rows.sort_values("pos")["digest"].tolist(), arity, rounds(n, arity, depth))[-1][0]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "n": [-(-n // size)], "digest": [root]})

    levels = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        blocks = levels[-1].select("tree", F.expr(f"pos div {size}").alias("block"), "pos", "n", "digest").groupBy("tree", "block")
        levels.append(cut_lineage(blocks.applyInPandas(reduce, "tree string, pos bigint, n bigint, digest string"), "outer_nodes"))
        most = -(-most // size)
    return levels


OUTER = "tree string, pos bigint, path array<string>, subroot string, root string"


def descend(levels: list[DataFrame], outer: DataFrame, arity: int, depth: int) -> DataFrame:
    """The outer path of each node below the lowest superblocks, from those of the top ones."""
    size = arity ** depth

    def work(key: tuple, nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        paths, up = finish(nodes, above, arity, depth)
        return pd.DataFrame({"tree": key[0], "pos": nodes["pos"], "path": paths, "subroot": up["subroot"], "root": up["root"]})

    for nodes in levels[:0:-1][1:]:
        outer = cut_lineage(cogrouped(nodes, outer, size).applyInPandas(work, OUTER), "outer_paths")
    return outer


def cogrouped(nodes: DataFrame, outer: DataFrame, size: int):
    blocks = nodes.withColumn("block", F.expr(f"pos div {size}")).groupBy("tree", "block")
    return blocks.cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block"))


def finish(nodes: pd.DataFrame, above: pd.DataFrame, arity: int, depth: int) -> tuple[list[list[str]], dict]:
    """Sorts ``nodes`` in place; the proof of each, and the one row of ``above``."""
    nodes.sort_values("pos", inplace=True)
    levels = reduce_levels(nodes["digest"].tolist(), arity, rounds(int(nodes["n"].iloc[0]), arity, depth))
    up = above.iloc[0].to_dict()
    outer = list(up["path"])
    return [own_steps(levels, i, arity) + outer for i in range(len(nodes))], up


def manifest(docs: DataFrame, id_col: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS,
             observed: dict[str, Column] | None = None, arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """One row per row of ``docs``: its id and group, ``pos`` in the group, ``leaf``, ``subroot``, ``root``, ``proof``,
    ``folded_root`` and ``verified``.

    A tree per ``group`` orders its leaves by id (null first), then by leaf; runs of ``arity`` nodes become the digest
    of their hex texts until one is left.  The groups' nodes, null first and then by UTF-8 bytes, form one more such tree.  A proof
    step is the run a node lies in, with ``*`` in place of the node (a run of one is ``*``).
    ``observed`` gives fields as they are read later: the fold starts from the leaf with these
    values, and ``verified`` says whether it ends at ``root``.

    Repeated rows are leaves of their own, a null field counts as null, an empty or very long text as any
    other.  Columns that are not ``fields``, the id or the group are not read, whatever their
    names.  An empty table has an empty manifest.

    A task holds one superblock of ``arity ** depth`` digests and the path above it, also in a group that
    has most of the rows; texts are read once and only digests are shuffled.
    """
    ship(docs.sparkSession)
    size = arity ** depth
    read = {f: F.col(f) for f in fields}
    kind = docs.schema[id_col].dataType
    leaves = docs.select(F.col(id_col).alias("id"), F.coalesce(F.concat(F.lit("."), F.col(group).cast("string")), F.lit("")).alias("tree"),
                         leaf([read[f] for f in fields]).alias("digest"), (leaf([(observed or {}).get(f, read[f]) for f in fields])).alias("seen"))
    leaves = numbered(cut_lineage(leaves, "leaves"), ["id", "digest"])
    leaves = cut_lineage(leaves.withColumn("id", F.col("id").cast("string")), "numbered_leaves")
    lower = climb(leaves.select("tree", "pos", "n", "digest"), arity, depth)
    subroots = lower[-1].select(F.lit("").alias("tree"), F.col("tree").alias("own"), "digest")
    tops = cut_lineage(numbered(subroots, ["own"]), "subroots")
    upper = climb(tops.select("tree", "pos", "n", "digest"), arity, depth)
    top = upper[-1].select("tree", "pos", F.array().cast("array<string>").alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))

    def of_group(key: tuple, nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        paths, up = finish(nodes, above, arity, depth)
        return pd.DataFrame({"tree": nodes["own"], "pos": 0, "path": paths, "subroot": nodes["digest"], "root": up["root"]})

    def of_leaves(key: tuple, nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        paths, up = finish(nodes, above, arity, depth)
        folded = [fold(seen, path) for seen, path in zip(nodes["seen"], paths, strict=True)]
        return pd.DataFrame({"id": nodes["id"], "tree": nodes["tree"], "pos": nodes["pos"], "leaf": nodes["digest"], "subroot": up["subroot"],
                             "root": up["root"], "proof": paths, "folded_root": folded})

    outer = cut_lineage(cogrouped(tops, descend(upper, top, arity, depth), size).applyInPandas(of_group, OUTER), "group_paths")
    done = cogrouped(leaves, descend(lower, outer, arity, depth), size).applyInPandas(
        of_leaves, "id string, tree string, pos bigint, leaf string, subroot string, root string, proof array<string>, folded_root string")
    named = F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).cast(docs.schema[group].dataType)
    return done.select(F.col("id").cast(kind).alias(id_col), named.alias(group), "pos", "leaf", "subroot", "root", "proof", "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


def siblings(proof: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf up and left to right."""
    return F.sha2(F.translate(F.array_join(proof, ""), OWN, ""), 256)


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    touched = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    later = {"n_chars": F.when(touched, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    return manifest(docs, observed=later).select("doc_id", "leaf", "subroot", "root", siblings(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


def brute_force(rows: list[tuple]) -> Iterator[tuple]:
    """The rows of the query for rows of (doc_id, source, lang, n_chars, text), on plain lists; for tests."""
    def encoded(row: tuple) -> str:
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tree(nodes: list[str]) -> tuple[str, list[list]]:
        steps: list[list] = [[] for _ in nodes]
        members = [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            for k in range(0, len(nodes), 2):
                run = nodes[k: k + 2]
                for j in range(len(run)):
                    for i in members[k + j]:
                        steps[i].append((run[:j], run[j + 1:]))
            members = [sum(members[k: k + 2], []) for k in range(0, len(nodes), 2)]
            nodes = [digest("".join(nodes[k: k + 2])) for k in range(0, len(nodes), 2)]
        return nodes[0], steps

    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    lower = []
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, encoded(r)))
        lower.append(tree([encoded(r) for r in groups[g]]))
    root, above = tree([s for s, _ in lower]) if names else ("", [])
    for g, (sub, steps), up in zip(names, lower, above, strict=True):
        for row, own in zip(groups[g], steps, strict=True):
            later = list(row)
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                later[3] += 1
            node, proof = encoded(tuple(later)), own + up
            for left, right in proof:
                node = digest("".join(left) + node + "".join(right))
            yield row[0], encoded(row), sub, root, digest("".join("".join(a + b) for a, b in proof)), node, node == root


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


_LEAF = "sha256(" + " || ".join(_field(f"{c}::VARCHAR") for c in FIELDS) + ")"
_SEEN = _LEAF.replace("n_chars", "(n_chars + touched)")
# CRC-32 (reflected, polynomial 0xEDB88320) of the digits, bit by bit
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
  for c in string_split(doc_id::VARCHAR, '')])), lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END))"""
SQL = {"op12_merkle_manifest": f"""
WITH RECURSIVE marked AS (SELECT *, CASE WHEN doc_id IS NULL THEN 0 WHEN {_CRC} % 7 = 0 THEN 1 ELSE 0 END AS touched FROM documents),
leaves AS (SELECT doc_id, coalesce('.' || lang, '') AS tree, {_LEAF} AS leaf, {_SEEN} AS seen FROM marked),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes AS (SELECT tree, 0 AS lvl, pos, n, leaf AS h FROM placed UNION ALL
  SELECT tree, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY tree, lvl, pos // 2, n),
tops AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper AS (SELECT 0 AS lvl, pos, n, h FROM tops UNION ALL
  SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM upper WHERE n > 1 GROUP BY lvl, pos // 2, n),
walk AS (SELECT doc_id, leaf, tree, 0 AS lvl, pos, n, seen AS h, '' AS proof FROM placed UNION ALL
  SELECT w.doc_id, w.leaf, w.tree, w.lvl + 1, w.pos // 2, (w.n + 1) // 2,
    sha256(CASE WHEN s.h IS NULL THEN w.h WHEN w.pos % 2 = 0 THEN w.h || s.h ELSE s.h || w.h END), w.proof || coalesce(s.h, '')
  FROM walk w LEFT JOIN nodes s ON s.tree = w.tree AND s.lvl = w.lvl AND s.pos = xor(w.pos, 1) WHERE w.n > 1),
over AS (SELECT w.doc_id, w.leaf, t.h AS subroot, 0 AS lvl, t.pos, t.n, w.h, w.proof FROM walk w JOIN tops t USING (tree) WHERE w.n = 1 UNION ALL
  SELECT w.doc_id, w.leaf, w.subroot, w.lvl + 1, w.pos // 2, (w.n + 1) // 2,
    sha256(CASE WHEN s.h IS NULL THEN w.h WHEN w.pos % 2 = 0 THEN w.h || s.h ELSE s.h || w.h END), w.proof || coalesce(s.h, '')
  FROM over w LEFT JOIN upper s ON s.lvl = w.lvl AND s.pos = xor(w.pos, 1) WHERE w.n > 1)
SELECT o.doc_id, o.leaf, o.subroot, r.h AS root, sha256(o.proof) AS proof_sha256, o.h AS folded_root, o.h = r.h AS verified
FROM over o, (SELECT h FROM upper WHERE n = 1) r WHERE o.n = 1"""}
QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}
