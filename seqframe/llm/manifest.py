"""Merkle manifest of a dataset, built level by level with lag and lead windows.

Every row becomes a leaf digest.  Leaves of a group (``lang``) stand in the order of their ids; while a
group has several nodes, every ``FAN`` consecutive ones become their parent's digest.  The groups'
last nodes, ordered by group, are the leaves of a second tree of the same kind, whose last node is the
dataset's root.

Per level, a window over the run of a node supplies its siblings: ``lag`` and ``lead`` at the fixed
offsets 1 to ``FAN - 1``, masked by the node's slot and its run's length; the rows at slot 0 hash the
parents.  A run has at most ``FAN`` rows, so a window's partition never grows, and a group with most rows
is spread like any other.  Only digests move: texts are hashed where they are read.  A level has an
eighth of the rows of the one below and is written once, with its siblings; leaves are numbered by a
range partitioning.  On the way back down, a node's path (siblings per level up to the root) is its own
siblings followed by its parent's path, met by a join on the parent, so proofs come from the same
windows.  With ``n`` leaves there are about ``log8(n)`` small jobs each way.

Null fields count as ``-``.  The null group comes first.  Rows with a null id come first in their group
and are never tampered with; rows equal in id are ordered by their leaf, so repeated rows are equal leaves
and any order of them gives the same digests.  An empty table gives an empty result.  Long texts are
hashed whole.  Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqframe.llm.common import read, source_key, store
from seqframe.operators.numbering import dense_index

FAN = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Groups are joined by broadcast up to this counted number (some 100 bytes each).
BROADCAST_GROUPS = 100_000


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the parts one after another."""
    return F.sha2(F.concat(*parts), 256)


def told(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column) -> Column:
    """Digest of a row with ``text`` in place of its text."""
    return digest(*[told(text if c == "text" else F.col(c)) for c in FIELDS])


def ascii_lower(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def number(nodes: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``idx`` (position within ``g``) and ``size`` (rows of ``g``); ``order`` begins with ``g``."""
    placed = dense_index(nodes, order, out="_at")
    groups = store(placed.groupBy("g").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("size")), "groups")
    small = F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups
    return placed.join(small, "g").withColumn("idx", F.col("_at") - F.col("_first")).drop("_at", "_first")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` (``g, idx, size, node``) with ``parent, slot, before, after``: the digests of the run's
    other nodes on either side, one after another."""
    run = Window.partitionBy("g", "parent").orderBy("idx")
    placed = nodes.withColumn("parent", F.floor(F.col("idx") / FAN).cast("long")).withColumn(
        "slot", F.col("idx") - FAN * F.col("parent")).withColumn(
        "_run", F.least(F.lit(FAN), F.col("size") - FAN * F.col("parent")))
    for k in range(1, FAN):
        placed = placed.withColumn(f"_b{k}", F.when(F.col("slot") >= k, F.lag("node", k).over(run)))
        placed = placed.withColumn(
            f"_a{k}", F.when(F.col("slot") + k < F.col("_run"), F.lead("node", k).over(run)))
    return placed.select(
        *nodes.columns, "parent", "slot",
        F.concat_ws("", *[f"_b{k}" for k in range(FAN - 1, 0, -1)]).alias("before"),
        F.concat_ws("", *[f"_a{k}" for k in range(1, FAN)]).alias("after"))


def parents(level: DataFrame) -> DataFrame:
    """The next level: rows at slot 0 hash their run.  A group's last node is carried up as it is."""
    several = F.col("size") > 1
    return level.where("slot = 0").select(
        "g", F.col("parent").alias("idx"), F.ceil(F.col("size") / FAN).cast("long").alias("size"),
        F.when(several, digest(F.col("node"), F.col("after"))).otherwise(F.col("node")).alias("node"))


def climb(leaves: DataFrame, name: str) -> list[DataFrame]:
    """Levels from the leaves (not stored here, siblings computed when used) to one node a group."""
    levels = [with_siblings(leaves.select("g", "idx", "size", "node"))]
    widest = leaves.agg(F.max("size")).first()[0] or 0
    while widest > 1:
        levels.append(store(with_siblings(parents(levels[-1])), name))
        widest = -(-widest // FAN)
    return levels


def descend(level: DataFrame, above: DataFrame) -> DataFrame:
    """``level`` with the columns of ``above`` (``g, idx, path, ...`` of the next level), its own step put
    before the path.  A node that was carried up has no step of its own."""
    step = F.array(F.struct("before", "after"))
    joined = level.join(above.withColumnRenamed("idx", "parent"), ["g", "parent"])
    return joined.withColumn(
        "path", F.when(F.col("size") > 1, F.concat(step, "path")).otherwise(F.col("path"))).drop(
        "parent", "slot", "size", "before", "after")


def fold(node: Column, path: Column) -> Column:
    """The root that ``node`` leads to with the siblings of ``path``."""
    return F.aggregate(path, node, lambda acc, s: digest(s["before"], acc, s["after"]))


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, seen, subroot, root, path`` per row; ``seen`` is the leaf of the row as tampered
    with, where it was, ``path`` the siblings on the way to the root."""
    changed = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    rows = docs.select(
        source_key(F.col("lang")).alias("g"), "doc_id", leaf(F.col("text")).alias("node"),
        leaf(F.when(changed, ascii_lower(F.col("text"))).otherwise(F.col("text"))).alias("seen"))
    leaves = store(number(rows, [F.col("g"), F.col("doc_id").asc_nulls_first(), F.col("node")]), "leaves")
    levels = climb(leaves, "level")
    # The groups' last nodes are the leaves of the upper tree, a single group.
    subroots = levels[-1].select("g", F.col("node").alias("subroot"))
    ranked = store(number(
        subroots.select(F.lit("").alias("g"), F.col("g").alias("lang"), F.col("subroot").alias("node")),
        [F.col("lang")]), "subroots")
    upper = climb(ranked, "upper")
    paths = upper[-1].select("g", "idx", F.col("node").alias("root"), F.expr(
        "cast(array() as array<struct<before:string,after:string>>)").alias("path"))
    for level in reversed(upper[:-1]):
        paths = descend(level, paths).drop("node")
    paths = ranked.select("g", "idx", "lang", F.col("node").alias("subroot")).join(
        paths, ["g", "idx"]).select(F.col("lang").alias("g"), F.lit(0).cast("long").alias("idx"),
                                    "subroot", "root", "path")
    for level in reversed(levels[1:-1]):
        paths = store(descend(level, paths).drop("node"), "paths")
    below = with_siblings(leaves)
    if len(levels) == 1:  # every group is a lone leaf
        found = below.drop("parent", "slot", "before", "after", "size").join(paths, ["g", "idx"])
    else:
        found = descend(below, paths)
    return found.select("doc_id", F.col("node").alias("leaf"), "seen", "subroot", "root", "path")


def verify(found: DataFrame) -> DataFrame:
    """The manifest with its proofs, and each row's leaf as seen folded up to the root again."""
    folded = fold(F.col("seen"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


def op11_merkle(spark, sf_dir):
    return verify(manifest(read(spark, sf_dir, "documents")))


QUERIES = {"op11_merkle": op11_merkle}


def _told_sql(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(f"({_told_sql(text if c == 'text' else c)})" for c in FIELDS) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """Levels ``{name}`` over ``leaves`` (``g, idx, size, node``), siblings ``{name}_step``."""
    return f"""
{name} AS (
  SELECT 0 AS lvl, g, idx, size, node FROM {leaves}
  UNION ALL
  SELECT lvl + 1, g, idx // {FAN}, (size + {FAN - 1}) // {FAN}, sha256(string_agg(node, '' ORDER BY idx))
  FROM {name} WHERE size > 1 GROUP BY lvl, g, idx // {FAN}, size),
{name}_step AS (
  SELECT a.lvl, a.g, a.idx,
    coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
    coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
  FROM {name} a JOIN {name} b ON a.lvl = b.lvl AND a.g = b.g AND a.idx // {FAN} = b.idx // {FAN}
  WHERE a.size > 1 GROUP BY a.lvl, a.g, a.idx),
"""


def _fold_sql(name: str, tree: str, start: str) -> str:
    """Rows of ``start`` (``doc_id, g, idx, cur, proof``) led up ``tree``, one row a level."""
    return f"""
{name} AS (
  SELECT 0 AS lvl, doc_id, g, idx, cur, proof FROM {start}
  UNION ALL
  SELECT f.lvl + 1, f.doc_id, f.g, f.idx // {FAN}, sha256(s.before || f.cur || s.after),
    f.proof || s.before || s.after
  FROM {name} f JOIN {tree}_step s ON f.lvl = s.lvl AND f.g = s.g AND f.idx = s.idx),
{name}_end AS (
  SELECT * FROM {name} QUALIFY lvl = max(lvl) OVER (PARTITION BY doc_id)),
"""


_CRC32 = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(
      string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: CASE WHEN xor(c, x) & 1 = 1 THEN xor(xor(c, x) >> 1, 3988292384) ELSE xor(c, x) >> 1 END))"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {"op11_merkle": f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('s' || lang, 'n') AS g, {_leaf_sql('text')} AS node,
    CASE WHEN {_CRC32} % 3 = 0 THEN {_leaf_sql(_LOWER)} ELSE {_leaf_sql('text')} END AS seen
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, node) - 1 AS idx,
    count(*) OVER (PARTITION BY g) AS size FROM hashed),
{_tree_sql('tree', 'leaves')}
langs AS (
  SELECT '' AS g, g AS lang, node, row_number() OVER (ORDER BY CAST(g AS BLOB)) - 1 AS idx,
    count(*) OVER () AS size FROM tree WHERE size = 1),
{_tree_sql('top', 'langs')}
begin0 AS (SELECT doc_id, g, idx, seen AS cur, '' AS proof FROM leaves),
{_fold_sql('fold0', 'tree', 'begin0')}
begin1 AS (
  SELECT f.doc_id, l.g, l.idx, f.cur, f.proof FROM fold0_end f JOIN langs l ON f.g = l.lang),
{_fold_sql('fold1', 'top', 'begin1')}
root AS (SELECT node AS root FROM top WHERE size = 1)
SELECT l.doc_id, l.node AS leaf, s.node AS subroot, root, sha256(f.proof) AS proof_sha256,
  f.cur AS folded_root, f.cur = root AS verified
FROM leaves l JOIN fold1_end f ON l.doc_id = f.doc_id JOIN langs s ON l.g = s.lang CROSS JOIN root
"""}
