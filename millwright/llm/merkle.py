"""A Merkle manifest of a table by slot pivots: leaves, group roots, one root, and an inclusion proof per row.

Rows of a group are leaves in order; ``fanout`` consecutive nodes make a parent, level by level, until one node is
left, the group's subroot. The subroots, in order of their groups, make the root in the same way.

A level is one aggregation: conditional aggregates spread the children of a parent into ``fanout`` columns. The
columns in a row give the parent's digest; the columns but a child's own are its siblings. Going down again, a
family row hands every child the siblings found on the way from the root, so a proof is never searched for.

Positions come from a range sort, which splits a hot group like any other rows, and from the rows counted per sorted
partition. Everything is DataFrame functions; each level is written, so a lost executor costs one level at most.

Defined results: null fields are ``-``; a null group is the first group; rows of one order value go by their digest,
so repeated rows stand side by side; a null order value comes first. An empty table gives no rows. Other columns
of the input, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.session import written

FANOUT = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the bytes of the value in UTF-8, a colon, and the value; integers in decimal."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _group(value: Column) -> Column:
    """A text that keeps the order of groups and puts null first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (key, at, digest, item) with ``i``, the place in the key by (at, digest), and ``n``, the key's rows."""
    rows = written(rows, "merkle-leaves").withColumn("_tie", F.monotonically_increasing_id())
    rows = rows.orderBy("key", "at", "digest", "_tie").drop("at", "_tie")
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "merkle-order")
    rows = rows.withColumn("_part", F.expr("shiftright(_row, 33)"))  # the sorted partition
    parts = rows.groupBy("key", "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy("key")  # a row for each partition that holds the key
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "key", "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(whole).alias("n")
    )
    return rows.join(parts, ["key", "_part"]).select("key", (F.col("_row") + F.col("_shift")).alias("i"), "n", "digest", "item")


class Tree:
    """The levels of the trees of all keys: ``families`` has a row per parent, ``tops`` the finished nodes by level."""

    def __init__(self, nodes: DataFrame, fanout: int):
        self.fanout, self.families, self.tops = fanout, [], [nodes.where("n = 1")]
        largest = nodes.agg(F.max("n")).first()[0] or 0
        while largest > 1:
            carried = [c for c in ("digest", "item") if c in nodes.columns]
            slot = F.col("i") % fanout
            pivot = [F.first(F.when(slot == j, F.col(c)), ignorenulls=True).alias(f"{c}{j}") for j in range(fanout) for c in carried]
            parents = nodes.where("n > 1").groupBy("key", F.floor(F.col("i") / F.lit(fanout)).alias("p"))
            self.families.append(written(parents.agg(F.max("n").alias("n"), *pivot), "merkle-level"))
            nodes = self.families[-1].select(
                "key", F.col("p").alias("i"), F.ceil(F.col("n") / F.lit(fanout)).alias("n"), F.sha2(self._joined(range(fanout)), 256).alias("digest")
            )
            self.tops.append(nodes.where("n = 1"))
            largest = -(-largest // fanout)

    def _joined(self, slots: Sequence[int]) -> Column:
        return F.concat(F.lit(""), *(F.coalesce(F.col(f"digest{j}"), F.lit("")) for j in slots))

    def roots(self) -> DataFrame:
        """(key, digest) of the one node left of each key."""
        return reduce(DataFrame.unionByName, [t.select("key", "digest") for t in self.tops])

    def paths(self, above: DataFrame) -> DataFrame:
        """(item, path, top) per leaf: ``above`` (key, path, top) continues the path beyond each key's root."""
        seed = lambda level, *more: self.tops[level].join(above, "key").select("key", "i", "path", "top", *more)
        ways = seed(len(self.tops) - 1, *(["item"] if not self.families else []))
        for level in range(len(self.families) - 1, -1, -1):
            more = ["item"] if not level else []
            step = lambda j: F.struct(self._joined(range(j)).alias("before"), self._joined(range(j + 1, self.fanout)).alias("after"))
            child = lambda j: F.struct(
                (F.col("p") * self.fanout + j).alias("i"), F.concat(F.array(step(j)), F.col("path")).alias("path"), *(F.col(f"{c}{j}").alias(c) for c in ("digest", *more))
            )
            family = self.families[level].join(ways.withColumnRenamed("i", "p"), ["key", "p"])
            children = F.filter(F.array(*map(child, range(self.fanout))), lambda x: x["digest"].isNotNull())
            down = family.select("key", "top", F.inline(children)).select("key", "i", "path", "top", *more)
            ways = down.unionByName(seed(level, *more))
        return ways.select("item", "path", "top")


def proofs(
    docs: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    columns: Sequence[str] = COLUMNS,
    group: str = "source",
    order: str = "doc_id",
    changed: dict[str, Column] | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """``keys``, leaf, subroot, root, path, changed_leaf per row of ``docs``.

    path lists (before, after) from the leaf's family to the root: the siblings' digests on either side.
    ``changed`` replaces columns by expressions over ``docs``; changed_leaf is the digest of the row so changed,
    null where it equals the leaf.
    """
    leaf = leaf_digest([F.col(c) for c in columns])
    other = leaf_digest([(changed or {}).get(c, F.col(c)) for c in columns])
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(v) for c, v in (changed or {}).items()], F.lit(False))
    item = F.struct(F.struct(*keys).alias("keys"), F.when(differs, other).alias("changed"))
    rows = docs.select(_group(F.col(group)).alias("key"), F.col(order).alias("at"), leaf.alias("digest"), item.alias("item"))
    # the leaf stands in the item too, for the result
    rows = rows.withColumn("item", F.struct("item.keys", "item.changed", F.col("digest").alias("leaf")))
    groups = Tree(_ranked(rows), fanout)
    subroots = groups.roots().select(F.lit("").alias("key"), F.col("key").alias("at"), "digest", F.struct("key", "digest").alias("item"))
    whole = Tree(_ranked(subroots), fanout)
    start = whole.roots().select("key", F.expr(f"cast(array() as {_PATH})").alias("path"), F.col("digest").alias("top"))
    to_root = whole.paths(start)
    above = to_root.select(F.col("item.key").alias("key"), "path", F.struct(F.col("item.digest").alias("subroot"), F.col("top").alias("root")).alias("top"))
    found = groups.paths(written(above, "merkle-groups"))
    return found.select("item.keys.*", "item.leaf", "top.subroot", "top.root", "path", F.col("item.changed").alias("changed_leaf"))


def proof_text(path: Column) -> Column:
    """The siblings' digests, level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda digest, x: F.sha2(F.concat(x["before"], digest, x["after"]), 256))


def without_line_breaks(order: str = "doc_id", text: str = "text") -> dict[str, Column]:
    """The change that a check plants: rows whose CRC-32 of the decimal id is even lose the line breaks of their text."""
    even = F.crc32(F.col(order).cast("string").cast("binary")) % 2 == 0
    return {text: F.when(even, F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text))}


def verified(docs: DataFrame, changed: dict[str, Column] | None = None) -> DataFrame:
    """Digests per document, and whether the row as ``changed`` still leads to the root through its original siblings."""
    found = proofs(docs, changed=without_line_breaks() if changed is None else changed)
    now = folded(F.coalesce("changed_leaf", "leaf"), F.col("path"))
    found = found.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"), now.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
