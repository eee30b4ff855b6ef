"""A manifest of rows as a hash tree, and proofs that descend through its content-addressed records."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.staging import settle

#: Bits of a rank's digit, and the consecutive nodes that one node covers.
BITS = 3
WIDTH = 1 << BITS
_STEP = "array<struct<before:string,after:string>>"


def digest(text: Column) -> Column:
    """Lowercase hex sha256 of the text's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(*columns: Column) -> Column:
    """Digest of the columns' values, each ``-`` if null, else its UTF-8 byte count, ``:``, itself."""
    parts = []
    for column in columns:
        value = column.cast("string")
        said = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(said, F.lit("-")))
    return digest(F.concat(*parts))


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows``, written, with column ``name``: the place from 0 on in its group by ``order``.

    Rows are sorted by ranges of group and order and numbered inside each task; what the ranges
    before hold of the group is added. So a group of any size is spread over tasks. Rows equal in
    ``order`` come in any order. Columns that start with ``_`` are used inside.
    """
    # equal rows are spread too: the last key tells them apart
    tie = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [group, *order, "_tie"]
    spread = tie.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    placed = settle(spread.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    held = placed.groupBy(F.col(group).alias("_group"), part.alias("_part")).agg(
        F.count("*").alias("_n"), F.min("_at").alias("_first")
    )
    # a group has at most one row here for each task of the sort
    held = held.select(
        "_group", "_part", "_first",
        F.expr("""coalesce(sum(_n) OVER (PARTITION BY _group ORDER BY _part
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)""").alias("_before"),
    )
    held = settle(held, "range_sizes")
    same = F.col(group).eqNullSafe(F.col("_group")) & (part == F.col("_part"))
    return (
        placed.join(held, same)
        .withColumn(name, F.col("_at") - F.col("_first") + F.col("_before"))
        .drop("_group", "_part", "_first", "_before", "_at")
    )


@dataclass
class Forest:
    """A tree for each group. ``roots(grp, height, digest)``; ``store[h]`` maps the digests of
    nodes at height h + 1 to their children: content-addressed, one record a digest."""

    roots: DataFrame
    store: list[DataFrame] = field(default_factory=list)


def build(leaves: DataFrame) -> Forest:
    """``leaves(grp, rank, digest)``, ranks from 0 on without gaps, gives each group's tree.

    While a group has several nodes, every ``WIDTH`` consecutive ones become their digests'
    digest. A level is an eighth of the one below and is written, so lost executors cost one level.
    """
    level = leaves.select("grp", "rank", "digest")
    sizes = settle(level.groupBy("grp").agg(F.count("*").alias("n")), "group_sizes")
    largest = sizes.agg(F.max("n")).first()[0] or 0
    sizes = sizes.withColumnRenamed("grp", "_grp")
    level = level.join(sizes, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")
    roots = level.where("n = 1").select("grp", F.lit(0).alias("height"), "digest")
    roots, store, height = settle(roots, "roots"), [], 0
    while largest > 1:
        height, largest = height + 1, (largest + WIDTH - 1) >> BITS
        several = (
            level.where("n > 1")
            .groupBy("grp", F.shiftright("rank", BITS).alias("up"), "n")
            .agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("below"))
        )
        nodes = several.select(
            "grp", F.col("up").alias("rank"), F.shiftright(F.col("n") + (WIDTH - 1), BITS).alias("n"),
            digest(F.concat_ws("", "below.digest")).alias("digest"),
            F.col("below.digest").alias("children"),
        )
        nodes = settle(nodes, f"nodes_{height}")
        # one record a digest: equal subtrees are one. Written, so that lookups can split hot digests
        records = nodes.groupBy("digest").agg(F.first("children").alias("children"))
        store.append(settle(records, f"records_{height}"))
        roots = roots.union(
            nodes.where("n = 1").select("grp", F.lit(height).alias("height"), "digest")
        )
        level = nodes.select("grp", "rank", "n", "digest")
    return Forest(roots, store)


def _unselected(digit: Column) -> Column:
    """The record's other children, those before the chosen one and those after it."""
    rest = F.greatest(F.size("children") - digit - 1, F.lit(0))
    return F.struct(
        F.concat_ws("", F.slice("children", F.lit(1), digit)).alias("before"),
        F.concat_ws("", F.slice("children", digit + 2, rest)).alias("after"),
    )


def descend(forest: Forest, requests: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """``requests(grp, rank, ...)`` with columns ``found``, the leaf there, and ``path``: for each
    height from the leaf to the root the unselected siblings' digests before and after.

    All requests start at their group's root and take one digit of their rank at each height, the
    first digit first. Requests with a common prefix of digits go as one row until they part, so
    the root is looked up once a group, not once a leaf. Each step looks the current digest up
    in the store and puts its siblings in front of the path: it was gathered from the root down
    and reads from the leaf up. ``above(grp, path)`` continues the path beyond a group's root.
    Requests beyond a group's leaves give no row.
    """
    start = forest.roots
    if above is None:
        start = start.withColumn("path", F.array().cast(_STEP))
    else:
        above = above.select(F.col("grp").alias("_grp"), "path")
        start = start.join(above, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")
    start = settle(start, "starts")
    current = None
    for height in range(len(forest.store), 0, -1):
        entering = start.where(F.col("height") == height).select(
            "grp", F.lit(0).cast("bigint").alias("prefix"), "digest", "path"
        )
        current = entering if current is None else current.unionByName(entering)
        opened = current.join(forest.store[height - 1], "digest")
        if height == 1:
            break
        wanted = requests.select(
            F.col("grp").alias("_grp"),
            F.shiftright("rank", BITS * (height - 1)).alias("_prefix"),
        ).distinct()
        steps = opened.select("*", F.posexplode("children").alias("digit", "child"))
        steps = steps.select(
            "grp", (F.shiftleft("prefix", BITS) + F.col("digit")).alias("prefix"),
            F.col("child").alias("digest"),
            F.concat(F.array(_unselected(F.col("digit"))), "path").alias("path"),
        )
        here = F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("prefix") == F.col("_prefix"))
        current = settle(steps.join(wanted, here, "left_semi"), f"descent_{height - 1}")
    # a lone leaf is its tree's root and has no siblings in it
    parents = start.where("height = 0").select(
        F.col("grp").alias("_grp"), F.lit(0).cast("bigint").alias("_up"),
        F.array("digest").alias("children"), "path", F.lit(True).alias("_lone"),
    )
    if current is not None:
        parents = parents.unionByName(
            opened.select(
                F.col("grp").alias("_grp"), F.col("prefix").alias("_up"), "children", "path",
                F.lit(False).alias("_lone"),
            )
        )
    digit = (F.col("rank") % WIDTH).cast("int")
    here = F.col("grp").eqNullSafe(F.col("_grp")) & (F.shiftright("rank", BITS) == F.col("_up"))
    return (
        requests.join(parents, here)
        .where(digit < F.size("children"))
        .select(
            *requests.columns, F.element_at("children", digit + 1).alias("found"),
            F.when(F.col("_lone"), F.col("path"))
            .otherwise(F.concat(F.array(_unselected(digit)), "path")).alias("path"),
        )
    )


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give. A node alone in its run is hashed alone."""
    return F.aggregate(
        path, leaf, lambda acc, x: digest(F.concat(x["before"], acc, x["after"]))
    )


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, left to right, from the leaf's level to the root's."""
    return digest(F.concat_ws("", F.transform(path, lambda x: F.concat(x["before"], x["after"]))))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of doc_id, source, lang, n_chars and text. Each lang has a tree over its
    leaves by doc_id (null first; repeated ids by their leaves), and a tree over the
    langs' roots (null first, then bytewise) gives the root of all. For ids whose unsigned crc32 as
    decimal text is divisible by 3 the text's A-Z are lower-cased before the proof is checked;
    ``folded_root`` is what that leaf and the original siblings give, and
    ``verified`` tells whether it is the root. Null ids and null texts are not tampered with.
    Repeated rows are leaves of their own; other columns are ignored; an empty table gives no rows.
    """
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = docs.select(
        "doc_id", F.col("lang").alias("grp"), leaf_digest(*fields, F.col("text")).alias("digest"),
        F.when(hit, leaf_digest(*fields, lower)).alias("tampered"),
    )
    # written first: the ranges are sampled from it, and texts are hashed once
    leaves = settle(leaves, "leaves")
    rows = settle(ranked(leaves, "grp", ["doc_id", "digest"], "rank"), "ranked_leaves")
    forest = build(rows)
    tops = forest.roots.select(F.lit(0).alias("all"), F.col("grp").alias("lang"), "digest")
    tops = settle(ranked(tops, "all", ["lang"], "rank"), "ranked_langs")
    tops = tops.withColumnRenamed("all", "grp")
    crown = build(tops)
    root = crown.roots.select(F.col("digest").alias("root"))
    lang_paths = descend(crown, tops).select(
        F.col("lang").alias("grp"), F.col("found").alias("subroot"), "path"
    )
    return _checked(forest, rows, settle(lang_paths, "lang_paths"), root)


def _checked(forest: Forest, rows: DataFrame, lang_paths: DataFrame, root: DataFrame) -> DataFrame:
    proven = descend(forest, rows, lang_paths)
    subroots = lang_paths.select(F.col("grp").alias("_grp"), "subroot")
    top = root.first()
    top = top["root"] if top else None
    judged = proven.join(subroots, F.col("grp").eqNullSafe(F.col("_grp"))).select(
        "doc_id", F.col("found").alias("leaf"), "subroot", F.lit(top).cast("string").alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("tampered", "digest"), F.col("path")).alias("folded_root"),
    )
    return judged.withColumn("verified", F.col("folded_root") == F.col("root"))
