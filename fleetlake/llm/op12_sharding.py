"""Sharding by a hierarchical weighted hash tree.

A tree has regions of racks of shards; a node weighs what its shards weigh together. A key descends
from the root: at each level every child draws -ln(u) / weight, u in (0, 1) from the md5 of key and
child name, and the least draw wins (ties: the smaller name). A child wins in proportion to its
weight. When the weight of a node changes, the other draws at its level stay as they are, so keys move
only between that node and its neighbours; inside subtrees without a changed weight nothing moves.
``grow`` adds a shard as a region of its own: the only draw that is new is that region's, so the new
shard takes rows only into itself (the law ``key``: id and tree decide). A shard added inside an
existing rack would raise the weight of that rack and region too, and rows drawn into them could
reach their older shards.

The size of a row is the UTF-8 bytes of its text (null: none) plus 8. Slots are numbered from 0 in each
shard without gaps, in the order of doc_id, size and checksum (null ids first). Equal ids meet in one
shard; a null id is the key ''. Repeated rows are kept, each with a slot of its own. Texts are read
whole, where they are; only ids, sizes and checksums are shuffled, by range and salted among equal rows,
so a shard or an id with a third of all rows is spread over tasks. An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import table
from fleetlake.operators.batches import row_index

SHARDS = 24
SHARDS_PER_RACK = 4
RACKS_PER_REGION = 2
LAW = "key"

# region -> rack -> shard number -> weight
Tree = dict[str, dict[str, dict[int, float]]]


def make_tree(shards: int = SHARDS, per_rack: int = SHARDS_PER_RACK, per_region: int = RACKS_PER_REGION) -> Tree:
    """``shards`` shards of weight 1, filling racks and regions in turn."""
    tree: Tree = {}
    for s in range(shards):
        rack = s // per_rack
        tree.setdefault(f"region{rack // per_region}", {}).setdefault(f"rack{rack}", {})[s] = 1.0
    return tree


def grow(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, numbered next, in a region of its own."""
    s = 1 + max((s for racks in tree.values() for rack in racks.values() for s in rack), default=-1)
    return tree | {f"region-{s}": {f"rack-{s}": {s: weight}}}


def _descend(key: Column, children: Column) -> Column:
    """Of an array of children (name, weight, ...) the one with the least draw: -ln(u) / weight, u from the
    first 52 bits of the hash, moved off 0."""
    def draw(child: Column) -> Column:
        bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("/"), child["name"]).cast("binary")), 1, 13), 16, 10).cast("double")
        return F.struct((-F.log((bits + 0.5) / F.lit(2.0 ** 52)) / child["weight"]).alias("draw"), child["name"].alias("name"),
                        child.alias("child"))
    return F.array_min(F.transform(children, draw))["child"]


def _levels(tree: Tree) -> list[dict[str, list[tuple[str, float, int]]]]:
    """Per level, parent name -> its children (name, weight, shard or -1); weightless nodes can't be reached."""
    top, middle, low = {"": []}, {}, {}
    for region, racks in tree.items():
        for rack, shards in racks.items():
            low[f"{region}/{rack}"] = [(f"{region}/{rack}/{s}", float(w), s) for s, w in shards.items() if w > 0]
            weight = sum(w for _, w, _ in low[f"{region}/{rack}"])
            if weight > 0:
                middle.setdefault(region, []).append((f"{region}/{rack}", weight, -1))
        if region in middle:
            top[""].append((region, sum(w for _, w, _ in middle[region]), -1))
    if not top[""]:
        raise ValueError("the tree has no shard of positive weight")
    return [top, middle, low]


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard that ``key`` (a text without nulls) reaches in ``tree``."""
    at = None
    for level in _levels(tree):
        lists = {parent: F.array(*[F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight"), F.lit(s).alias("shard"))
                                   for n, w, s in children]) for parent, children in level.items() if children}
        if at is None:
            at = _descend(key, lists[""])
        else:
            below = F.create_map(*[x for parent, children in lists.items() for x in (F.lit(parent), children)])
            at = _descend(key, F.element_at(below, at["name"]))
    return at["shard"]


def deal(docs: DataFrame, tree: Tree, grown: Tree | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard) of every row."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), (F.octet_length(data) + F.lit(8)).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
                       shard_of(key, tree).alias("shard"), (shard_of(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"))
    # equal rows are interchangeable; the salt only lets a range border fall between them
    salted = rows.withColumn("__salt", F.xxhash64(F.monotonically_increasing_id()))
    order = [F.col("doc_id").asc_nulls_first(), "size", "text_crc32", "__salt"]
    return row_index(salted, order, index_col="slot", group=["shard"]).select(
        "doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23, and the shard of each if there were one more."""
    tree = make_tree()
    return deal(table(spark, sf_dir, "documents"), tree, grow(tree)).withColumn("law", F.lit(LAW))


def _draw_sql(name: str, weight: float) -> str:
    return f"-ln((('0x' || substr(md5(key || '/{name}'), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) / {weight}"


def tree_sql(tree: Tree) -> str:
    """DuckDB form of a descent: the draws of each level by a CASE over the level above."""
    def level(children: dict[str, tuple[float, str]]) -> str:
        rows = ", ".join(f"{{'draw': {_draw_sql(n, w)}, 'i': {i}}}" for i, (n, (w, _)) in enumerate(sorted(children.items())))
        cases = " ".join(f"WHEN {i} THEN {there}" for i, (_, (_, there)) in enumerate(sorted(children.items())))
        return next(iter(children.values()))[1] if len(children) == 1 else f"CASE list_min([{rows}]).i {cases} END"
    return level({r: (sum(sum(x.values()) for x in racks.values()), level({
        f"{r}/{k}": (sum(shards.values()), level({f"{r}/{k}/{s}": (w, str(s)) for s, w in shards.items()}))
        for k, shards in racks.items()})) for r, racks in tree.items()})


# crc32 by the byte rule; its 256 values are made by eight shifts each
ORACLE_SQL = f"""
WITH crc_table AS (
  SELECT list(list_reduce(list_prepend(n::BIGINT, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
  FROM range(256) r(n)
), d AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS key, encode(coalesce(text, '')) AS data FROM documents
), sized AS (
  SELECT doc_id, octet_length(data) + 8 AS size, {tree_sql(make_tree())} AS shard, {tree_sql(grow(make_tree()))} AS grown_shard,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(data)),
      lambda i: ('0x' || substr(hex(data), 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS text_crc32
  FROM d, crc_table
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard, grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
FROM sized
"""
