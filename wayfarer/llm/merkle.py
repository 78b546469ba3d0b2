"""Merkle manifest of a table: a hash tree per group, and one over the groups.

Method: concatenated-level strings.  A group's leaves are dealt into aligned
blocks of ``run ** levels`` consecutive leaves.  A block keeps each of its levels
as one string of hexadecimal digests; the parents are the digests of its
fixed-width substrings, and the siblings of a node on its way up are the
substrings that flank it in its run.  The blocks' roots are the leaves of the
next tier, until one node is left.  No task holds more than one block, and a
third of all rows in one group is a matter of more blocks.

Everything is SQL functions.  Defined cases: a null field hashes as ``-``; a null
group is a group of its own and comes first; leaves ascend by the key (null
first), then by digest, so repeated rows are repeated leaves and each gets its own
path; an empty table gives no rows; other columns of the table are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.llm.common import stored

#: Hexadecimal digits of a SHA-256 digest.
WIDTH = 64
#: One level of a path: the digests before and after the node in its run, as text.
PATH = "array<struct<before:string,after:string>>"
_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id: the row's number inside its partition


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def row_digest(fields: list[Column]) -> Column:
    """Digest of a row: each field as ``-`` if null, else UTF-8 byte count, colon, value."""
    texts = [c.cast("string") for c in fields]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def fold(path: Column, leaf: Column) -> Column:
    """The root that ``leaf`` leads to along ``path``."""
    return F.aggregate(path, leaf, lambda node, p: digest(F.concat(p["before"], node, p["after"])))


def path_digest(path: Column) -> Column:
    """Digest of all siblings, leaf level first."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), ""))


def _placed(rows: DataFrame) -> DataFrame:
    """``rows(g, k, digest, item)`` with ``pos``, the place in its group, and ``total``, the group's size.

    A range partitioning cuts the order (g, k, digest, uid), so the rows of a large
    group, of one key or of one digest spread; counts by partition give the rest.
    """
    spark = rows.sparkSession
    order = ["g", "k", "digest", "uid"]
    rows = stored(rows.withColumn("uid", F.monotonically_increasing_id()), "merkle-leaves")
    rows = (rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
            .withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))))
    rows = stored(rows, "merkle-order")
    spans = rows.groupBy("g", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    group = Window.partitionBy("g")
    before = F.coalesce(F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select(F.col("g").alias("sg"), F.col("part").alias("sp"), (before - F.col("first")).alias("shift"),
                         F.sum("n").over(group).alias("total"))
    joined = rows.join(spans, F.col("g").eqNullSafe(F.col("sg")) & (F.col("part") == F.col("sp")))
    return joined.select("g", (F.col("row") + F.col("shift")).alias("pos"), "total", "digest", "item")


def _parents(level: Column, run: int) -> Column:
    """The level above: digests of ``run`` nodes each, of fewer at the end."""
    width = WIDTH * run
    runs = F.ceil(F.length(level) / width).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda i: digest(F.substring(level, i * width + 1, F.lit(width)))),
                        "").cast("binary")


def _blocks(nodes: DataFrame, run: int, levels: int) -> DataFrame:
    """One row per aligned block: its items in order, its levels as strings (bottom first), its root.

    ``blocks`` is the number of blocks in the group.  A group of one block ends at
    its single node; blocks beside others all rise by ``levels``, the last one too.
    """
    size = run ** levels
    block = F.floor(F.col("pos") / size)
    items = F.array_sort(F.collect_list(F.struct("pos", "digest", "item")))
    grown = (nodes.groupBy("g", block.alias("block")).agg(items.alias("items"), F.first("total").alias("total"))
             .withColumn("blocks", F.ceil(F.col("total") / size))
             .withColumn("bottom", F.array_join(F.transform("items", lambda x: x["digest"]), "").cast("binary")))
    more = (F.col("blocks") > 1)
    rise = F.aggregate(
        F.sequence(F.lit(1), F.lit(levels)), F.array("bottom").cast("array<binary>"),
        lambda done, _: F.when(more | (F.length(F.element_at(done, -1)) > WIDTH),
                               F.concat(done, F.array(_parents(F.element_at(done, -1), run)))).otherwise(done))
    return grown.withColumn("levels", rise).select(
        "g", "block", "blocks", "items", "levels", F.element_at("levels", -1).cast("string").alias("root"))


def _path(levels: Column, pos: Column, run: int) -> Column:
    """Flanking substrings of the node at ``pos`` on every level but the root's."""
    def step(level: Column, i: Column) -> Column:
        at = F.floor(pos / F.pow(F.lit(float(run)), i)).cast("int")
        start = F.floor(at / run).cast("int") * run
        return F.struct(F.substring(level, start * WIDTH + 1, (at - start) * WIDTH).cast("string").alias("before"),
                        F.substring(level, (at + 1) * WIDTH + 1, (start + run - 1 - at) * WIDTH).cast("string").alias("after"))
    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), step)


def _rise(nodes: DataFrame, run: int, levels: int) -> list[DataFrame]:
    """Tiers of blocks over ``nodes(g, pos, total, digest, item)``, the last with one block a group."""
    tiers = []
    while True:
        blocks = stored(_blocks(nodes, run, levels), "merkle-blocks")
        tiers.append(blocks)
        if (blocks.agg(F.max("blocks")).first()[0] or 0) <= 1:
            return tiers
        nodes = blocks.select("g", F.col("block").alias("pos"), F.col("blocks").alias("total"), F.col("root").alias("digest"),
                              F.struct("block").alias("item"))


def _descend(tiers: list[DataFrame], above: DataFrame, run: int, levels: int) -> DataFrame:
    """Paths of all nodes, from ``above(g, path, root)``, the ways on from the groups' roots: (g, digest, item, path, subroot, root).

    Each join is between blocks, one row a key on both sides.
    """
    top = above.select(F.col("g").alias("ag"), F.lit(0).cast("long").alias("ab"), F.col("path").alias("apath"),
                       F.lit(None).cast("string").alias("asub"), F.col("root").alias("aroot"))
    for blocks in reversed(tiers):
        offset = F.col("x.pos") % (run ** levels)
        opened = (blocks.join(top, F.col("g").eqNullSafe(F.col("ag")) & (F.col("block") == F.col("ab")))
                  .select("g", "levels", "apath", F.coalesce("asub", blocks["root"]).alias("asub"), "aroot", F.explode("items").alias("x"))
                  .select("g", F.col("x.digest").alias("digest"), F.col("x.item").alias("item"),
                          F.concat(_path(F.col("levels"), offset, run).cast(PATH), F.col("apath")).alias("path"),
                          F.col("asub").alias("subroot"), F.col("aroot").alias("root")))
        if blocks is not tiers[0]:
            top = opened.select(F.col("g").alias("ag"), F.col("item.block").alias("ab"), F.col("path").alias("apath"),
                                F.col("subroot").alias("asub"), F.col("root").alias("aroot"))
    return opened


def manifest(docs: DataFrame, fields: list[str], group: str, key: str, carry: dict[str, Column] | None = None,
             run: int = 2, levels: int = 10) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``group``, ``carried`` (a struct of the columns in ``carry``), ``leaf``,
    ``subroot`` (of its group), ``root`` and ``path`` from the leaf to the root.

    Leaves hash the columns ``fields`` in order.  In each group they ascend by
    ``key``; every ``run`` consecutive nodes make a parent until one is left.  The
    groups' roots, ordered by group (null first, bytewise), make ``root`` in the same way.
    """
    def q(c: str) -> Column:
        return F.col(f"`{c}`")
    carried = F.struct(*[c.alias(n) for n, c in (carry or {"nothing": F.lit(None).cast("string")}).items()])
    rows = docs.select(q(group).alias("g"), q(key).alias("k"), row_digest([q(c) for c in fields]).alias("digest"),
                       F.struct(q(key).alias("key"), carried.alias("carried")).alias("item"))
    inner = _rise(_placed(rows), run, levels)
    subroots = inner[-1].select(F.lit(0).alias("g"), F.col("g").alias("k"), F.col("root").alias("digest"), F.struct("g").alias("item"))
    outer = _rise(_placed(subroots), run, levels)
    ends = outer[-1].select("g", F.array().cast(PATH).alias("path"), "root")
    ways = stored(_descend(outer, ends, run, levels).select(F.col("item.g").alias("g"), "path", "root"), "merkle-groups")
    return _descend(inner, ways, run, levels).select(
        F.col("item.key").alias("key"), F.col("g").alias("group"), F.col("item.carried").alias("carried"),
        F.col("digest").alias("leaf"), "subroot", "root", "path")


def verify_documents(docs: DataFrame, run: int = 2, levels: int = 10) -> DataFrame:
    """Manifest of a documents table, checked against a tampered copy.

    The copy adds 1 to ``n_chars`` where 7 divides the CRC-32 of the decimal
    ``doc_id`` (null ids and null counts stay as they are).  ``folded_root`` is what
    the copy's leaf leads to along the manifest's path; ``verified`` compares it with the root.
    """
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    copy = row_digest([F.when(touched, F.col("n_chars") + 1).otherwise(F.col("n_chars")) if c == "n_chars" else F.col(c) for c in fields])
    made = manifest(docs, fields, "lang", "doc_id", {"claimed": copy}, run, levels)
    folded = made.withColumn("folded_root", fold(F.col("path"), F.col("carried.claimed")))
    return folded.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: DuckDB SQL for ``verify_documents`` with runs of two.
ORACLE_SQL = """
with recursive d as (
  select row_number() over () as rid, doc_id, lang,
    list_transform([n_chars, n_chars + case when doc_id is not null and xor(list_reduce(
      list_concat([4294967295::bigint], list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii(substr(doc_id::varchar, i, 1))::bigint)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
        lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) % 7 = 0 then 1 else 0 end],
      lambda n: sha256(concat(coalesce(strlen(doc_id::varchar)::varchar || ':' || doc_id::varchar, '-'),
                       coalesce(strlen(source)::varchar || ':' || source, '-'), coalesce(strlen(lang)::varchar || ':' || lang, '-'),
                       coalesce(strlen(n::varchar)::varchar || ':' || n::varchar, '-'), coalesce(strlen(text)::varchar || ':' || text, '-')))) as leaves
  from documents),
placed as (
  select rid, doc_id, lang, leaves[1] as leaf, leaves[2] as claimed, count(*) over (partition by lang) as n,
    row_number() over (partition by lang order by doc_id nulls first, leaves[1], rid) - 1 as pos from d),
up as (
  select lang, 0 as lvl, pos, leaf as h, n from placed
  union all
  select lang, lvl + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (n + 1) // 2 from up where n > 1 group by lang, lvl, pos // 2, n),
subs as (
  select lang, h as subroot, row_number() over (order by encode(lang) nulls first) - 1 as pos, count(*) over () as n from up where n = 1),
top as (
  select 0 as lvl, pos, subroot as h, n from subs
  union all
  select lvl + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (n + 1) // 2 from top where n > 1 group by lvl, pos // 2, n),
steps as (
  select p.rid, a.lvl, case when s.pos is null then '-' when s.pos < a.pos then 'L' || s.h else 'R' || s.h end as step
  from placed p join up a on a.lang is not distinct from p.lang and a.n > 1 and a.pos = p.pos >> a.lvl
  left join up s on s.lang is not distinct from a.lang and s.lvl = a.lvl and s.pos = xor(a.pos, 1::bigint)
  union all
  select p.rid, 1000 + a.lvl, case when s.pos is null then '-' when s.pos < a.pos then 'L' || s.h else 'R' || s.h end
  from placed p join subs u on u.lang is not distinct from p.lang join top a on a.n > 1 and a.pos = u.pos >> a.lvl
  left join top s on s.lvl = a.lvl and s.pos = xor(a.pos, 1::bigint)),
ways as (select rid, list(step order by lvl) as way from steps group by rid),
done as (
  select doc_id, leaf, subroot, (select h from top where n = 1) as root,
    sha256(list_aggregate(list_concat([''], list_transform(coalesce(way, []), lambda x: x[2:])), 'string_agg', '')) as proof_sha256,
    list_reduce(list_concat([claimed], coalesce(way, [])), lambda node, x: case when x[1] = 'L' then sha256(x[2:] || node)
      when x[1] = 'R' then sha256(node || x[2:]) else sha256(node) end) as folded_root
  from placed p join subs on subs.lang is not distinct from p.lang left join ways using (rid))
select *, folded_root = root as verified from done"""
