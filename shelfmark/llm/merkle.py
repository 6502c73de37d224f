"""Merkle manifest of a dataset: trees of runs of eight, built and proven by equijoins.

Every level is a table of nodes ``tree, index, nodes, digest``.  The node in slot
zero of a run finds its siblings by joining the level with itself at the sibling's
index, which is its own plus the slot; it then emits the parent.  A tree is done
where one node remains, so trees of any sizes are built together, in as many joins
as the tallest has levels.  Proofs go down again: each level takes its path from
its parents, so only the run above a leaf and its path ever meet the leaf.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import stored, table
from shelfmark.llm.registry import query
from shelfmark.operators.ranks import ranked_within

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the strings put together."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` of a null, else the UTF-8 byte count, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def parents(nodes: DataFrame, fan: int = FAN) -> DataFrame:
    """The next level above ``nodes(tree, index, nodes, digest)``, with the ``children`` of each node."""
    slot = F.pmod("index", F.lit(fan))
    runs = nodes.filter(slot == 0).select("tree", "index", "nodes", F.col("digest").alias("d0"))
    for shift in range(1, fan):
        sibling = nodes.filter(slot == shift).select(
            "tree", (F.col("index") - shift).alias("index"), F.col("digest").alias(f"d{shift}")
        )
        runs = runs.join(sibling, ["tree", "index"], "left")
    found = [F.col(f"d{k}") for k in range(fan)]
    return runs.select(
        "tree",
        F.expr(f"`index` div {fan}").alias("index"),
        F.ceil(F.col("nodes") / fan).alias("nodes"),
        F.array_compact(F.array(*found)).alias("children"),
        F.sha2(F.concat_ws("", *found), 256).alias("digest"),
    )


def levels(leaves: DataFrame, fan: int = FAN) -> list[DataFrame]:
    """``leaves(tree, index, nodes, digest)`` and every level above them, up to the last root."""
    found = [leaves]
    while not (rest := found[-1].filter("nodes > 1")).isEmpty():
        found.append(stored(parents(rest.select("tree", "index", "nodes", "digest"), fan), "nodes"))
    return found


def roots(found: Sequence[DataFrame]) -> DataFrame:
    """``tree, digest`` of the node that remains of each tree."""
    each = [level.filter("nodes = 1").select("tree", "digest") for level in found]
    out = each[0]
    for more in each[1:]:
        out = out.unionByName(more)
    return out


def with_paths(found: Sequence[DataFrame], above: DataFrame, fan: int = FAN) -> DataFrame:
    """The leaves with ``path``: what comes before and after the node in each run, from the leaf up.

    ``above(tree, path, ...)`` is where the trees end; its path follows that of
    the tree and its other columns are added to every leaf.
    """
    carried = [c for c in above.columns if c not in ("tree", "path")]
    slot = F.pmod("index", F.lit(fan)).cast("int")
    step = F.struct(
        F.array_join(F.slice("_brothers", F.lit(1), slot), "").alias("before"),
        F.array_join(F.slice("_brothers", slot + 2, F.lit(fan)), "").alias("after"),
    )
    held = None
    for level in reversed(found):
        out = level.filter("nodes = 1").join(above, "tree").select(*level.columns, "path", *carried)
        if held is not None:
            runs = held.select("tree", F.col("index").alias("_run"), F.col("children").alias("_brothers"), "path", *carried)
            inner = level.filter("nodes > 1").withColumn("_run", F.expr(f"`index` div {fan}"))
            path = F.concat(F.array(step), F.col("path")).alias("path")
            out = out.unionByName(inner.join(runs, ["tree", "_run"]).select(*level.columns, path, *carried))
        held = out
    return held


def manifest(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, leaf, altered_leaf, subroot, root, path``.

    ``FIELDS`` are hashed; the rows of a ``lang`` make a tree in order of
    ``doc_id``, and the roots of all trees, in order of ``lang``, make the tree
    above.  ``altered`` is a text that is to be held against the manifest:
    ``altered_leaf`` is the leaf with it, or null where it is null.

    Nulls are values of their own: a null ``lang`` is a tree and the first one, a
    null ``doc_id`` comes first in its tree.  Rows with one ``doc_id`` follow
    each other in order of their hash, and equal rows each have a leaf.  Other
    columns are ignored, and an empty table gives no rows.
    """
    fields = {c: field(F.col(c)) for c in FIELDS}
    other = F.lit(None).cast("string")
    if altered is not None:
        other = F.when(altered.isNotNull(), digest(*(fields | {"text": field(altered)}).values()))
    lang = F.col("lang").cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), lang), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        digest(*fields.values()).alias("digest"),
        other.alias("altered_leaf"),
    )
    found = levels(ranked_within(leaves, ["tree"], ["doc_id", "digest"], "index", total="nodes"))
    tops = roots(found).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    upper = levels(stored(ranked_within(tops, ["tree"], ["name"], "index", total="nodes"), "tops"))
    top = roots(upper).select("tree", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    ends = with_paths(upper, top).select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    out = with_paths(found, stored(ends, "ends"))
    return out.select("doc_id", F.col("digest").alias("leaf"), "altered_leaf", "subroot", "root", "path")


def proof(path: str = "path") -> Column:
    """All siblings of a path, from the leaf up and left to right."""
    return F.array_join(F.transform(path, lambda run: F.concat(run["before"], run["after"])), "")


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that follows from a leaf and the siblings of its path."""
    return F.aggregate(path, leaf, lambda node, run: digest(run["before"], node, run["after"]))


def _sql_leaf(text: str) -> str:
    values = [f"{c if c != 'text' else text}::varchar" for c in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({v})::varchar || ':' || {v}, '-')" for v in values) + ")"


# One bit at a time: a byte enters with its first bit, then seven zeros.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
      range(1, length(doc_id::varchar) + 1),
      lambda i: [ascii(substr(doc_id::varchar, i, 1))::bigint, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)))"""
_ORACLE = f"""
with recursive docs as (
  select *, {_sql_leaf("text")} leaf, case when text is not null and {_CRC} % 3 = 0
    then {_sql_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} end altered
  from documents),
leaves as (
  select row_number() over () - 1 id, coalesce('=' || lang, '') tree, doc_id, leaf, altered,
    row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 i, count(*) over (partition by lang) n
  from docs),
nodes(tree, level, i, n, d, kids) as (
  select tree, 0, i, n, leaf, []::varchar[] from leaves
  union all
  select tree, level + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(d, '' order by i)), list(d order by i)
  from nodes where n > 1 group by tree, level, i // 8),
subroots as (
  select tree, d subroot, row_number() over (order by tree) - 1 i, count(*) over () n from nodes where n = 1),
tops(level, i, n, d, kids) as (
  select 0, i, n, subroot, []::varchar[] from subroots
  union all
  select level + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(d, '' order by i)), list(d order by i)
  from tops where n > 1 group by level, i // 8),
runs as (
  select l.id, k.level step, k.kids, (l.i // (8 ** (k.level - 1))::bigint) % 8 slot
  from leaves l join nodes k on k.tree = l.tree and k.level > 0 and k.i = l.i // (8 ** k.level)::bigint
  union all
  select l.id, 1000 + t.level, t.kids, (s.i // (8 ** (t.level - 1))::bigint) % 8
  from leaves l join subroots s on s.tree = l.tree
  join tops t on t.level > 0 and t.i = s.i // (8 ** t.level)::bigint),
paths as (
  select id, list({{'b': array_to_string(kids[1:slot], ''), 'a': array_to_string(kids[slot + 2:8], '')}} order by step) p
  from runs group by id),
folds as (
  select l.*, s.subroot, t.d root, coalesce(p.p, []) p
  from leaves l join subroots s on s.tree = l.tree join tops t on t.n = 1 left join paths p on p.id = l.id),
checked as (
  select *, list_reduce(list_prepend({{'b': '', 'a': coalesce(altered, leaf)}}, p),
    lambda x, r: {{'b': '', 'a': sha256(r.b || x.a || r.a)}}).a folded_root from folds)
select doc_id, leaf, subroot, root,
  sha256(array_to_string(list_transform(p, lambda r: r.b || r.a), '')) proof_sha256,
  folded_root, folded_root = root verified
from checked
"""


@query(_ORACLE)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    lowered = F.when(third, F.translate("text", _UPPER, _LOWER))
    out = manifest(table(spark, sf_dir, "documents"), lowered)
    back = folded(F.coalesce("altered_leaf", "leaf"))
    out = out.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof(), 256).alias("proof_sha256"), back.alias("folded_root")
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
