"""A Merkle manifest of a table of documents, by nested-interval labels.

A leaf is the digest of one row. Per language the leaves, by ascending ``doc_id``, are
numbered without a task that sees them all (``operators.sequence``). Every node carries the
interval [lo, hi) of leaf numbers that it covers. Eight nodes in a row become a parent, level
by level, so a level is one grouping by (tree, lo / 8^level) of groups of at most eight
rows. What is left of each language is a leaf of one more tree, the languages' tree.

Proofs go top down. At each level nodes join the parents of their bucket (tree, lo /
8^(level+1)) whose interval contains theirs; within the parent's interval, what lies before
the node's own are the siblings on the left, what lies behind those on the right. A parent
hands its own path down, so a document joins once, with its first parent.

A null in any column is written as ``-``. Rows of one language and id follow each other by
leaf digest; equal rows have the same digest and each its own place. Null ids and the null
language come first, languages are ordered by their bytes. The only leaf of a language is its
subroot, the only subroot the root; a document without siblings on any level has the digest
of nothing as its proof. A null id or text is not tampered with. Texts of any length are
digested whole; other columns, whatever their names, do not matter, and an empty table gives
no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.operators.sequence import numbered

#: Children of a node.
WIDTH = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows are tampered with where this divides crc32 of the decimal id.
TAMPER = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def written(value: Column) -> Column:
    """How a value enters a leaf: its bytes after their count, a null as ``-``."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(values: dict[str, Column]) -> Column:
    """The digest of a row, in hex."""
    return F.sha2(F.concat(*[written(values[name]) for name in FIELDS]), 256)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``leaf`` and ``shown``, the leaf that a verifier is shown: of the
    row with tampered text where the row is tampered with."""
    values = {name: F.col(f"`{name}`") for name in FIELDS}
    values |= {name: values[name].cast("bigint") for name in ("doc_id", "n_chars")}
    touched = F.coalesce(F.crc32(values["doc_id"].cast("string")) % TAMPER == 0, F.lit(False))
    # Texts without a capital letter are the same after tampering: one digest does.
    changed = touched & F.coalesce(values["text"].rlike("[A-Z]"), F.lit(False))
    leaf = leaf_of(values)
    shown = F.when(changed, leaf_of({**values, "text": ascii_lower(values["text"])}))
    return docs.select(
        values["doc_id"].alias("doc_id"), values["lang"].cast("string").alias("lang"),
        leaf.alias("leaf"), shown.alias("shown")).withColumn(
        "shown", F.coalesce("shown", "leaf"))


def _bucket(level: int) -> Column:
    """Which interval of ``WIDTH ** level`` leaves of its tree a node begins in."""
    return F.expr(f"(lo - tree) div {WIDTH ** level}")


def _whole() -> Column:
    """A node that covers its tree is the tree's root."""
    return (F.col("lo") == F.col("tree")) & (F.col("hi") == F.col("stop"))


def _parents(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes of ``level`` over those of the level below: their interval, digest and children."""
    grouped = nodes.groupBy("tree", "stop", _bucket(level).alias("bucket")).agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"))
    joined = F.array_join(F.transform("children", lambda c: c["digest"]), "")
    return grouped.select(
        "tree", "stop", F.element_at("children", 1)["lo"].alias("lo"),
        F.element_at("children", -1)["hi"].alias("hi"), F.sha2(joined, 256).alias("digest"),
        "children")


def forest(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The roots (tree, level, digest) of all trees over leaves (tree, stop, lo, hi, digest),
    and the levels from the first parents up, each written.

    ``tree`` and ``stop`` are the interval of the tree's leaves.
    """
    largest = nodes.agg(F.max(F.col("stop") - F.col("tree"))).first()[0] or 0
    levels: list[DataFrame] = []
    below, roots = nodes, []
    while True:
        roots.append(below.filter(_whole()).select(
            "tree", F.lit(len(levels)).alias("level"), "digest"))
        if largest <= 1:
            break
        largest = -(-largest // WIDTH)
        levels.append(stored(_parents(below.filter(~_whole()), len(levels) + 1),
                             f"level-{len(levels) + 1}"))
        below = levels[-1]
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return stored(found, "roots"), levels


def _attached(nodes: DataFrame, parents: DataFrame, level: int) -> DataFrame:
    """``nodes`` with the ``path`` and the ``top`` of the parents (of ``level``) that contain
    them; the path begins with their own siblings."""
    above = parents.select(
        F.col("tree").alias("of"), _bucket(level).alias("at"), F.col("lo").alias("from"),
        F.col("hi").alias("to"), F.col("children").alias("family"), "path", "top")
    inside = ((F.col("tree") == F.col("of")) & (_bucket(level) == F.col("at"))
              & (F.col("from") <= F.col("lo")) & (F.col("hi") <= F.col("to")))
    joined = nodes.join(above, inside)

    def beside(outside) -> Column:
        kept = F.filter("family", outside)
        return F.array_join(F.transform(kept, lambda c: c["digest"]), "")
    siblings = F.struct(beside(lambda c: c["hi"] <= F.col("lo")).alias("left"),
                        beside(lambda c: c["lo"] >= F.col("hi")).alias("right"))
    return joined.select(*nodes.columns,
                         F.concat(F.array(siblings), "path").alias("path"), "top")


def proofs(leaves_: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``leaves_`` (tree, stop, lo, hi, ...) with ``path``, the siblings (left, right) of each
    level up to the end of the tree's own path, and ``top``.

    ``tops`` (tree, level, path, top) has the path that goes on from each tree's root.
    """
    def ends(nodes: DataFrame, level: int) -> DataFrame:
        # One node of a tree begins where the tree does, so few rows are joined by tree.
        of = tops.filter(F.col("level") == level).select(
            F.col("tree").alias("of"), "path", "top")
        return nodes.filter(_whole()).join(of, F.col("tree") == F.col("of")).drop("of")
    found = None
    for level in range(len(levels), -1, -1):
        nodes = levels[level - 1] if level else leaves_
        done = ends(nodes, level)
        if found is not None:
            done = _attached(nodes.filter(~_whole()), found, level + 1).unionByName(done)
        found = done
    return found


_PATH = "array<struct<left:string,right:string>>"


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: leaf, subroot, root, the digest of its proof, the root that the
    proof gives for what a verifier is shown, and whether that is the root."""
    order = [F.col("doc_id"), F.col("leaf")]
    placed = stored(
        numbered(leaves(docs), order, "nth", ["lang"], "tree", "stop").select(
            "doc_id", "leaf", "shown", "tree", "stop",
            (F.col("tree") + F.col("nth")).alias("lo"),
            (F.col("tree") + F.col("nth") + 1).alias("hi")), "leaves")
    subroots, levels = forest(placed.withColumnRenamed("leaf", "digest").select(
        "tree", "stop", "lo", "hi", "digest"))
    # Trees are numbered in the order of their languages, so they are the next tree's leaves.
    tree = numbered(subroots, [F.col("tree")], "lo", (), "from", "stop").select(
        F.col("from").alias("tree"), "stop", "lo", (F.col("lo") + 1).alias("hi"),
        F.col("digest"), F.col("tree").alias("language"), F.col("level").alias("height"))
    tree = stored(tree, "languages")
    top, above = forest(tree.select("tree", "stop", "lo", "hi", "digest"))
    ends = top.select("tree", "level", F.array().cast(_PATH).alias("path"),
                      F.col("digest").alias("top"))
    # ``top`` of a language is its subroot and the root.
    tops = stored(proofs(tree, above, ends).select(
        F.col("language").alias("tree"), F.col("height").alias("level"), "path",
        F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("top")),
        "tops")
    found = proofs(placed, levels, tops)
    beside = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = F.aggregate("path", F.col("shown"), lambda now, s: F.sha2(
        F.concat(s["left"], now, s["right"]), 256))
    return found.select(
        "doc_id", "leaf", F.col("top.subroot").alias("subroot"), F.col("top.root").alias("root"),
        F.sha2(beside, 256).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def _leaf_sql(text: str) -> str:
    values = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return "sha256(" + " || ".join(
        f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')" for v in values) + ")"


# crc32 bit by bit, as the SQL dialect has no function for it.
_CRC_SQL = """xor(4294967295, list_reduce(
  [CAST(4294967295 AS BIGINT)] || list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END))))"""


def _levels_sql(name: str, leaves_: str) -> str:
    """Recursive table: the nodes of each tree (g) by level, and below them each node's
    siblings by side."""
    return f"""
{name} AS (
  SELECT g, 0 AS lvl, nth AS idx, digest, n FROM {leaves_}
  UNION ALL
  SELECT g, lvl + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (n + 7) // 8
  FROM {name} WHERE n > 1 GROUP BY g, lvl, idx // 8, n),
{name}_sides AS (
  SELECT g, lvl, idx,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name} WHERE n > 1 WINDOW w AS (PARTITION BY g, lvl, idx // 8 ORDER BY idx)),
{name}_steps AS (
  SELECT t.g, t.nth, list({{'l': s.l, 'r': s.r, 'h': ''}} ORDER BY s.lvl) AS steps
  FROM {leaves_} t JOIN {name}_sides s
    ON s.g = t.g AND s.idx = t.nth // CAST(pow(8, s.lvl) AS BIGINT) GROUP BY t.g, t.nth)"""


ORACLE = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, lang, {_leaf_sql('text')} AS leaf,
         {_leaf_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS other,
         CAST(doc_id AS VARCHAR) AS s FROM documents),
shown AS (
  SELECT doc_id, lang, leaf,
         CASE WHEN {_CRC_SQL} % {TAMPER} = 0 THEN other ELSE leaf END AS shown FROM base),
rows AS (
  SELECT doc_id, leaf AS digest, shown,
         CAST(dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS BIGINT) AS g,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS nth,
         count(*) OVER (PARTITION BY lang) AS n FROM shown),{_levels_sql("up", "rows")},
langs AS (
  SELECT 0 AS g, g AS nth, digest, count(*) OVER () AS n FROM up WHERE n = 1),{_levels_sql("top", "langs")},
paths AS (
  SELECT r.doc_id, r.digest AS leaf, r.shown, l.digest AS subroot, t.digest AS root,
         coalesce(a.steps, []) || coalesce(b.steps, []) AS steps
  FROM rows r JOIN langs l ON l.nth = r.g JOIN top t ON t.n = 1
  LEFT JOIN up_steps a ON a.g = r.g AND a.nth = r.nth
  LEFT JOIN top_steps b ON b.nth = r.g),
folded AS (
  SELECT doc_id, leaf, subroot, root,
         sha256(array_to_string(list_transform(steps, lambda x: x.l || x.r), '')) AS proof_sha256,
         list_reduce([{{'l': '', 'r': '', 'h': shown}}] || steps, lambda a, x:
           {{'l': '', 'r': '', 'h': sha256(x.l || a.h || x.r)}}).h AS folded_root FROM paths)
SELECT *, folded_root = root AS verified FROM folded
"""
